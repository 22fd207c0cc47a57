"""BPE encoding and decoding with a pair occurrence index.

A worker keeps the distinct words of its partition back to back in one array
of symbols.  An index maps every mergeable pair to all its places; the active
ranks are applied in ascending order, each to all its places at once, and only
the lists of the pairs next to a merged place are updated.  Texts are then
put together from the words' ids, so a word that occurs a thousand times is
encoded once.

The tokenizer file (JSON of the ``tokenizers`` library) is a parameter: BPE
with byte-level symbols, optional end-of-word suffix, the normalisers and
splitting of lower-case word vocabularies.  It must exist at the same path on
every executor.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from typing import Dict, Iterator, List, Optional, Sequence, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code


def byte_symbols() -> List[str]:
    """The character that stands for each byte in byte-level vocabularies:
    itself where printable, else the next free one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], extra = chr(0x100 + extra), extra + 1
    return out


class PairIndexBpe:
    """Merges of one vocabulary over many words at once."""

    def __init__(self, vocab: Dict[str, int], merges: Sequence, suffix: str):
        self.size = max(vocab.values()) + 1
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b[:]] for a, b in pairs], np.int64)
        key = self.left * self.size + self.right
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]
        names = byte_symbols()
        self.inner = np.array([vocab.get(c, -1) for c in names], np.int64)
        self.final = np.array([vocab.get(c + suffix, -1) for c in names], np.int64)
        used: Dict[int, int] = {}
        for r in range(len(pairs) - 1, -1, -1):
            used[int(self.left[r])] = used[int(self.right[r])] = r
        #: Ranks whose product takes part in an earlier merge: one place of a word at a time.
        self.stepwise = {r for r, z in enumerate(self.made.tolist()) if used.get(z, len(pairs)) < r}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where there is no such merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.order[at], -1)

    def encode(self, words: Sequence[bytes]) -> Tuple[np.ndarray, np.ndarray]:
        """(ids of all words back to back, number of ids of each word); no word is empty."""
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lens = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        last = np.cumsum(lens) - 1
        first = last - lens + 1
        sym = self.inner[data]
        sym[last] = self.final[data[last]]
        nxt = np.arange(1, len(sym) + 1)
        nxt[last] = -1
        prv = np.arange(-1, len(sym) - 1)
        prv[first] = -1
        places: Dict[int, List[np.ndarray]] = {}
        heap: List[int] = []
        self._list(np.flatnonzero(nxt >= 0), sym, nxt, places, heap)
        while heap:
            r = heapq.heappop(heap)
            at = places.pop(r)
            pos = at[0] if len(at) == 1 else np.concatenate(at)
            a, b = self.left[r], self.right[r]
            pos = pos[sym[pos] == a]
            n = nxt[pos]
            pos = pos[(n >= 0) & (sym[n] == b)]
            if len(pos) == 0:
                continue
            if a == b or r in self.stepwise:
                pos = self._apart(np.unique(pos), nxt, first, r, places, heap)
            n = nxt[pos]
            after = nxt[n]
            sym[pos] = self.made[r]
            sym[n] = -1
            nxt[pos] = after
            inside = after >= 0
            prv[after[inside]] = pos[inside]
            before = prv[pos]
            near = np.concatenate([before[before >= 0], pos[inside]])
            if len(near) > 1:
                near = np.unique(near)
            self._list(near, sym, nxt, places, heap)
        alive = sym >= 0
        return sym[alive], np.add.reduceat(alive.astype(np.int64), first)

    def _apart(self, pos, nxt, first, r, places, heap) -> np.ndarray:
        """Places that can be merged together, leftmost first: none overlaps the
        one before, and for a stepwise rank one of each word (the rest is listed again)."""
        keep, again, end, word = [], [], -1, -1
        owner = np.searchsorted(first, pos, side="right")
        for p, w in zip(pos.tolist(), owner.tolist()):
            if p == end:
                continue
            if r in self.stepwise and w == word:
                again.append(p)
                continue
            keep.append(p)
            end, word = int(nxt[p]), w
        if again:
            places[r] = [np.array(again)]
            heapq.heappush(heap, r)
        return np.array(keep)

    def _list(self, start, sym, nxt, places, heap) -> None:
        """Enter the pairs that begin at ``start`` under their ranks."""
        if len(start) == 0:
            return
        rank = self.ranks(sym[start], sym[nxt[start]])
        good = rank >= 0
        start, rank = start[good], rank[good]
        if len(start) > 1:
            by = np.argsort(rank, kind="stable")
            start, rank = start[by], rank[by]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            groups = zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(start, cuts))
        else:
            groups = zip(rank.tolist(), [start])
        for r, p in groups:
            if r in places:
                places[r].append(p)
            else:
                places[r] = [p]
                heapq.heappush(heap, r)


def _letters(limit: int, kinds: str) -> str:
    """A regular-expression class body of the characters below ``limit`` of some Unicode kinds."""
    return "".join(re.escape(chr(c)) for c in range(limit) if unicodedata.category(chr(c))[0] in kinds)


class _Numbered(dict):
    """Numbers keys in the order they first come and lists the new ones."""

    def __init__(self, fresh: list):
        super().__init__()
        self.fresh = fresh

    def __missing__(self, key):
        n = self[key] = len(self)
        self.fresh.append(key)
        return n


class WordVocabulary:
    """Splits texts as a lower-casing word vocabulary does and encodes them.

    ``codes(texts)`` gives for each text the indexes of its chunks (runs
    without white space); the chunks' ids, and their texts, are kept for
    later texts of the same worker, up to ``max_chunks``."""

    _LIMIT = 0x250      # the splitting below is spelled out for code points under this one

    def __init__(self, path: str, max_chunks: int = 300_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.library = Tokenizer.from_file(path)    # for texts with rarer characters
        self.bpe = PairIndexBpe(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        names = {i: t for t, i in model["vocab"].items()}
        names.update({i: t for t, i in self.special.items()})
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.decimals = [str(i) for i in range(len(self.names))]
        letters, numbers = _letters(self._LIMIT, "L"), _letters(self._LIMIT, "N")
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\\s\\x1c-\\x1f{letters}{numbers}]+")
        self.plain = re.compile(f"[\\x00-\\x1b\\x20-{chr(self._LIMIT - 1)}]*")
        self.byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.max_chunks = max_chunks
        self._reset()

    def _reset(self):
        self.fresh: List[object] = []
        self.index = _Numbered(self.fresh)
        self.n_ids = np.empty(0, np.int64)
        self.ids_text: List[str] = []
        self.decoded: List[str] = []

    def _chunks(self, text: str) -> list:
        """Keys of a text without special tokens: strings without white space, or
        tuples of words as bytes."""
        if not text.isascii():
            if not self.plain.fullmatch(text):
                norm = self.library.normalizer.normalize_str(text)
                return [tuple(bytes(self.byte_of[c] for c in w)
                              for w, _ in self.library.pre_tokenizer.pre_tokenize_str(norm))]
            text = unicodedata.normalize("NFC", text)
        elif not self.plain.fullmatch(text):        # separators that only Python takes for white space
            return [tuple(bytes(self.byte_of[c] for c in w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(
                self.library.normalizer.normalize_str(text)))]
        return text.lower().split()

    def codes(self, texts: Sequence[str]) -> List[np.ndarray]:
        if len(self.index) > self.max_chunks:
            self._reset()
        index = self.index
        out = []
        for t in texts:
            parts = self.cut.split(t) if self.cut and "<|" in t else (t,)
            keys: list = []
            for n, part in enumerate(parts):
                if n % 2:
                    keys.append(self.special[part])
                elif part:
                    keys += self._chunks(part)
            out.append(np.fromiter(map(index.__getitem__, keys), np.int32, len(keys)))
        self._encode_fresh()
        return out

    def _encode_fresh(self):
        words: Dict[bytes, int] = {}
        spelled = []
        for key in self.fresh:
            if isinstance(key, int):
                spelled.append(key)
                continue
            ws = key if isinstance(key, tuple) else [w.encode() for w in self.pieces.findall(key)]
            spelled.append([words.setdefault(w, len(words)) for w in ws])
        ids, n = self.bpe.encode(list(words))
        ids, ends = ids.tolist(), np.cumsum(n).tolist()
        names, decimals = self.names, self.decimals
        counts = []
        texts, decoded = [], []
        begin = [0, *ends]
        for w in range(len(ends)):
            own = ids[begin[w]:ends[w]]
            texts.append(" ".join([decimals[i] for i in own]))
            decoded.append(" ".join([names[i] for i in own]))
        n = n.tolist()
        for s in spelled:
            if isinstance(s, int):
                counts.append(1)
                self.ids_text.append(decimals[s])
                self.decoded.append(names[s])
            elif len(s) == 1:
                counts.append(n[s[0]])
                self.ids_text.append(texts[s[0]])
                self.decoded.append(decoded[s[0]])
            else:
                counts.append(sum([n[w] for w in s]))
                self.ids_text.append(" ".join([texts[w] for w in s]))
                self.decoded.append(" ".join([decoded[w] for w in s]))
        self.n_ids = np.concatenate([self.n_ids, np.array(counts, np.int64)])
        self.fresh.clear()


_LOADED: Dict[str, WordVocabulary] = {}


def vocabulary(path: str) -> WordVocabulary:
    """The worker's vocabulary of a file; workers are reused from task to task."""
    if path not in _LOADED:
        _LOADED[path] = WordVocabulary(path)
    return _LOADED[path]


def _blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[Tuple[pa.Array, List[str]]]:
    """(ids, texts) in blocks of about ``chars`` characters."""
    for b in batches:
        start, size, texts = 0, 0, []
        for at in range(0, b.num_rows, 64):            # never a whole batch as Python strings
            for i, t in enumerate(b.column(1).slice(at, 64).to_pylist(), at):
                texts.append(t or "")
                size += len(texts[-1])
                if size >= chars or i == b.num_rows - 1:
                    yield b.column(0).slice(start, i + 1 - start), texts
                    start, size, texts = i + 1, 0, []


def bpe_encode(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
               block_chars: int = 8 << 20, out_chars: int = 4 << 20) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids`` (decimal ids joined by one
    space) and ``decoded`` (the text that decoding these ids gives, special
    tokens kept; a vocabulary without a decoder joins its tokens by one space).

    Special tokens that stand in a text get their own id; nothing is added,
    cut or padded.  A worker holds ``block_chars`` characters of text and their
    distinct words at a time, or the longest text.

    Defined cases: null text counts as empty and has no ids; ids may be null or
    repeated; an empty table gives an empty result; other columns are not
    looked at."""
    ship_code(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = docs.sparkSession.createDataFrame([], source.schema).selectExpr(
        "doc_id", "0L as n_tokens", "'' as ids", "'' as decoded").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer_file)
        for ids, texts in _blocks(batches, block_chars):
            codes = vocab.codes(texts)
            start = size = 0
            n, own, plain = [], [], []
            for i, code in enumerate(codes):
                at = code.tolist()
                n.append(int(vocab.n_ids[code].sum()))
                own.append(" ".join([x for x in map(vocab.ids_text.__getitem__, at) if x]))
                plain.append(" ".join([x for x in map(vocab.decoded.__getitem__, at) if x]))
                size += len(own[-1])
                if size >= out_chars or i == len(codes) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(start, i + 1 - start), pa.array(n, pa.int64()), pa.array(own, pa.string()),
                         pa.array(plain, pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])
                    start, size, n, own, plain = i + 1, 0, [], [], []

    return source.mapInArrow(run, schema)


def bpe_decode(rows: DataFrame, tokenizer_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` plus the text of the decimal ids in ``ids_col`` (null counts as no
    ids), by the vocabulary's own table; an id outside it is an error."""
    ship_code(rows.sparkSession)

    def decode(batches):
        import pandas as pd
        names = vocabulary(tokenizer_file).names
        for ids in batches:
            yield pd.Series([" ".join([names[int(i)] for i in (x or "").split()]) for x in ids])

    from typing import Iterator as It

    import pandas as pd
    decode.__annotations__ = {"batches": It[pd.Series], "return": It[pd.Series]}
    return rows.withColumn(out_col, F.pandas_udf(decode, "string")(F.col(ids_col)))
