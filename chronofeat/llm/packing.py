"""Packing of tokenised documents into sequences of a fixed length.

Online packing in bounded space: each partition keeps ``open_windows`` open
windows.  Whole windows are cut from the front of long documents; the rest
goes to the open window it fits best.  When none fits, the fullest window is
given out (filled up with the front of the document where its gap is worth a
cut) and the rest is tried again.  At the end of a partition the windows
that are left are merged: the emptiest are poured into the gaps of the
fullest, so at most one sequence of a partition stays short.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from typing import Dict, Iterator, List, Tuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _blocks
from .common import ship_code
from .wordblocks import distinct_words


class ByteBpe:
    """Ids of a byte-level BPE vocabulary (JSON file of the ``tokenizers``
    library).  The pre-tokenizer splits before a single space between two
    characters that are no white space, so the distinct words of a block are
    encoded once and looked up after that.  A space beside other white space
    can lie inside a token; texts that hold one are encoded whole."""

    #: A space after or before white space (of any script).
    run = re.compile(r"\x20(?:\s|(?<=\s\x20))")

    def __init__(self, path: str):
        import json

        import tiktoken

        from .bpe import byte_symbols

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        # the splitting of the byte-level pre-tokenizer (fixed value)
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.encoder = tiktoken.Encoding("own", pat_str=split, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)       # bytes of each id
        self.width[list(ranks.values())] = list(map(len, ranks))
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def _whole(self, text: str) -> np.ndarray:
        """Ids of one text without the block's help."""
        ids: List[int] = []
        for i, part in enumerate(self.cut.split(text)):
            ids += [self.special[part]] if i % 2 else self.encoder.encode_ordinary(part)
        return np.array(ids, np.uint32)

    def _words(self, data: bytes, starts: np.ndarray, lens: np.ndarray) -> Tuple[np.ndarray, ...]:
        """(ids back to back, first place and number of ids of each word), each word after a space.

        The distinct words are encoded as one text and cut again by the bytes of their ids."""
        one, number = distinct_words(data, starts, lens)
        words = [data[a:a + n] for a, n in zip(starts[one].tolist(), lens[one].tolist())]
        ids = np.array(self.encoder.encode_ordinary(" " + b" ".join(words).decode()) if words else [], np.uint32)
        cuts = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(lens[one] + 1)) + 1
        n = np.diff(np.concatenate([[0], cuts]))
        return ids, (cuts - n)[number], n[number]

    def encode(self, texts: List[str]) -> Iterator[np.ndarray]:
        """Ids (uint32) of each text."""
        plain = [t if t and t[0] != " " and t[-1] != " " and "<|" not in t and not self.run.search(t) else "" for t in texts]
        datas = [t.encode() for t in plain]
        data = b" ".join(datas)
        space = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
        starts = np.concatenate([[0], space + 1])
        lens = np.concatenate([space, [len(data)]]) - starts
        bounds = np.cumsum([0] + [len(d) + 1 for d in datas])
        cut = np.searchsorted(starts, bounds)
        lens[cut[:-1]] = 0                  # a text's first word follows no space
        inner = lens > 0
        ids, at, n = self._words(data, starts[inner], lens[inner])
        ends = np.cumsum(n)
        place = np.concatenate([[0], np.cumsum(inner)])[cut]
        for i, t in enumerate(texts):
            if t and not plain[i]:
                yield self._whole(t)
                continue
            a, z = place[i], place[i + 1]
            head = np.array(self.encoder.encode_ordinary(t.split(" ", 1)[0]), np.uint32)
            if z == a:
                yield head
                continue
            done = ends[a - 1] if a else 0
            take = np.repeat(at[a:z] - (ends[a:z] - n[a:z] - done), n[a:z]) + np.arange(ends[z - 1] - done)
            yield np.concatenate([head, ids[take]])


_LOADED: Dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


Piece = Tuple[object, int, np.ndarray, int]       # document, start there, ids, its document's ids


class WindowPacker:
    """The open windows of one partition.  ``closed`` gathers finished sequences
    as lists of pieces; the caller takes them out."""

    def __init__(self, length: int, open_windows: int, min_cut: int):
        self.length, self.limit, self.min_cut = length, open_windows, min_cut
        self.gaps: List[Tuple[int, int]] = []     # (free room, window), ascending
        self.windows: Dict[int, List[Piece]] = {}
        self.closed: List[List[Piece]] = []
        self._next = 0

    def add(self, doc: object, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.length:
            self.closed.append([(doc, at, ids[at:at + self.length], total)])
            at += self.length
        while at < total:
            rest = total - at
            k = bisect_left(self.gaps, (rest, -1))
            if k < len(self.gaps):
                gap, w = self.gaps.pop(k)
                self.windows[w].append((doc, at, ids[at:], total))
                if gap > rest:
                    insort(self.gaps, (gap - rest, w))
                else:
                    self.closed.append(self.windows.pop(w))
                return
            if len(self.gaps) < self.limit:
                insort(self.gaps, (self.length - rest, self._next))
                self.windows[self._next] = [(doc, at, ids[at:], total)]
                self._next += 1
                return
            gap, w = self.gaps.pop(0)              # none fits: the fullest goes
            if gap >= self.min_cut:
                self.windows[w].append((doc, at, ids[at:at + gap], total))
                at += gap
            self.closed.append(self.windows.pop(w))

    def finish(self) -> None:
        """Merge what is left: pour the emptiest windows into the fullest."""
        left = [self.windows[w] for _, w in self.gaps]     # fullest first
        room = [g for g, _ in self.gaps]
        i, j = 0, len(left) - 1
        while i < j:
            doc, at, ids, total = left[j].pop()
            take = min(room[i], len(ids))
            left[i].append((doc, at, ids[:take], total))
            room[i] -= take
            room[j] += take
            if take < len(ids):
                left[j].append((doc, at + take, ids[take:], total))
            if room[i] == 0:
                i += 1
            if not left[j]:
                j -= 1
        self.closed += [w for w in left if w]
        self.gaps, self.windows = [], {}


def pack_documents(docs: DataFrame, tokenizer_file: str, length: int = 1024, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", open_windows: int = 64, min_cut: int = 16,
                   block_chars: int = 3 << 20) -> DataFrame:
    """One row per piece: ``doc_id, start`` (ids of the document before it),
    ``length, doc_tokens`` (with the closing ``end_id``), ``sequence_id, offset``
    (its place there) and ``ids`` (little-endian unsigned 32-bit).

    The pieces of a sequence lie gapless from offset 0 and hold at most
    ``length`` ids; a gap of under ``min_cut`` may stay padding.  Sequence ids
    hold the partition and a running number, so a task that runs again gives
    the same rows.

    Defined cases: null text counts as empty (one piece with ``end_id`` only);
    ids may be null; rows that repeat an id are packed each; an empty table
    gives an empty result; other columns are not looked at."""
    ship_code(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = source.selectExpr("doc_id", "0L as start", "0L as length", "0L as doc_tokens", "0L as sequence_id",
                               "0L as offset", "cast('' as binary) as ids").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_file)
        pack = WindowPacker(length, open_windows, min_cut)
        number = TaskContext.get().partitionId() << 40
        kind = None

        def rows():
            nonlocal number
            out: List[list] = [[] for _ in range(7)]
            for window in pack.closed:
                offset = 0
                for doc, at, ids, total in window:
                    for col, v in zip(out, (doc, at, len(ids), total, number, offset, ids.tobytes())):
                        col.append(v)
                    offset += len(ids)
                number += 1
            pack.closed = []
            kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                              ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for own, texts in _blocks(batches, block_chars):
            kind = own.type
            for doc, ids in zip(own.to_pylist(), bpe.encode(texts)):
                pack.add(doc, np.append(ids, np.uint32(end_id)))
            if pack.closed:
                yield rows()
        if kind is not None:
            pack.finish()
            yield rows()

    return source.mapInArrow(run, schema)
