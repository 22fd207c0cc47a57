"""BPE and packing against the tokenizers library, and packing's invariants."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronofeat.llm.bpe import PairIndexBpe, WordVocabulary, bpe_decode, bpe_encode
from chronofeat.llm.packing import ByteBpe, WindowPacker, pack_documents
from chronofeat.llm.queries import QUERIES
from chronofeat.llm.wordblocks import distinct_words

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

ODD = ["", " ", "  ", "\n\n", " a", "a ", "a  b", "a   b", "a\n b\n\n  c", "a \n b", "it's I'LL we'd o'clock", "x\xa0y　z",
       "<|endoftext|>", "a<|endoftext|> b<|startoftext|>", "日本語 テスト", "Σίσυφος ΟΔΥΣΣΕΥΣ", "İstanbul é Å ½²x",
       "a\x1cb \x1f\x85c", "🙂🙂 a", "a" * 50, "ab" * 40, "word " * 3000, "é" * 20_000]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD), WordVocabulary(WORD, max_chunks=50)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE), ByteBpe(BYTE)


def ids_of(vocab, texts):
    return [" ".join(x for x in (vocab.ids_text[k] for k in code.tolist()) if x) for code in vocab.codes(texts)]


def test_word_bpe_is_the_librarys(word):
    lib, own = word
    assert ids_of(own, ODD) == [" ".join(map(str, lib.encode(t, add_special_tokens=False).ids)) for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=4))
def test_word_bpe_on_any_text(word, texts):
    lib, own = word
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ids_of(own, texts) == [" ".join(map(str, lib.encode(t, add_special_tokens=False).ids)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\tae's<|>")), max_size=60),
                min_size=1, max_size=4))
def test_byte_bpe_on_any_text(byte, texts):
    lib, own = byte
    assert [x.tolist() for x in own.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_byte_bpe_is_the_librarys(byte):
    lib, own = byte
    assert [x.tolist() for x in own.encode(ODD)] == [lib.encode(t, add_special_tokens=False).ids for t in ODD]


def test_ranks_that_come_back():
    """A product that takes part in an earlier merge: one place at a time, as one word alone would do it."""
    vocab = {x: k for k, x in enumerate(["a", "b", "c", "d", "ab", "bc", "abc", "abcd"])}
    merges = [("a", "bc"), ("abc", "d"), ("b", "c"), ("a", "b")]

    def alone(w):
        sym, rank = list(w), {m: k for k, m in enumerate(merges)}
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(sym, sym[1:])) if p in rank), default=None)
            if best is None:
                return [vocab[s] for s in sym]
            i = best[1]
            sym[i:i + 2] = [sym[i] + sym[i + 1]]

    words = ["abcd", "abcabcd", "bcbc", "aabcdd", "dcba", "abab", "c"]
    bpe = PairIndexBpe(vocab, merges, "")
    assert bpe.stepwise
    ids, n = bpe.encode([w.encode() for w in words])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [alone(w) for w in words]


def test_distinct_words_of_all_lengths():
    words = [b"a", b"a", b"b" * 8, b"b" * 9, b"b" * 24, b"b" * 25, b"b" * 25, b"b" * 24, b"", b"c"]
    data, starts, lens, at = b" ".join(words), [], [], 0
    for w in words:
        starts.append(at)
        lens.append(len(w))
        at += len(w) + 1
    one, number = distinct_words(data, np.array(starts), np.array(lens))
    assert [words[one[k]] for k in number] == words


def test_bpe_query(spark, sf_dir, word):
    lib = word[0]
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op5_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = lib.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_cases(frame, word):
    lib = word[0]
    df = frame("doc_id long, text string, ids string, n_tokens long",
               [(k, t, "clash", 1) for k, t in enumerate(ODD)] + [(None, None, "clash", 1), (3, "rep", "", 0), (3, "rep", "", 0)])
    out = bpe_encode(df, WORD, block_chars=100, out_chars=50)
    back = {(r.doc_id, r.ids): (r.n_tokens, r.decoded, r.again) for r in bpe_decode(out, WORD, out_col="again").collect()}
    for k, t in enumerate(ODD):
        ids = lib.encode(t, add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        assert back[(k, " ".join(map(str, ids)))] == (len(ids), text, text)
    assert back[(None, "")] == (0, "", "") and out.count() == len(ODD) + 3
    assert bpe_encode(frame("doc_id long, text string"), WORD).count() == 0


# --- packing


def check_pieces(rows, texts, lib, length):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        want = lib.encode(texts[i] or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(want) and p.length > 0
            at += p.length
            own = np.array(want[p.start:at], "<u4").tobytes()
            assert (p.ids == own) if hasattr(p, "ids") else (p.ids_crc32 == zlib.crc32(own))
        assert at == len(want)
    short = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        short += length - at
    return short / (length * len(by_seq))


def test_packing_query(spark, sf_dir, byte):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert check_pieces(QUERIES["op3_packing"](spark, sf_dir).collect(), texts, byte[0], 1024) < 0.02


def test_packing_cases(frame, byte):
    texts = dict(enumerate(ODD)) | {1000: None, 1001: "long " * 50_000}
    df = frame("doc_id long, text string, start long", [(i, t, 5) for i, t in texts.items()]).repartition(3)
    out = pack_documents(df, BYTE, length=64, open_windows=4, min_cut=3, block_chars=300)
    assert check_pieces(out.collect(), texts, byte[0], 64) < 0.1
    empty = pack_documents(frame("doc_id long, text string"), BYTE)
    assert empty.count() == 0 and empty.columns == out.columns


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=60), st.integers(1, 8), st.integers(0, 20))
def test_packer_places_every_id_once(sizes, windows, min_cut):
    pack = WindowPacker(32, windows, min_cut)
    for k, n in enumerate(sizes):
        pack.add(k, np.arange(n, dtype=np.uint32))
        assert len(pack.windows) <= windows
    pack.finish()
    got = defaultdict(list)
    for w in pack.closed:
        assert 0 < sum(len(p[2]) for p in w) <= 32
        for doc, at, ids, total in w:
            assert ids.tolist() == list(range(at, at + len(ids))) and total == sizes[doc]
            got[doc] += ids.tolist()
    assert {k: sorted(v) for k, v in got.items()} == {k: list(range(n)) for k, n in enumerate(sizes) if n}
    assert sum(sum(len(p[2]) for p in w) < 32 - min_cut for w in pack.closed) <= 1
