"""corpus_pipeline.run as a whole: what stays, its ids, odd and empty tables; keys by an independent parser."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from chronofeat.llm.secrets import scan_secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def documents():
    near = words(1, 400)
    secret = words(2, 60) + ' password = "hunter2hunter2" ' + words(3, 60)
    texts = {1: near, 2: near.rsplit(" ", 1)[0] + " other", 3: words(4, 90), 4: words(4, 90).upper(), 5: words(5, 120),
             6: secret, 7: "too short", 8: None, 9: "", 10: words(6, 30_000), 11: "same words again " * 60}
    rows = [(k, t, "en", "host" if k % 2 else None, len(t or "")) for k, t in texts.items()]
    # the larger id of equal texts stays, the smallest id of near ones; 7 to 9 have too few words, 11 repeats itself
    kept = {1: near, 4: words(4, 90).upper(), 5: texts[5], 6: secret.replace('password = "hunter2hunter2', "[REDACTED]"), 10: texts[10]}
    return rows, kept


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def packed(df):
    docs = {}
    for r in df.collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        docs.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
    out = {}
    for k, pieces in docs.items():
        pieces.sort()
        assert [p[0] for p in pieces] == list(np.cumsum([0] + [len(p[1]) for p in pieces[:-1]]))
        out[k] = [x for p in pieces for x in p[1]]
        assert {p[2] for p in pieces} == {len(out[k])} and out[k][-1] == 0
    return out


@pytest.mark.parametrize("extra", [False, True])
def test_run_keeps_cleans_and_packs(spark, tmp_path, tokenizer, extra):
    rows, kept = documents()
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.selectExpr("*", "1 AS kept", "'x' AS keep_id", "2 AS component_id", "3 AS spans", "4 AS blob", "5 AS ids", "6 AS host")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = packed(corpus_pipeline.run(spark, str(tmp_path)))
    assert set(got) == set(kept)
    for k, text in kept.items():
        want = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        decoded = tokenizer.decode(got[k][:-1], skip_special_tokens=False)
        assert got[k] == want or decoded == text, (k, decoded[-80:])


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.collect() == [] and "ids" in out.columns


def parsed_keys(text):
    """Places of whole private keys, by walking the lines."""
    out, at, start = [], 0, None
    for line in text.split("\n"):
        if line.startswith("-----BEGIN ") and line.endswith("PRIVATE KEY-----"):
            start, label = at, line[11:-16]
        elif start is not None and line == f"-----END {label}PRIVATE KEY-----":
            out.append((start, at + len(line)))
            start = None
        at += len(line) + 1
    return out


def test_keys_are_those_of_a_line_parser(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(4)):
            parts.append(words(rng.random(), rng.randrange(1, 30)))
            label = rng.choice(["", "RSA ", "EC ", "OPENSSH ", "ENCRYPTED "])
            body = ["".join(rng.choice("ABCDEFghijkl0123456789+/") for _ in range(64)) for _ in range(rng.randrange(1, 30))]
            parts.append("\n".join([f"-----BEGIN {label}PRIVATE KEY-----", *body, "QUJD", f"-----END {label}PRIVATE KEY-----"]))
        texts.append("\n".join(parts + [words(rng.random(), 9)]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "pem"] for r in scan_secrets(df).collect()}
    assert got == {k: parsed_keys(t) for k, t in enumerate(texts)} and sum(map(len, got.values())) > 50
