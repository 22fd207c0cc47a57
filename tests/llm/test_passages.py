"""Passage dedup against brute-force shared line runs."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from chronofeat.llm import line_dedup
from chronofeat.llm.line_dedup import passage_dedup
from chronofeat.llm.queries import QUERIES

DOCS = "doc_id long, text string"


def brute_passages(rows, long_words=50):
    """(id, text, lines, removed lines) by comparing the lines themselves."""
    docs = [(i, (t or "").split("\n")) for i, t in sorted(set(rows))]
    places = defaultdict(list)
    for k, (_, lines) in enumerate(docs):
        real = [n for n, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        for a, b in zip(real, real[1:]):
            places[lines[a], lines[b]].append((k, (a, b)))
        for a in real:
            if len(re.findall(r"[^\x20\x09-\x0D]+", lines[a])) > long_words:
                places[lines[a]].append((k, (a,)))
    gone = defaultdict(set)
    for found in places.values():
        for k, taken in found[1:]:
            gone[k].update(taken)
    out = []
    for k, (i, lines) in enumerate(docs):
        last, left = None, []
        for n, x in enumerate(lines):
            last = n if re.search(r"[^\x20\x09-\x0D]", x) else last
            if last not in gone[k]:
                left.append(x)
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def test_query_removes_every_shared_run(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: (r[2], r[3]) for r in brute_passages(rows)}
    got = QUERIES["op2_line_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed_lines) for r in got} == want
    assert sum(n for _, n in want.values()) > 0


def test_passages_of_all_lengths(spark):
    """A passage of any number of lines, anywhere in a document, goes whole."""
    rows, at = [], 0
    for n in range(2, 12):
        passage = "\n".join(f"line {k} of the passage of {n}" for k in range(n))
        for before, after in ((0, 0), (1, 3), (4, 1)):
            own = [f"own line {at} {k}" for k in range(before + after)]
            rows.append((at, "\n".join(own[:before] + [passage] + own[before:])))
            at += 1
    long = " ".join(f"w{k}" for k in range(51))
    rows += [(at, long + "\nx1"), (at + 1, "x2\n" + long), (at + 2, "short line\nx3"), (at + 3, "x4\nshort line")]
    rows += [(at + 4, "a\n\n \nb\n\nc"), (at + 5, "\n\na\nb\n\nd"), (at + 6, "z\nz\nz\nz"), (at + 7, None), (at + 8, ""),
             (at + 9, "\n\n\n"), (at + 10, "\n\n\n"), (at + 11, rows[0][1]), (at + 11, rows[0][1]), (None, rows[4][1])]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted(((-1 if r[0] is None else r[0], *tuple(r)[1:4]) for r in passage_dedup(df).collect()))
    want = brute_passages([(-1 if i is None else i, t) for i, t in rows])
    assert sorted(set(got)) == want and len(got) == len(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[1][3] == 2 and by_id[at][3] == 0 and by_id[at + 1][1] == "x2" and by_id[at + 3][3] == 0
    assert by_id[at + 5][1] == "\n\nd" and by_id[at + 6][1] == "z" and by_id[at + 11][1] == ""
    # every line that stood in the corpus stands there still
    lines = {x for _, t in rows for x in (t or "").split("\n")}
    assert lines <= {x for r in got for x in r[1].split("\n")} | {""}


def test_stretches_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a\nb\nc\nd"), (2, "a\nb\nx\nc\nd")], DOCS)
    assert {tuple(r) for r in passage_dedup(df).collect()} == {(1, "a\nb\nc\nd", 4, 0, 0), (2, "x", 5, 4, 2)}
    assert passage_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_chunks_shift_with_their_lines(spark):
    """A line put in front moves every chunk by one; chunks share their boundary lines and hold three lines or more."""
    lines = [f"line number {k} of the text" for k in range(400)]
    df = spark.createDataFrame([(0, lines), (1, ["a new first line", *lines])], "k int, items array<string>")
    found = {r.k: [(u.nth, u.n, bytes(u.digest)) for u in r.u if u.n > 2] for r in df.select(
        "k", line_dedup.line_units(F.col("items"), 50, 4, 2).alias("u")).collect()}
    moved = {(nth - 1, n, digest) for nth, n, digest in found[1]}
    assert len(found[0]) > 50 and len(moved & set(found[0])) >= len(found[0]) - 2
    ends = [(nth, nth + n - 1) for nth, n, _ in found[0]]
    assert all(b[0] >= a[1] for a, b in zip(ends, ends[1:]))


def test_candidates_are_compared_byte_by_byte(spark, monkeypatch):
    """Digests of four values make nearly all units candidates; no line goes that the texts do not repeat."""
    plain = line_dedup.line_units

    def coarse_digests(*args):
        return F.transform(plain(*args), lambda u: F.struct(
            u["nth"].alias("nth"), u["n"].alias("n"),
            F.unhex(F.lpad(F.conv(F.substring(F.hex(u["digest"]), 1, 1), 16, 4), 2, "0").substr(2, 1)).alias("digest")))

    rows = [(k, "\n".join(f"line {k * 7 + j if j % 3 else 'common'} {j}" for j in range(k % 9))) for k in range(40)]
    rows += [(100 + k, rows[k][1]) for k in range(20)]
    want = {r[0]: r for r in brute_passages(rows)}
    monkeypatch.setattr(line_dedup, "line_units", coarse_digests)
    got = passage_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows) and all(r.n_removed_lines <= want[r.doc_id][3] for r in got)
    texts = {i: (t or "").split("\n") for i, t in rows}
    assert all(set(r.text.split("\n")) - {""} <= set(texts[r.doc_id]) for r in got)
