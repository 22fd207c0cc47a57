"""Odd markup, damaged WARC records and constructed hash collisions."""

import email.parser
import gzip
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chronofeat.llm.dom import parse
from chronofeat.llm.ngram_join import ngram_jaccard_join
from chronofeat.llm.queries import op7_warc, op9_html_extract
from chronofeat.llm.shingles import shingle_sets
from chronofeat.llm.warc import (BrokenBody, _unchunk, build_derivatives, plain_text, read_record, read_warc, records_of,
                                 response_record, undo_codings, write_record)

# -- pages ------------------------------------------------------------------


def texts(page):
    return [t for node in parse(page) for _, t, _ in node.runs]


ODD_TAGS = ["<img alt=Bob's src=x>", "<img alt=5\" src=x>", "<img '>", "<img \">", "<img alt='>", "<img alt=\">", "<img =x>",
            "<img alt = it's title=\"a>b\">", "<img alt='a>b'>", "<img a=\"b\"c>", "<img a=b=c'd>", "<img alt=>", "<a href=x'y>",
            "<img/>", "<img alt\n=\n'x\"y'\n>"]


@pytest.mark.parametrize("tag", ODD_TAGS)
def test_text_behind_odd_tags_stays(tag):
    assert "".join(texts(f"<p>before {tag}behind</p><p>next</p>")).replace(" ", "") == "beforebehindnext"


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="ab ='\"/\n", max_size=12), st.sampled_from(["img", "span", "p", "div"]))
def test_no_text_outside_tags_is_lost(inside, name):
    got = "".join(texts(f"<p>first</p><{name} {inside}>second<p>third</p>"))
    # a quoted value ends at its own quote: whatever stands between tags is there
    assert got == "firstsecondthird" or (inside.count('"') % 2 or inside.count("'") % 2) and got.endswith("third"), got


def test_unclosed_quotes_take_linear_time():
    for piece in ("<a b='", "<a b=\"", "<a '", "<a =", "<p x='y\" "):
        parse(piece * 60_000)


def test_one_apostrophe_does_not_empty_a_page(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    before = {r.page_id: r.n_chars for r in op9_html_extract(spark, sf_dir).collect()}
    odd = pages.selectExpr("page_id", "url", "regexp_replace(html, '(?i)<p([ >])', '<img alt=Bob''s src=x><p$1') AS html")
    odd.write.parquet(f"{tmp_path}/pages.parquet")
    after = {r.page_id: r.n_chars for r in op9_html_extract(spark, str(tmp_path)).collect()}
    assert sum(after.values()) >= 0.97 * sum(before.values())
    assert sum(after[k] == 0 < before[k] for k in before) <= 0.02 * len(before)


# -- WARC -------------------------------------------------------------------

def independent(record):
    """Headers and block by the standard library's reader of mail headers."""
    version, _, rest = record.partition(b"\r\n")
    assert version == b"WARC/1.1"
    head, _, block = rest.partition(b"\r\n\r\n")
    headers = dict(email.parser.BytesHeaderParser().parsebytes(head).items())
    size = int(headers["Content-Length"])
    assert block[size:] == b"\r\n\r\n"
    return headers, block[:size]


def test_derivatives_by_an_independent_reader(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    from chronofeat.llm.warc import page_responses
    rows = build_derivatives(page_responses(spark.read.parquet(f"{sf_dir}/pages.parquet")), keep=("page_id",)).collect()
    assert len(rows) == 2 * len(pages) == op7_warc(spark, sf_dir).count()
    for r in rows:
        headers, block = independent(bytes(r.record))
        assert headers["WARC-Record-ID"] == r.record_id and headers["WARC-Refers-To"] == r.refers_to
        assert headers["WARC-Type"] == r.warc_type and len(block) == r.n_bytes
        assert headers.get("WARC-Target-URI") == pages[r.page_id].url
        if r.warc_type == "conversion":
            kept = block.decode()
            assert "<p" not in kept and "</" not in kept and len(kept) > 0.2 * len(set(pages[r.page_id].html))
    of = {}
    for r in rows:
        of.setdefault(r.page_id, set()).add((r.warc_type, r.refers_to))
    assert all({t for t, _ in v} == {"metadata", "conversion"} and len({x for _, x in v}) == 1 for v in of.values())


@pytest.mark.parametrize("body, want", [(b"3\r\nabc\r\n0\r\n\r\n", b"abc"), (b"0\r\n\r\n", b""), (b"3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n", b"abcde")])
def test_chunks(body, want):
    assert _unchunk(body) == want


@pytest.mark.parametrize("body", [b"-6\r\nabc", b"+3\r\nabc", b"0x3\r\nabc", b"", b"zz\r\n", b"abc"])
def test_bodies_that_are_not_chunked(body):
    with pytest.raises(ValueError):
        _unchunk(body)
    assert undo_codings([("Transfer-Encoding", "chunked")], body) == (body, None)


@pytest.mark.parametrize("body", [b"3\r\nabc\r\n", b"3\r\nabc\r\n9\r\nshort", b"3\r\nabc\r\n-1\r\nx"])
def test_bodies_that_break_off(body):
    with pytest.raises(ValueError):
        _unchunk(body)
    got, undecoded = undo_codings([("Transfer-Encoding", "chunked")], body)
    assert undecoded == "chunked"
    assert isinstance(BrokenBody("x"), ValueError)


def test_an_empty_chunked_body_has_no_text():
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Type: text/html\r\n\r\n0\r\n\r\n"
    record = write_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], block)
    from chronofeat.llm.warc import derive
    out = dict(derive(*read_record(record)[:2]))
    assert read_record(out["conversion"])[1] == b""


@pytest.mark.parametrize("length", ["-20", "+3", "1e3", "", "x", "9" * 30])
def test_lengths_that_are_no_numbers(length):
    with pytest.raises(ValueError):
        read_record(f"WARC/1.1\r\nContent-Length: {length}\r\n\r\nabc".encode())


def good(n):
    return response_record(str(n), f"http://x/{n}", f"<p>page {n}</p>", "2024-01-01T00:00:00Z")


def test_reading_goes_on_behind_damage():
    bad = b"WARC/1.1\r\nContent-Length: -50\r\n\r\nrubbish\r\n\r\n"
    zipped = gzip.compress(good(3))
    data = good(1) + bad + good(2) + zipped + zipped[:30] + zipped + b"tail"
    got = list(records_of(data))
    assert [d is None for _, _, d in got] == [True, False, True, True, False, True, False]
    assert [r for _, r, d in got if d is None] == [good(1), good(2), good(3), good(3)]
    assert [at for at, _, d in got if d] == [len(good(1)), data.index(zipped[:30], data.index(zipped) + 1), len(data) - 4]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"WARC/1.1\r\n", b"Content-Length: ", b"-5", b"7", b"\r\n\r\n", b"\x1f\x8b\x08", b"x", good(1),
                                 gzip.compress(good(2)), gzip.compress(good(2))[:20]]), max_size=12))
def test_any_bytes_are_read_to_the_end(parts):
    data = b"".join(parts)
    places = [at for at, _, _ in records_of(data)]
    assert places == sorted(set(places))


def test_read_warc_tells_the_place(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(good(1) + b"WARC/1.1\r\nContent-Length: -9\r\n\r\n" + good(2))
    rows = read_warc(spark, str(tmp_path)).orderBy("offset").collect()
    assert [r.damage is None for r in rows] == [True, False, True] and "Content-Length" in rows[1].damage
    assert build_derivatives(read_warc(spark, str(tmp_path))).count() == 4


def test_clashing_names_are_refused(spark):
    df = spark.createDataFrame([(b"", "x")], "record binary, record_id string")
    for keep in (("record_id",), ("Record_ID",), ("record", "record"), ("warc_type",)):
        with pytest.raises(ValueError):
            build_derivatives(df, keep=keep)


def test_tags_with_angle_brackets_in_values():
    assert plain_text('<p title="a>b">x</p><div data-x=\'c>d\'>y</div><br title=">">z') == "x\ny\nz"


# -- shingles ---------------------------------------------------------------

def test_words_that_collide_modulo_a_power_of_two_stay_apart(frame):
    word = [0]
    for _ in range(10):
        word += [1 - x for x in word]
    a, b = ("".join("ab"[x ^ flip] for x in word) for flip in (0, 1))
    rest = " one two three four five six"
    first, second = shingle_sets([a, b], 4)
    assert first.tolist() != second.tolist()
    got = {r.doc_id: r.component_id for r in ngram_jaccard_join(
        frame("doc_id long, text string", [(1, a + rest), (2, b + rest), (3, a + rest)])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_shingles_are_those_of_plain_python():
    import random
    rng = random.Random(2)
    docs = [" ".join(rng.choice(["a", "bb", "é" * 9, "x" * 40, "w" * 24]) for _ in range(rng.randrange(9))) for _ in range(200)]
    for width in (1, 3, 5):
        sets = [set(s.tolist()) for s in shingle_sets(docs, width)]
        plain = []
        for d in docs:
            w = d.split()
            plain.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
        assert [len(s) for s in sets] == [len(p) for p in plain]
        for i in range(0, 200, 7):
            for j in range(0, 200, 11):
                assert len(sets[i] & sets[j]) == len(plain[i] & plain[j])
