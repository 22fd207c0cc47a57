"""N-gram join, HTML extraction, quality classifier, WARC and the pipeline."""

import gzip
import html
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from chronofeat.llm.components import connected_components
from chronofeat.llm.dom import parse
from chronofeat.llm.html_extract import decode, extract_main_text, train_extractor
from chronofeat.llm.ngram_join import _expand, _squeeze, drop_near_duplicates, ngram_jaccard_join
from chronofeat.llm.quality_classifier import fit_label_model, quality_classifier
from chronofeat.llm.queries import QUERIES
from chronofeat.llm.warc import (build_derivatives, get, page_responses, plain_body, read_record, read_warc, split_http,
                                 warc_fields, write_record)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc(i, text, source="s"):
    return i, text, "en", source, None if text is None else len(text)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}


def brute_join(rows, width=4, percent=85):
    """{(id, set size): component} by all pairs that share a shingle."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for t in s:
                at[t].append(k)
    done = set()
    for ks in at.values():
        for a in ks:
            for b in ks:
                if a < b and (a, b) not in done:
                    done.add((a, b))
                    n = len(sets[a][1] & sets[b][1])
                    if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n):
                        x, y = find(sets[a][0]), find(sets[b][0])
                        parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def near_copies(seed, groups=8, size=12):
    rng = random.Random(seed)
    rows, i = [], 0
    passage = [f"p{k}" for k in range(60)]
    for g in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([5, 40, 120]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                w += passage
            rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
            i += 1
    return rows


def join_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_join_against_brute_force(frame):
    rows = near_copies(1) + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (905, "one two three"),
                             (None, "one two"), (None, "x y z"), (906, "É a b c d"), (907, "é a b c d"), (3, "one two"),
                             (908, "z " * 5000), (909, "z " * 6000)]
    df = frame(DOCS + ", n string, digest string", [doc(i, t) + ("clash", "clash") for i, t in rows]).repartition(5)
    out = ngram_jaccard_join(df, block=4)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert join_rows(out) == brute_join(rows)


def test_join_with_a_hot_group(frame):
    """A chain of near copies: far ends are linked through the members between only."""
    base = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([f"c{j}" for j in range(k)] + base[k:])) for k in range(60)]
    rows += [(1000 + k, " ".join(base)) for k in range(80)] + [(2000 + k, " ".join(base[:150] + [f"u{k}_{j}" for j in range(40)]))
                                                              for k in range(60)]
    assert join_rows(ngram_jaccard_join(frame(DOCS, [doc(*r) for r in rows]).repartition(4), block=8)) == brute_join(rows)


def test_join_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert join_rows(QUERIES["op8_ngram_join"](spark, sf_dir)) == brute_join(rows)


def test_near_duplicates_drop(frame):
    rows = near_copies(2, groups=3) + [(None, "a b c d e f")]
    out = drop_near_duplicates(frame(DOCS, [doc(*r) for r in rows]))
    want = {c for _, _, c in brute_join(rows, 5, 80)}
    assert {r.doc_id for r in out.collect()} == want and out.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert ngram_jaccard_join(frame(DOCS)).count() == 0


def test_components_of_a_path_and_a_star(frame):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5), (300, 299), (299, 300)]
    got = dict(connected_components(frame("a long, b long", edges)).collect())
    assert got == {**{k: 100 for k in range(100, 141)}, **{k: 7 for k in [7, *range(200, 260)]}, 299: 299, 300: 299}


def test_squeeze():
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (_expand(_squeeze(x)) == x).all() and len(_expand(_squeeze(x[:0]))) == 0


# --- pages


def article_text(page):
    """Blocks of the article of the given pages, by their own layout."""
    m = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:h1|p)>", m[1].replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
    return "\n".join(b for b in (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in blocks) if b)


@pytest.fixture(scope="module")
def extractor(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages, train_extractor(pages, sample=60)


def test_main_text_of_pages(extractor):
    pages, model = extractor
    want = {r.page_id: article_text(r.html) for r in pages.collect()}
    got = extract_main_text(pages, model).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    assert sum(r.text == want[r.page_id] for r in got) >= 0.99 * len(want)


def test_main_text_cases(frame, extractor):
    _, model = extractor
    page = ('<html><body><header class="masthead"><p>Site</p></header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use '
            'cookies</div><main><h1>A title</h1><p>First&nbsp;paragraph &amp; its\n  words, with <b>bold</b> and <a href="x">a link</a>.'
            '</p><div class="advert">Buy now</div><p>Second paragraph, just as long as the first one is.</p><form><label>Mail</label>'
            '</form></main><section class="comments"><p>I liked this article a lot, thank you.</p></section><aside>Related</aside>'
            '<script>var a = "<p>no</p>";</script><footer>(c)</footer></body></html>')
    rows = [(1, "u", page, "clash"), (2, None, None, ""), (3, "u", "", ""), (None, "u", "just text", ""), (1, "u", page, ""),
            (4, "u", "<p>" * 3000 + "deep" + "<", ""), (5, "u", "<article>" + "<p>" + "word " * 100_000 + "</p></article>", "")]
    got = extract_main_text(frame("page_id long, url string, html string, text string", rows), model).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert by[1] == ("A title\nFirst paragraph & its words, with bold and a link.\n"
                     "Second paragraph, just as long as the first one is.")
    assert by[2] == by[3] == "" and by[None] == "just text" and by[5] == ("word " * 100_000).strip()
    assert extract_main_text(frame("page_id long, url string, html string"), model).count() == 0


def test_decoding_is_hierarchical():
    nodes = parse("<div>a<p>b</p><section><p>c</p><p>d</p></section></div>")
    score = {"html": 1.0, "div": 0.5, "p": 2.0, "section": -3.0}
    assert decode(nodes, np.array([score[x.tag] for x in nodes])) == ["a", "b", "c", "d"]
    score["section"] = -5.0
    assert decode(nodes, np.array([score[x.tag] for x in nodes])) == ["a", "b"]


# --- quality classifier


def test_classifier_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = {r.doc_id: r.kept for r in QUERIES["op10_quality_classifier"](spark, d).collect()}
    assert len(got) == 1000
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(got[i] for i in good) >= 0.98 * len(good)
    assert sum(not got[i] for i in bad) >= 0.95 * len(bad)
    again = {r.doc_id: r.kept for r in QUERIES["op10_quality_classifier"](spark, d).collect()}
    assert got == again


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    votes = np.stack([np.where(good, rng.random(len(good)) >= 0.004, rng.random(len(good)) >= p).astype(int) for p in (0.7, 0.5, 0.4)], 1)
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    model = fit_label_model(rows, counts.astype(float))
    assert abs(model.good - 0.8) < 0.08
    assert ((model.posterior(rows) > 0.5) == (rows.min(1) == 1)).all()
    # the labellers overlap; a tenth of the bad documents gets no vote and counts as good, which raises the hits by as much
    hits = (model.share[1:] * model.chance[:, 1:, 1]).sum(1) / model.share[1:].sum()
    assert np.abs(hits - (0.7, 0.5, 0.4)).max() < 0.1
    assert np.abs(model.chance[:, 0, 1] - 0.004).max() < 0.004


def test_classifier_cases(frame):
    good = [" ".join(f"w{(k * 7 + j) % 211}," for j in range(80)) for k in range(40)]
    rows = [doc(k, t) for k, t in enumerate(good)] + [doc(100 + k, "### $$$ " * 40) for k in range(8)]
    rows += [doc(200, None), doc(201, ""), doc(None, good[0]), doc(0, good[0]), doc(202, "x " * 50_000)]
    out = quality_classifier(frame(DOCS + ", votes long, score string", [r + (1, "") for r in rows]))
    got = out.collect()
    kept = {r.doc_id for r in got if r.kept}
    assert len(got) == len(rows) and not kept & {200, 201, *range(100, 108)} and set(range(40)) <= kept
    assert quality_classifier(frame(DOCS)).count() == 0


# --- WARC


def test_warc_round_trip(frame):
    pages = [(1, "http://a/é?x=1", "<html><head><title>T &amp; t</title></head><body><p>One</p><a href='/l'>two</a></body></html>"),
             (2, None, None), (None, "http://b\r\nInjected: x", "plain"), (1, "http://a/é?x=1", "again"), (3, "u", "z" * 500_000)]
    df = frame("page_id long, url string, html string, record string", [p + ("clash",) for p in pages])
    responses = page_responses(df)
    sources = {}
    for r in responses.collect():
        headers, block, end = read_record(r.record)
        assert end == len(r.record) and get(headers, "content-length") == str(len(block))
        sources[get(headers, "WARC-Record-ID")] = (headers, block)
    out = build_derivatives(responses, keep=("page_id",)).collect()
    assert len(out) == 2 * len(pages) and len(sources) == len(pages)
    for r in out:
        headers, block = sources[r.refers_to]
        own, data, _ = read_record(r.record)
        assert get(own, "WARC-Refers-To") == get(headers, "WARC-Record-ID") and get(own, "WARC-Date") == get(headers, "WARC-Date")
        assert get(own, "WARC-Target-URI") == get(headers, "WARC-Target-URI") and "Injected" not in dict(own)
        if r.warc_type == "metadata":
            fields = warc_fields(r.record)
            assert fields["source-payload-digest"] == [get(headers, "WARC-Payload-Digest")]
            assert fields["http-header-content-type"] == ["text/html; charset=utf-8"]
    texts = {(r.page_id, r.refers_to): read_record(r.record)[1].decode() for r in out if r.warc_type == "conversion"}
    assert sorted(texts.values(), key=len)[:4] == ["", "again", "plain", "One\ntwo"] or "One\ntwo" in texts.values()


def test_warc_files_and_codings(spark, frame, tmp_path):
    body = gzip.compress("<p>zipped é</p>".encode())
    chunked = b"".join(b"%x\r\n%s\r\n" % (len(body[k:k + 7]), body[k:k + 7]) for k in range(0, len(body), 7)) + b"0\r\n\r\n"
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n"
             b"Server: s\r\n\r\n" + chunked)
    one = write_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "d")], block)
    info = write_record([("WARC-Type", "warcinfo")], b"x: y\r\n\r\nWARC/1.1 inside")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(one))
    (tmp_path / "b.warc").write_bytes(one + info + one)
    records = read_warc(spark, str(tmp_path))
    assert records.count() == 5
    out = build_derivatives(records).collect()
    assert {(r.warc_type, r.refers_to) for r in out} == {("metadata", "<urn:uuid:1>"), ("conversion", "<urn:uuid:1>")}
    assert len(out) == 6 and {read_record(r.record)[1].decode() for r in out if r.warc_type == "conversion"} == {"zipped é"}
    _, http, sent = split_http(block)
    assert plain_body(http, sent) == b"<p>zipped \xc3\xa9</p>" and plain_body([("Content-Encoding", "gzip")], b"no") == b"no"
    odd = frame("record binary", [(None,), (bytearray(b""),), (bytearray(b"junk"),), (bytearray(info),)])
    assert build_derivatives(odd).count() == 0


# --- pipeline


def test_pipeline_against_brute_force(spark, sf_dir, tmp_path_str):
    from chronofeat.llm.secrets import scan_secrets

    from test_native import brute_measures, brute_spans
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {i: t for i, t in rows.items() if not brute_measures(t)[5]}
    groups = defaultdict(list)
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in kept.items():
        groups[(t or "").translate(low)].append(i)
    kept = {max(ids): kept[max(ids)] for ids in groups.values()}
    kept = {i: kept[i] for i in {c for _, _, c in brute_join(sorted(kept.items()), 5, 80)}}
    out = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, out, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            out.write.parquet(f"{tmp_path_str}/{k}")
            out = spark.read.parquet(f"{tmp_path_str}/{k}")
            assert out.columns == docs.columns
        if k == 2:
            assert {r.doc_id for r in out.collect()} == set(kept)
        if k == 3:
            assert {r.doc_id for r in out.collect()} == set(kept)
            assert all(not brute_spans(r.text) for r in out.collect())
            assert scan_secrets(out).where("size(spans) > 0").count() == 0
    assert {r.doc_id for r in out.select("doc_id").collect()} == set(kept)
