"""Main text of HTML pages: boosted trees over DOM elements.

Gradient-boosted trees score every block element by its tag, the words of its
attributes, depth, text and link density of its subtree and its siblings.  An
element's label says whether main text stands in its subtree.  Decoding is
hierarchical: the best labelling in which no element under a rejected one is
kept, found bottom-up in one pass.

The trees are trained here on a bounded sample of the pages themselves: the
paragraphs and furniture texts of sampled pages are set anew into page
layouts of many kinds (containers, menus, sidebars, notices, adverts, forms,
comments), so the label of every element is known.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from html import escape
from typing import Dict, Iterator, List, Sequence, Set, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialise, ship_code
from .dom import ATTR_BUCKETS, BARE, Node, features, parse, token_buckets

# --- training pages

_BODY = ['article', 'article class="post"', 'article id="story"', 'main', 'main id="content"', 'div class="content"',
         'div class="article-body"', 'div class="entry-content"', 'div id="main-content"', 'div class="post-body"',
         'section class="story"', 'div class="page-text"', 'div', 'section']
_MENU = ['nav', 'nav class="menu"', 'div class="menu"', 'div id="navigation"', 'ul class="nav-links"', 'div class="breadcrumb"',
         'div role="navigation"', 'div class="topbar"']
_HEAD = ['header', 'div id="header"', 'div class="site-header"', 'header class="masthead"', 'div class="banner-top"']
_FOOT = ['footer', 'div id="footer"', 'div class="site-footer"', 'footer class="page-footer"', 'div class="copyright"']
_SIDE = ['aside', 'div class="sidebar"', 'aside class="related"', 'div id="sidebar"', 'div class="widget"',
         'section class="related-posts"', 'div class="recommended"', 'div class="share social"', 'div class="tags"']
_NOTE = ['div class="cookie-notice"', 'div id="cookie-bar"', 'div class="cookies"', 'div id="cookie-banner"', 'div class="consent"', 'div role="alert"', 'div class="notice"',
         'div class="newsletter subscribe"', 'div class="popup modal"', 'dialog', 'section class="gdpr privacy"']
_ADS = ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'div class="sponsored"',
        'div id="ad-slot"', 'div class="promo"', 'aside class="ad"', 'section class="promotion"']
_FORM = ['form', 'form class="search"', 'form id="login"', 'form class="signup"', 'div class="search-box"']
_TALK = ['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="commentlist"',
         'section id="discussion"', 'div class="reader-comments"', 'div class="replies"', 'section class="user-comments"',
         'div id="disqus_thread"', 'div class="responses"']
#: Tags that stand for furniture without any attribute.
_TELLING = {"nav", "header", "footer", "aside", "form", "dialog"}


@dataclass
class _Layout:
    """A page written piece by piece, with the numbers of the texts that are main text."""
    rng: random.Random
    main: List[str]
    other: List[str]

    def text(self) -> str:
        return self.rng.choice(self.other)

    def wrap(self, head: str, inner: str) -> str:
        return f"<{head}>{inner}</{head.split()[0]}>"

    def links(self, n: int) -> str:
        words = [w for w in self.text().split() if w][:40] or ["home"]
        items = [f'<a href="/{k}">{escape(" ".join(self.rng.sample(words, min(len(words), self.rng.randint(1, 3)))))}</a>'
                 for k in range(n)]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " | ".join(items)

    def furniture(self, kinds: Sequence[str]) -> str:
        r = self.rng
        head = r.choice(kinds)
        if head.split()[0] in _TELLING and r.random() < 0.5:
            head = head.split()[0]          # the tag alone says it
        if kinds in (_MENU, _HEAD):
            return self.wrap(head, ("<p>" + escape(self.text()[:60]) + "</p>" if kinds is _HEAD else "") + self.links(r.randint(2, 8)))
        if kinds is _FORM:
            return self.wrap(head, f'<label>{escape(self.text()[:40])}</label><input type="text"><button>{escape(self.text()[:12])}</button>')
        if kinds is _TALK:
            tag = "li" if head.startswith("ol") else "div"
            return self.wrap(head, f"<h3>{escape(self.text()[:30])}</h3>" * (r.random() < 0.5) + "".join(
                f'<{tag} class="comment"><p>{escape(r.choice(self.main + self.other))}</p></{tag}>' for _ in range(r.randint(1, 5))))
        if kinds is _SIDE and r.random() < 0.6:
            return self.wrap(head, f"<h3>{escape(self.text()[:30])}</h3>" + self.links(r.randint(2, 6)))
        inner = escape(r.choice(self.main) if r.random() < 0.3 else self.text())
        return self.wrap(head, inner if r.random() < 0.5 else f"<p>{inner}</p>")

    def page(self) -> str:
        r = self.rng
        body = [self.wrap("h1" if k == 0 and r.random() < 0.7 else r.choice(["p"] * 8 + ["h2", "blockquote", "li", "div"]),
                          f'<span data-main="1"></span>{escape(t)}') for k, t in enumerate(self.main)]
        for kinds, chance in ((_ADS, 0.25), (_SIDE, 0.15), (_NOTE, 0.1), (_FORM, 0.25)):
            if r.random() < chance:
                body.insert(r.choice([r.randint(1, len(body)), len(body)]), self.furniture(kinds))
        if r.random() < 0.3:
            body.append(self.furniture(_TALK))
        inner = "".join(body)
        for head in ([r.choice(_BODY)] if r.random() < 0.8 else [r.choice(_BODY[-2:]), r.choice(_BODY)]):
            inner = self.wrap(head, inner)
        before = [self.furniture(k) for k, c in ((_NOTE, 0.3), (_HEAD, 0.5), (_MENU, 0.8), (_ADS, 0.5), (_FORM, 0.2)) if r.random() < c]
        after = [self.furniture(k) for k, c in ((_ADS, 0.3), (_SIDE, 0.5), (_TALK, 0.5), (_FORM, 0.2), (_NOTE, 0.2), (_MENU, 0.2),
                                                (_FOOT, 0.85)) if r.random() < c]
        if r.random() < 0.1:                # the article alone
            before, after = [], []
        if r.random() < 0.4:
            r.shuffle(before)
        return "<html><body>" + "".join(before) + inner + "".join(after) + "</body></html>"

    def bare_page(self) -> str:
        """A page whose main text stands directly in the body, with furniture beside it in elements and bare."""
        r = self.rng
        marked = [f'<span data-main="1"></span>{escape(t)}' for t in self.main]
        inner = r.choice(["<br>", "<br><br>", "<hr>"]).join(marked) if r.random() < 0.7 else "".join(
            x if r.random() < 0.5 else f"<p>{x}</p>" for x in marked)
        before = [self.furniture(k) for k, c in ((_NOTE, 0.2), (_HEAD, 0.4), (_MENU, 0.5), (_ADS, 0.3), (_FORM, 0.2)) if r.random() < c]
        after = [self.furniture(k) for k, c in ((_ADS, 0.2), (_SIDE, 0.3), (_TALK, 0.3), (_NOTE, 0.2), (_FOOT, 0.5)) if r.random() < c]
        for part in (before, after):
            if r.random() < 0.25:           # a bare row of links
                part.append(" | ".join(f'<a href="/{k}">{escape(self.text()[:r.randint(5, 20)])}</a>' for k in range(r.randint(2, 7)))
                            + "<hr>")
        if r.random() < 0.3:
            before.append("<h1>" + marked[0] + "</h1>")
        head = "<head><title>" + escape(self.text()[:40]) + "</title></head>" if r.random() < 0.5 else ""
        return "<html>" + head + "<body>" + "".join(before) + inner + ("<hr>" if r.random() < 0.3 else "") \
            + "".join(after) + "</body></html>"


_MARK = "\ue000"        # a private character marks the main texts of a layout


def training_rows(pages: Sequence[str], seed: int = 7, layouts: int = 800, bare_layouts: int = 200) -> Tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and labels of elements of ``layouts`` layouts made from the texts
    of ``pages`` and ``bare_layouts`` more with their main text directly in the
    body, and the odds of their attribute words."""
    rng = random.Random(seed)
    texts = sorted({t for p in pages for x in parse(p) for _, t, _ in x.runs})
    if len(texts) < 4:
        texts += ["A page.", "More of the page, with a second sentence.", "Home", "About us"]
    made: List[Tuple[List[Node], np.ndarray]] = []
    for number in range(layouts + bare_layouts):
        main = [rng.choice(texts) for _ in range(rng.choice([0, rng.randint(1, 14)]))] + [max(rng.sample(texts, 3), key=len)]
        short = rng.choice([0.1, 0.5, 1.0])
        main = [t[:rng.randint(8, 90)] if rng.random() < short else t for t in main]
        if rng.random() < 0.15:             # a very long paragraph, with stops or without
            main[-1] = " ".join([rng.choice([main[-1], main[-1].split()[0]])] * rng.randint(20, 400))
        other = [t[:rng.randint(10, 200)] for t in rng.sample(texts, min(8, len(texts)))]
        layout = _Layout(rng, main, other)
        page = (layout.page() if number < layouts else layout.bare_page()).replace('<span data-main="1"></span>', _MARK)
        nodes = parse(page)
        good: Set[int] = set()
        for x in nodes:
            if any(_MARK in t for _, t, _ in x.runs):
                while x is not None and id(x) not in good:
                    good.add(id(x))
                    x = x.parent
        for x in nodes:
            x.runs = [(o, t.replace(_MARK, ""), k) for o, t, k in x.runs]
        made.append((nodes, np.array([id(x) in good for x in nodes], np.float64)))
    seen = np.ones((2, ATTR_BUCKETS))
    for nodes, label in made:
        for x, y in zip(nodes, label):
            for k in token_buckets(x):
                seen[int(y), k] += 1
    odds = np.log(seen[1] / seen[0])
    return (features([nodes for nodes, _ in made], odds)[np.concatenate([np.arange(len(y)) > 0 for _, y in made])],
            np.concatenate([label[1:] for _, label in made]), odds)


# --- the trees


@dataclass
class TreeEnsemble:
    """Boosted trees as arrays; scores are margins (above 0: main text)."""
    trees: List[Tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    weights: List[float]
    odds: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total, row = np.zeros(len(x)), np.arange(len(x))
        for (feature, bound, left, right, value), w in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            while True:
                inner = left[at] >= 0
                if not inner.any():
                    break
                go = np.where(x[row, np.maximum(feature[at], 0)] <= bound[at], left[at], right[at])
                at = np.where(inner, go, at)
            total += w * value[at]
        return total


def train_extractor(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", sample: int = 200, seed: int = 7,
                    trees: int = 16, depth: int = 5) -> TreeEnsemble:
    """Fit the trees on layouts made from ``sample`` pages at most (a documented
    bound: those whose hashed ids come first), with MLlib's boosted trees."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    spark = pages.sparkSession
    first = pages.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()) \
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = pages.join(F.broadcast(first.withColumnRenamed("id", id_col)), id_col, "left_semi")
    taken = [r[0] or "" for r in chosen.select(html_col).limit(sample).collect()]
    x, y, odds = training_rows(taken, seed)
    import pandas as pd
    rows = spark.createDataFrame(pd.DataFrame({"x": [r.tolist() for r in x.astype(np.float64)], "label": y}))
    rows = materialise(rows.repartition(4), "dom-training").select(array_to_vector("x").alias("features"), "label").cache()
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32, minInstancesPerNode=5).fit(rows)
    rows.unpersist()
    path = scratch_path(spark, "dom-trees")
    model.write().save(path)
    nodes: Dict[int, list] = {}
    saved = spark.read.parquet(f"{path}/data")
    for r in saved.collect():              # at most trees * 2**(depth+1) rows
        nodes.setdefault(r[0], []).append(r[1])
    out = []
    for t in sorted(nodes):
        own = sorted(nodes[t], key=lambda d: d["id"])
        out.append((np.array([d["split"]["featureIndex"] for d in own]),
                    np.array([(d["split"]["leftCategoriesOrThreshold"] or [0.0])[0] for d in own]),
                    np.array([d["leftChild"] for d in own]), np.array([d["rightChild"] for d in own]),
                    np.array([d["prediction"] for d in own])))
    return TreeEnsemble(out, list(model.treeWeights), odds)


def decode(nodes: List[Node], score: np.ndarray) -> List[str]:
    """Texts of the best labelling without a kept element under a rejected one, in page order.

    An element that holds nothing decides nothing.  ``gain`` is the best total
    of an element's subtree given that the element is kept."""
    gain = score.tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if gain[i] > 0:
            gain[nodes[i].parent.index] += gain[i]
    keep = [True] * len(nodes)
    runs = []
    for i, x in enumerate(nodes):
        if i:
            keep[i] = keep[x.parent.index] and gain[i] > 0
        if x.runs and keep[i]:
            runs += [(o, t) for o, t, _ in x.runs]
    return [t for _, t in sorted(runs)]


def extract_main_text(pages: DataFrame, model: TreeEnsemble, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html", batch_elements: int = 20_000) -> DataFrame:
    """One row per input row: ``page_id, url, text`` (blocks of the main text in
    page order, joined by line ends) and ``n_chars`` (its code points).

    Defined cases: null or empty HTML gives an empty text; text directly in the
    body is scored like a block; a gain of 0 is no gain; ids and urls may be null or
    repeated; an empty table gives an empty result; other columns are not
    looked at."""
    ship_code(pages.sparkSession)
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).cast("string").alias("html"))
    schema = source.selectExpr("page_id", "url", "'' as text", "0L as n_chars").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: List[str] = []
            held: List[List[Node]] = []
            size = 0

            def settle():
                if held:
                    score = model.score(features(held, model.odds))
                    at = 0
                    for nodes in held:
                        out.append("\n".join(decode(nodes, score[at:at + len(nodes)])))
                        at += len(nodes)
                    held.clear()

            for page in b.column(2).to_pylist():
                held.append(parse(page or ""))
                size += len(held[-1])
                if size >= batch_elements:
                    settle()
                    size = 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, schema)
