"""Quality classifier trained from weak labels.

Heuristic labellers vote on every document (good, bad or no vote).  Their
votes overlap and err; expectation-maximisation over the counts of all vote
patterns estimates how often each labeller votes what for good documents and
for each kind of bad ones, and with that every pattern's posterior.  The posteriors label a
bounded sample of documents, on which a linear scorer over hashed words and
word shapes is fitted; it then scores every document.  Votes and hashes are
computed with numpy over blocks of texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Dict, Iterator, List, Tuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _blocks
from .common import ship_code
from .shingles import _SPACE, _hashes_of

#: The labellers; a vote is 1 (good), 0 (bad) or - (none).
LABELLERS = ("length", "symbols", "capitals", "variety", "lines", "words", "stops", "marks")

_SYMBOL, _CAPITAL, _STOP, _MARK = (np.isin(np.arange(256), list(x)).astype(np.int64) for x in (
    b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;", b"!?"))
#: Byte classes of word shapes: capitals, small letters (and all of other scripts), digits; the rest as it is.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[[*range(97, 123), *range(128, 256)]] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def measure(texts: List[str], buckets: int) -> Tuple[List[str], np.ndarray, np.ndarray]:
    """(votes of each text, hashed words and word shapes of all texts back to
    back, bounds of each text's words there).

    Labellers vote bad, good (else none) on whole texts: ``length`` under 5
    words, over 20; ``symbols`` ``#*$%&|<>`` per word over 0.2, under 0.02;
    ``capitals`` per byte over 0.3, under 0.1; ``variety`` (distinct words among
    words) under 0.2, over 0.35; ``lines`` with a word that repeat an earlier one
    over 0.5, none; ``words`` of mean length outside 2-15 bytes, within 3-10;
    ``stops`` (``.,;``) per word under 0.005, over 0.02; ``marks`` (``!?``) per word
    over 0.3, under 0.05.  A text without words gets bad votes only."""
    datas = [t.encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b" ".join(datas), np.uint8)
    with np.errstate(over="ignore"):
        h, starts = _hashes_of(b)
        # shapes: one byte for every run of a class
        shape = _SHAPE[b]
        keep = np.ones(len(b), bool)
        keep[1:] = (shape[1:] != shape[:-1]) | _SPACE[b[1:]]
        forms, _ = _hashes_of(shape[keep])
    bounds = np.cumsum([0] + [len(d) + 1 for d in datas])
    cut = np.searchsorted(starts, bounds)
    n = np.diff(cut)
    owner = np.repeat(np.arange(len(texts)), n)
    by = np.lexsort((h, owner))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[by][1:] != h[by][:-1]) | (owner[by][1:] != owner[by][:-1])
    distinct = np.bincount(owner[by][fresh], minlength=len(texts))
    some = np.maximum(n, 1)

    def per(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags[b])])
        return total[np.minimum(bounds[1:] - 1, len(b))] - total[bounds[:-1]]

    size = np.array([len(d) for d in datas])
    repeated = []
    for t in texts:
        lines = [x for x in t.split("\n") if x and not x.isspace()]
        repeated.append(1 - len(set(lines)) / len(lines) if lines else 1.0)
    repeated = np.array(repeated)
    symbols, capitals = per(_SYMBOL) / some, per(_CAPITAL) / np.maximum(size, 1)
    stops, marks, variety = per(_STOP) / some, per(_MARK) / some, distinct / some
    mean = per((~_SPACE).astype(np.int64)) / some
    empty = n == 0
    pairs = [(n < 5, n > 20), (symbols > 0.2, symbols < 0.02), (capitals > 0.3, capitals < 0.1),
             (variety < 0.2, variety > 0.35), (repeated > 0.5, repeated == 0), ((mean < 2) | (mean > 15), (mean >= 3) & (mean <= 10)),
             (stops < 0.005, stops > 0.02), (marks > 0.3, marks < 0.05)]
    marked = np.stack([np.where(bad | empty, "0", np.where(good, "1", "-")) for bad, good in pairs], 1)
    m = np.uint64(buckets // 2)
    hashed = np.stack([h % m, forms % m + m], 1).astype(np.int64)
    return ["".join(r) for r in marked.tolist()], hashed, cut


@dataclass
class LabelModel:
    """Shares of the good documents and of each kind of bad ones (kind k: the
    fault that labeller k is written for), and for each labeller and class
    (good, then the kinds) the chance of each vote (none, bad, good)."""
    share: np.ndarray               # (1 + labellers,)
    chance: np.ndarray              # (labellers, 1 + labellers, 3)

    @property
    def good(self) -> float:
        return float(self.share[0])

    def classes(self, votes: np.ndarray) -> np.ndarray:
        """Chance of every class for documents with these votes (rows of -1, 0, 1)."""
        logs = np.log(self.share) + sum(np.log(self.chance[k][:, votes[:, k] + 1]).T for k in range(votes.shape[1]))
        p = np.exp(logs - logs.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that a document with these votes is good."""
        return self.classes(votes)[:, 0]


def fit_label_model(votes: np.ndarray, weight: np.ndarray, rounds: int = 200, false_alarm: float = 0.005) -> LabelModel:
    """Expectation-maximisation over vote patterns and their numbers of documents.

    Most bad documents have one fault, on which one or two labellers vote bad
    and all others good.  With a single bad class the most frequent fault would
    define it, so every labeller has a kind of its own.  Starts from each
    pattern's bad votes, shared evenly among their kinds (none: good), so the
    classes keep their names; counts are smoothed by a hundredth of a document
    a vote.  Labellers are written to be precise rather than complete: the
    share of bad votes on good documents is held to ``false_alarm``, and a
    labeller votes bad on at least half of its own kind."""
    n = votes.shape[1]
    bad = (votes == 0).astype(np.float64)
    p = np.concatenate([(bad.sum(1) == 0)[:, None], bad / np.maximum(bad.sum(1), 1)[:, None]], 1) * 0.98 + 0.02 / (n + 1)
    own = np.arange(n)
    model = None
    for _ in range(rounds):
        resp = p * weight[:, None]
        chance = np.stack([np.stack([resp[votes[:, k] == v].sum(0) for v in (-1, 0, 1)], 1) for k in range(n)]) + 0.01
        chance /= chance.sum(2, keepdims=True)
        chance[:, 0, 1] = np.minimum(chance[:, 0, 1], false_alarm)
        chance[own, own + 1, 1] = np.maximum(chance[own, own + 1, 1], 0.5)
        model = LabelModel((resp.sum(0) + 0.01) / (resp.sum() + 0.01 * (n + 1)), chance)
        new = model.classes(votes)
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model


@dataclass
class LinearScorer:
    """Weights of hashed words; a text's score is the logistic of the mean weight
    of its words and shapes (scaled by ``gain``) plus ``bias``."""
    weights: np.ndarray
    bias: float
    gain: float = 8.0

    def score(self, hashed: np.ndarray, cut: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.weights[hashed].sum(1))])
        n = np.maximum(2 * np.diff(cut), 1)
        z = self.gain * (total[cut[1:]] - total[cut[:-1]]) / n + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_scorer(rows: List[Tuple[np.ndarray, float]], buckets: int, epochs: int = 30, rate: float = 0.5) -> LinearScorer:
    """Logistic regression on ``(hashed words, chance of good)`` by adaptive
    gradient steps over batches, in the order given."""
    model = LinearScorer(np.zeros(buckets), 0.0)
    squares, bias_square = np.full(buckets, 1e-3), 1e-3
    for _ in range(epochs):
        for k in range(0, len(rows), 256):
            part = rows[k:k + 256]
            flat = np.concatenate([r for r, _ in part])
            n = np.array([len(r) for r, _ in part])
            cut = np.concatenate([[0], np.cumsum(n)]) // 2
            error = model.score(flat.reshape(-1, 2), cut) - np.array([y for _, y in part])
            grad = np.bincount(flat, np.repeat(error * model.gain / np.maximum(n, 1), n), buckets) / len(part)
            squares += grad * grad
            model.weights -= rate * grad / np.sqrt(squares)
            step = float(error.mean())
            bias_square += step * step
            model.bias -= rate * step / np.sqrt(bias_square)
    return model


def vote(docs: DataFrame, buckets: int, with_words: bool = False) -> DataFrame:
    """``doc_id, votes`` of ``docs`` (``doc_id, text``), and the hashed words if asked for."""
    ship_code(docs.sparkSession)
    schema = docs.selectExpr("doc_id", "'' as votes", *["array(0L) as words"] * with_words).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches, 2 << 20):
            votes, hashed, cut = measure(texts, buckets)
            cols = [ids, pa.array(votes, pa.string())]
            if with_words:
                cols.append(pa.ListArray.from_arrays(pa.array(2 * cut, pa.int32()), pa.array(hashed.ravel(), pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "votes", "words"][:len(cols)])

    return docs.mapInArrow(run, schema)


def train_quality(docs: DataFrame, sample: int = 5_000, sample_words: int = 1_000, buckets: int = 1 << 14,
                  seed: int = 11) -> Tuple[Dict[str, float], LinearScorer]:
    """(posterior of every vote pattern, scorer).  The label model takes in all
    documents, by pattern (at most 3**8 reach the driver).  The scorer is fitted
    on about ``sample`` documents chosen by hash (the first ``2 * sample`` by hash, id and words
    at most, so a table gives the same model on each run), on ``sample_words`` words of each
    (spread evenly over the text): documented bounds of the training set only."""
    patterns = {r[0]: r[1] for r in vote(docs, buckets).groupBy("votes").count().collect()}
    if not patterns:
        return {}, LinearScorer(np.zeros(buckets), 0.0)
    votes = np.array([["-01".index(v) - 1 for v in p] for p in patterns], np.int64)
    weight = np.array(list(patterns.values()), np.float64)
    post = dict(zip(patterns, fit_label_model(votes, weight).posterior(votes).tolist()))
    share = min(1.0, sample / float(weight.sum()))
    chosen = docs.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    step = F.greatest(F.ceil(F.size("words") / F.lit(2 * sample_words)), F.lit(1)).cast("int")
    rows = vote(chosen, buckets, True).select("doc_id", "votes", F.expr("words").alias("words"), step.alias("step")) \
        .select("doc_id", "votes", F.filter("words", lambda x, i: (F.floor(i / 2) % F.col("step")) == 0).alias("words")) \
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "votes", "words").limit(2 * sample).collect()
    rows.sort(key=lambda r: (str(r.doc_id), r.votes, r.words[:8]))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    return post, fit_scorer([(np.array(rows[i].words, np.int64), post[rows[i].votes]) for i in order], buckets)


def quality_classifier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
                       sample: int = 5_000, buckets: int = 1 << 14) -> DataFrame:
    """One row per input row: ``doc_id, votes`` (of :data:`LABELLERS`), ``label_p``
    (their posterior), ``score`` (the scorer's chance of good) and ``kept`` (mean of
    both at least ``threshold``).

    Defined cases: null text counts as empty and is not kept; ids may be null or
    repeated; an empty table gives an empty result; other columns are not
    looked at."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    post, scorer = train_quality(rows, sample, buckets=buckets)
    schema = rows.selectExpr("doc_id", "'' as votes", "0.0D as label_p", "0.0D as score", "true as kept").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches, 2 << 20):
            votes, hashed, cut = measure(texts, buckets)
            p = np.array([post[v] for v in votes])
            score = scorer.score(hashed, cut)
            kept = (p + score >= 2 * threshold) & (np.diff(cut) > 0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(votes, pa.string()), pa.array(np.round(p, 6)), pa.array(np.round(score, 6)),
                 pa.array(kept)], ["doc_id", "votes", "label_p", "score", "kept"])

    return rows.mapInArrow(run, schema)
