"""Personal data by fixed rules and a character tagger.

The rules of :mod:`.pii_rules` give the base spans.  A bidirectional LSTM with
a CRF (:mod:`.chartagger`) adds spans of the same kinds in other writing: an
address with "(at)", a phone number without its plus, a card number with dots,
an ip address with "[.]".

The tagger is trained on labelled spans: what the rules find in a bounded
sample of the table's own passages, and generated values of each kind in the
base and in other writing, set into those passages; dates, prices, versions,
digests and the like are set in as counter-examples.  It reads windows of
``WIDTH`` characters that overlap by half.  A span of any kind holds a digit,
an ``@`` or an "at" in brackets, so windows without these cannot hold one and
are not read; all others are, in texts of any length.  The windows of a text
are reconciled as a whole: spans that a window's edge cuts are replaced by
those of the neighbour or joined with them, and of overlapping spans the set
of the greatest score is kept.  A span must then pass the checks of its kind
(digits, Luhn, parts up to 255) and may not touch a base span.

Cases.  A null text is empty and has no spans; an empty table gives no rows,
and the tagger is trained on generated spans alone; equal rows give equal
rows.  Of equal scores the earlier span, then the earlier kind stays.  A text
is held whole by one task, its windows in batches of ``BATCH``.  Columns of the
table other than those named are ignored, whatever their names.
"""

from __future__ import annotations

import random
import re
from typing import Dict, Iterator, List, NamedTuple, Sequence, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .chartagger import CharTagger, char_classes
from .common import ship_code
from .pii_rules import KINDS, base_spans, luhn, plausible

WIDTH, STRIDE, BATCH = 128, 64, 512
LEAST_SCORE = 0.8                          # mean marginal of a span's tags
SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean>>"

#: What every span holds, for Arrow's and for Python's regular expressions.
_ANY = r"[0-9@]|[(\[{][ \t]?[aA][tT][ \t]?[)\]}]"
_RUNS = re.compile(r"[0-9@]+|[(\[{][ \t]?[aA][tT][ \t]?[)\]}]")


# -- labelled spans ---------------------------------------------------------

def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _word(rng: random.Random, least: int, most: int) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(least, most)))


def generated(kind: str, rng: random.Random) -> str:
    """A value of ``kind`` as the base rules take it."""
    if kind == "email":
        local = _word(rng, 2, 9) + rng.choice(["", "", ".", "_", "-"]) + rng.choice([_word(rng, 2, 8), _digits(rng, 2), ""])
        return f"{local.rstrip('._-')}@{_word(rng, 3, 9)}{rng.choice(['', _digits(rng, 1)])}" \
               f"{rng.choice(['', '.' + _word(rng, 4, 7)])}.{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es', 'io'])}"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        body = rng.choice("3456") + _digits(rng, 14)
        number = body + next(d for d in "0123456789" if luhn(body + d))
        sep = rng.choice(["", " ", "-"])
        return sep.join(number[i:i + 4] for i in range(0, 16, 4))
    area, line = str(rng.randrange(200, 990)), f"{rng.randrange(200, 999)}-{_digits(rng, 4)}"
    return rng.choice([f"+1 ({area}) {line}", f"+1-{area}-{line}", f"+1 {area} {line.replace('-', ' ')}",
                       f"+{rng.randrange(30, 50)} {area} {_digits(rng, 7)}"])


def rewritten(kind: str, value: str, rng: random.Random) -> str:
    """``value`` in a writing that the base rules do not take."""
    if kind == "email":
        name, _, domain = value.partition("@")
        at = rng.choice([" (at) ", "(at)", "[at]", " [at] ", " @ ", "{at}"])
        return name + at + domain.replace(".", rng.choice([".", ".", " dot ", "(dot)", "[dot]", "[.]"]))
    if kind == "ip":
        return value.replace(".", rng.choice(["[.]", " . ", "(.)", "[dot]"]))
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        sep = rng.choice([".", "/", "_", "  ", " - "])
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    d = digits[-10:].rjust(10, "5")
    return rng.choice([f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}",
                       f"1-{d[:3]}-{d[3:6]}-{d[6:]}", f"1 ({d[:3]}) {d[3:6]}-{d[6:]}", f"+1/{d[:3]}/{d[3:6]}/{d[6:]}",
                       f"001 {d[:3]} {d[3:6]} {d[6:]}"])


def harmless(rng: random.Random) -> str:
    """Text with digits or an ``@`` that is no personal data."""
    year = str(rng.randrange(1900, 2030))
    return rng.choice([
        year, f"{year}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}", f"{rng.randrange(1, 29)}/{rng.randrange(1, 13)}/{year}",
        f"{rng.randrange(24)}:{_digits(rng, 2)}", f"${rng.randrange(1, 999)},{_digits(rng, 3)}.{_digits(rng, 2)}",
        f"v{rng.randrange(9)}.{rng.randrange(20)}.{rng.randrange(9)}", f"{rng.randrange(9)}.{_digits(rng, 5)}",
        "".join(rng.choice("0123456789abcdef") for _ in range(32)), f"#{_digits(rng, 7)}", f"{rng.randrange(100)}%",
        f"{rng.randrange(100)}-{rng.randrange(100, 200)}", f"978-3-{_digits(rng, 2)}-{_digits(rng, 6)}-{_digits(rng, 1)}",
        f"{year}{_digits(rng, 9)}", f"@{_word(rng, 4, 9)}", f"{_word(rng, 3, 5)}@{_word(rng, 3, 6)}", f"{_digits(rng, 6)}",
        f"{_word(rng, 2, 4).upper()}{_digits(rng, 10)}", f"key = {_word(rng, 4, 6)}{_digits(rng, 12)}", f"{year}.",
        f"{rng.randrange(9)}.{rng.randrange(9)}.", f"{year}-{str(int(year) + 1)}"])


def tags_of(length: int, spans: Sequence[Tuple[int, str, int]]) -> List[int]:
    """Begin and inside tags of ``(start, kind, end)``; of overlapping spans the first counts."""
    tags = [0] * length
    for start, kind, end in spans:
        if not any(tags[start:end]):
            begin = 1 + 2 * KINDS.index(kind)
            tags[start:end] = [begin] + [begin + 1] * (end - start - 1)
    return tags


def _put(carrier: str, value: str, kind: str, rng: random.Random) -> Tuple[str, List[Tuple[int, str, int]]]:
    """``value`` between two words of a piece of ``carrier``."""
    first, size = rng.randrange(max(1, len(carrier) - 40)), rng.randrange(8, 64)
    carrier = carrier[first:first + size]
    gaps = [0] + [m.end() for m in re.finditer(r"\s", carrier)] + [len(carrier)]
    at = rng.choice(gaps)
    before, after = carrier[:at], carrier[at:]
    before += "" if not before or before[-1].isspace() else " "
    text = before + value + (rng.choice(["", "", ",", "."]) + " " + after if after else rng.choice(["", "."]))
    return text, [(len(before), kind, len(before) + len(value))] if kind else []


def labelled_examples(passages: Sequence[str], per_kind: int = 150, seed: int = 0) -> List[Tuple[str, List[int]]]:
    """``(text, tags)`` from passages of the table: the spans that the rules
    find in them, and ``per_kind`` generated spans of each kind in either
    writing, and as many counter-examples."""
    rng = random.Random(seed)
    out, carriers = [], []
    for p in passages:
        p = p[:WIDTH]
        spans = base_spans(p)
        whole = [s for s in spans if s[3] < len(p) or len(p) < WIDTH]
        cut = min((s[0] for s in spans if s not in whole), default=len(p))
        out.append((p[:cut], tags_of(cut, [(a, k, b) for a, _, k, b in whole if b <= cut])))
        for a, _, _, b in reversed(spans):
            p = p[:a] + p[b:]
        carriers.append(re.sub(r"[0-9@]+", "", p))
    carriers = carriers or ["the text of a page, and on"]
    for n in range(per_kind):
        for kind in KINDS:
            value = generated(kind, rng)
            for v in (value, rewritten(kind, value, rng)):
                text, spans = _put(rng.choice(carriers), v, kind, rng)
                out.append((text, tags_of(len(text), spans)))
        for _ in range(3):
            text, _ = _put(rng.choice(carriers), harmless(rng), "", rng)
            out.append((text, [0] * len(text)))
    return [(t, g) for t, g in out if t]


def sampled_passages(docs: DataFrame, text: str = "text", passages: int = 300) -> List[str]:
    """At most ``passages`` passages of ``WIDTH`` characters around the first
    digit or ``@`` of a text: distinct ones, least hash first, so the same in
    every run and whatever the partitions."""
    at = F.regexp_instr(F.col(text), F.lit("[0-9@]"))
    found = docs.select(F.substring(text, F.greatest(at - 60, F.lit(1)), F.lit(WIDTH)).alias("passage"), at.alias("at")) \
        .where("at > 0").select("passage").distinct()
    return [r.passage for r in found.orderBy(F.xxhash64("passage"), "passage").limit(passages).collect()]


def train_tagger(docs: DataFrame, text: str = "text", passages: int = 300, per_kind: int = 150, epochs: int = 8,
                 hidden: int = 20, seed: int = 0) -> CharTagger:
    """A tagger for this table.  What reaches the driver is bounded by
    ``passages`` times ``WIDTH`` characters; the examples are that many and
    eleven times ``per_kind``."""
    tagger = CharTagger(len(KINDS), hidden, seed)
    tagger.fit(labelled_examples(sampled_passages(docs, text, passages), per_kind, seed), WIDTH, epochs=epochs, seed=seed)
    return tagger


# -- windows ----------------------------------------------------------------

class Proposal(NamedTuple):
    start: int
    kind: int
    end: int
    score: float
    cut: bool


def window_starts(text: str) -> List[int]:
    """Starts of the windows that hold a digit, an ``@`` or an "at" in brackets."""
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    out = set()
    for m in _RUNS.finditer(text):
        first = m.start() // STRIDE
        out.update(range(max(0, first - 1), min((m.end() - 1) // STRIDE, last) + 1))
        if first > last:
            out.add(last)
    return [k * STRIDE for k in sorted(out)]


def proposals(tags: np.ndarray, scores: np.ndarray, start: int, size: int, length: int) -> List[Proposal]:
    """The spans of one decoded window; ``cut``: it touches an edge inside the text."""
    out, at = [], 0
    tags = tags[:size].tolist()
    while at < size:
        if tags[at] == 0:
            at += 1
            continue
        kind, end = (tags[at] - 1) // 2, at + 1
        while end < size and tags[end] == 2 * kind + 2:
            end += 1
        cut = (at == 0 and start > 0) or (end == size and start + size < length)
        out.append(Proposal(start + at, kind, start + end, float(scores[at:end].mean()), cut))
        at = end
    return out


def reconciled(found: Sequence[Proposal]) -> List[Proposal]:
    """One set of non-overlapping spans for a whole text."""
    whole = {}
    for p in found:
        if not p.cut:
            key = p[:3]
            whole[key] = max(p, whole.get(key, p), key=lambda x: x.score)
    joined: List[Proposal] = []
    for p in sorted(p for p in found if p.cut):
        if any(w.kind == p.kind and w.start < p.end and p.start < w.end for w in whole.values()):
            continue                       # another window saw it whole
        last = joined[-1] if joined else None
        if last and last.kind == p.kind and p.start < last.end:
            joined[-1] = Proposal(last.start, p.kind, max(last.end, p.end), min(last.score, p.score), True)
        else:
            joined.append(p)
    spans = sorted([*whole.values(), *joined], key=lambda p: (p.end, p.start, p.kind))
    best: List[Tuple[float, tuple]] = [(0.0, ())]      # of the spans up to here, as a linked list
    ends = [p.end for p in spans]
    for n, p in enumerate(spans):
        before = int(np.searchsorted(ends[:n], p.start, side="right"))
        with_p = best[before][0] + p.score * (p.end - p.start)
        best.append((with_p, (p, best[before][1])) if with_p > best[n][0] else best[n])
    out, link = [], best[-1][1]
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def added_spans(text: str, found: Sequence[Proposal], base: Sequence[tuple]) -> List[tuple]:
    """The reconciled spans that pass the checks and touch no base span."""
    out = []
    for p in reconciled(found):
        if p.score < LEAST_SCORE or any(a < p.end and p.start < b for a, _, _, b in base):
            continue
        if plausible(KINDS[p.kind], text[p.start:p.end]):
            out.append((p.start, p.kind, KINDS[p.kind], p.end))
    return out


def _find(tagger: CharTagger, kept: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(kept)
            hits = np.flatnonzero(pc.fill_null(pc.match_substring_regex(col, _ANY), False).to_numpy(zero_copy_only=False))
            spans: Dict[int, list] = {}
            waiting: List[Tuple[int, int, str, int]] = []      # row, start, window, length of the text
            found: Dict[int, List[Proposal]] = {}

            def decode():
                tags, scores = tagger.decode(char_classes([w[2] for w in waiting], max(len(w[2]) for w in waiting)))
                for (row, start, window, length), t, s in zip(waiting, tags, scores):
                    found.setdefault(row, []).extend(proposals(t, s, start, len(window), length))
                waiting.clear()
            for row in hits.tolist():
                text = col[row].as_py()
                spans[row] = base_spans(text)
                for start in window_starts(text):
                    waiting.append((row, start, text[start:start + WIDTH], len(text)))
                    if len(waiting) == BATCH:
                        decode()
            if waiting:
                decode()
            for row, proposed in found.items():
                more = added_spans(col[row].as_py(), proposed, spans[row])
                spans[row] = sorted([(*s, True) for s in spans[row]] + [(*s, False) for s in more])
            lists = [[dict(zip(("start", "rank", "kind", "end", "base"), s)) for s in spans.get(row, ())]
                     for row in range(len(col))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array(lists, schema.field("spans").type)], schema=schema)
    return run


def find_personal_data(docs: DataFrame, tagger: CharTagger, text: str = "text",
                       keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``spans``: all spans of the whole text by start,
    then kind; ``base`` tells those of the fixed rules.  ``keep`` may not name
    a column ``spans`` (ValueError)."""
    if "spans" in keep:
        raise ValueError("the result has a column 'spans' of its own")
    ship_code(docs.sparkSession)
    rows = docs.select(*keep, F.col(text).cast("string").alias("__cf_text"))
    out = T.StructType([*rows.schema.fields[:-1],
                        T.StructField("spans", T._parse_datatype_string(SPANS))])
    return rows.mapInArrow(_find(tagger, len(keep), to_arrow_schema(out)), out)


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
