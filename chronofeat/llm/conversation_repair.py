"""Conversation structure repair by a generalised LR parser.

The legal sequences of role initials are those of the grammar

    C -> (nothing) | P | s P        P -> u a | P u a

that is ``(s?(ua)+)?``.  A parser reads the rows of one conversation in order
and may edit them: keep a row (cost 0), rerole it to user or assistant (3),
delete it (4) or insert an empty row of user or assistant anywhere (3); a
truncated row that is not deleted adds 3, blank and repeated rows must go.
All parses run at once on a graph-structured stack: tops with equal states are
merged, their links downwards united, and the merged top keeps the minimum
``(cost, audit)``.  That loses nothing: what may follow a state of this
grammar does not depend on the stack below it, and two audits that end with
the same row are never prefixes of one another, so their order stays as it is
whatever follows.  For the same reason an audit's rank among the live tops
stands for its letters, and a row costs a constant number of steps.

Rows reach the parser sorted by conversation and turn, one after the other:
a conversation is never held, only its live tops (at most 8), one letter a row
for the audit, and a running SHA-256 per top.  The digest of a conversation is
a single stream of bytes, so one task reads a conversation, in bounded memory.

Cases.  Null roles and texts count as one space, null turns come first, a null
``conv_id`` is a conversation of its own.  Rows of one turn are taken by role,
then text; equal rows are interchangeable.  A conversation without rows gives
zeros, an empty audit and the digest of the empty string; an empty table gives
no rows.  Other columns are ignored, whatever their names.  Differences of
turns beyond 64 bits are given as the largest 64-bit number.
"""

from __future__ import annotations

import hashlib
from typing import Dict, Iterator, List, Optional, Tuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from .common import NOT_SPACE, ship_code

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# The LR(0) automaton of the grammar above.  States: 0 start, 1 after s, 2 P, 3 u, 4 s P, 5 u a, 6 P u, 7 P u a.
SHIFT = {(0, "s"): 1, (0, "u"): 3, (1, "u"): 3, (2, "u"): 6, (3, "a"): 5, (4, "u"): 6, (6, "a"): 7}
REDUCE = {5: 2, 7: 3}                      # state -> symbols that become one P
GOTO = {0: 2, 1: 4}                        # state below a new P -> state of that P
ACCEPT = (0, 2, 4)
ROLE = {"u": "user", "a": "assistant"}

FAULT = "CASE WHEN blank THEN 'blank' WHEN repeated THEN 'duplicate' WHEN truncated THEN 'truncated' END"
_PIECES = 1024                             # letters of an audit that are joined into one string


class Top:
    """A top of the graph-structured stack and the cheapest way to it.

    ``below`` holds one link for each state below; what lies under a state is
    alike in all stacks of this grammar.  ``rank`` orders the audits up to the
    last row, ``tail`` holds the letters after it, ``lines`` the output that
    ``digest`` (None: of nothing) does not hold yet."""
    __slots__ = ("state", "below", "cost", "rank", "tail", "audit", "digest", "lines")

    def __init__(self, state, below, cost, rank, tail, audit, digest, lines):
        self.state, self.below, self.cost, self.rank, self.tail = state, below, cost, rank, tail
        self.audit, self.digest, self.lines = audit, digest, lines

    def key(self):
        return self.cost, self.rank, self.tail

    def moved(self, state, below, cost, letter, line=None):
        return Top(state, below, self.cost + cost, self.rank, self.tail + letter, self.audit, self.digest,
                   self.lines + (line,) if line is not None else self.lines)


def _shift(top: Top, symbol: str, cost: int, letter: str, line: str) -> List[Top]:
    """The tops after ``symbol``: shifted, then reduced through every link."""
    state = SHIFT.get((top.state, symbol))
    if state is None:
        return []
    if state not in REDUCE:
        return [top.moved(state, (top,), cost, letter, line)]
    bases = [top]                          # the symbol itself is the first of those taken off
    for _ in range(REDUCE[state] - 1):
        bases = list({b.state: b for t in bases for b in t.below}.values())
    return [top.moved(GOTO[b.state], (b,), cost, letter, line) for b in bases]


def _merge(tops: Dict[int, Top], new: Top) -> bool:
    """Put ``new`` among the tops; whether its way is the cheapest to its state."""
    old = tops.get(new.state)
    if old is None:
        tops[new.state] = new
        return True
    links = {b.state: b for b in (*old.below, *new.below)}
    better = new.key() < old.key()
    best = new if better else old
    if len(links) > len(best.below):
        best.below = tuple(links.values())
    tops[new.state] = best
    return better


def _with_inserts(tops: Dict[int, Top]) -> Dict[int, Top]:
    """The tops and all that inserted rows lead to; each insert costs, so this ends."""
    out = dict(tops)
    work = list(tops.values())
    while work:
        top = work.pop()
        if out[top.state] is not top:
            continue                       # a cheaper way was found meanwhile
        for symbol, role in ROLE.items():
            for new in _shift(top, symbol, INSERT, "I", role + ":"):
                if _merge(out, new):
                    work.append(new)
    return out


class Conversation:
    """The parses of one conversation, row by row."""

    def __init__(self):
        self.tops = {0: Top(0, (), 0, 0, "", None, None, ())}
        self.n = 0

    def row(self, role: str, text: str, fault: Optional[str]) -> None:
        tops: Dict[int, Top] = {}
        symbol = role[:1]
        for top in _with_inserts(self.tops).values():
            _merge(tops, top.moved(top.state, top.below, DELETE, "D"))
            if fault in ("blank", "duplicate"):
                continue
            more = TRUNCATED if fault == "truncated" else 0
            for new in _shift(top, symbol, KEEP + more, "K", f"{role}:{text}"):
                _merge(tops, new)
            for s, name in ROLE.items():
                for new in _shift(top, s, REROLE + more, "R", f"{name}:{text}"):
                    _merge(tops, new)
        ranks = {k: i for i, k in enumerate(sorted({(t.rank, t.tail) for t in tops.values()}))}
        self.n += 1
        for top in tops.values():
            place = ranks[top.rank, top.tail]
            top.audit, top.rank, top.tail = _added(top.audit, top.tail, self.n % _PIECES == 0), place, ""
            top.digest, top.lines = _hashed(top.digest, top.lines), ()
        self.tops = tops

    def end(self) -> Tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired rows) of the cheapest parse."""
        ends = _with_inserts(self.tops)
        best = min((ends[s] for s in ACCEPT if s in ends), key=Top.key)
        pieces, link = [best.tail], best.audit
        while link is not None:
            link, piece = link
            pieces.append(piece)
        digest = _hashed(best.digest, best.lines) or hashlib.sha256()
        return best.cost, "".join(reversed(pieces)), digest.hexdigest()


def _added(audit, letters: str, join: bool):
    """The audit (a chain of strings) with ``letters``; now and then its last strings become one."""
    audit = (audit, letters)
    if join:
        pieces = []
        while audit is not None and len(audit[1]) < _PIECES:
            audit, piece = audit
            pieces.append(piece)
        audit = (audit, "".join(reversed(pieces)))
    return audit


def _hashed(digest, lines):
    """The digest after ``lines``; the given one stays as it is for other tops."""
    for n, line in enumerate(lines):
        if digest is None:
            digest = hashlib.sha256(line.encode())
        else:
            digest = digest.copy() if n == 0 else digest
            digest.update(b"\n" + line.encode())
    return digest


# ---------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage of the contract, by
    ``crc32("conv_id:turn") % 20``: 0 drops a row, 1 empties its text, 2 takes
    ``[.!?]`` out of it, 3 repeats it, 4 gives it the role user.  A dropped row
    stays as a mark (``gone``), so that its conversation is not lost."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"),
                                fate.alias("fate"))
    fate, gone = F.col("fate"), F.col("fate") == 0
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (fate == 1), "").when(fate == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"), gone.alias("gone"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")) \
        .drop("copy")


def undamaged(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form :func:`repair_conversations` takes."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"),
                                F.lit(False).alias("gone"))


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` in order, each with its first fault.

    One shuffle by conversation; repeated rows are found by a window within
    the same partitioning, which spills, instead of a set in memory."""
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    last = F.regexp_extract("text", rf"({NOT_SPACE})[\x20\x09-\x0D]*\z", 1)
    flags = rows.repartition("conv_id").select(
        "*", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"),
        (F.row_number().over(seen) > 1).alias("repeated"))
    return flags.select("conv_id", "turn", "role", "text", "gone", F.expr(FAULT).alias("fault"), "repeated") \
        .sortWithinPartitions("conv_id", "gone", F.col("turn").asc_nulls_first(), "role", "text", "repeated") \
        .drop("repeated")


_LEGAL = {"su", "ua", "au"}
_MOST = (1 << 63) - 1


class _Tally:
    """Counts and parses of the conversation that is being read."""

    def __init__(self, conv_id):
        self.conv_id, self.parse = conv_id, Conversation()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first = self.last = self.initial = None

    def add(self, turn, role, text, fault):
        if fault:
            self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.last:      # rows come by turn
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.parse.row(role, text, fault)

    def result(self):
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, _MOST)
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, *self.parse.end())


def _repaired(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv_id, turn, role, text, gone, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result())
                    now = _Tally(conv_id)
                if not gone:
                    now.add(turn, role, text, fault)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)],
                                                 schema=schema)
                done = []
        if now is not None:
            done.append(now.result())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    return run


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    ``rows`` has ``conv_id, turn, role, text, gone`` (see :func:`undamaged`);
    the texts of the repair itself come from :func:`repaired_turns`."""
    ship_code(rows.sparkSession)
    out = T.StructType([rows.schema["conv_id"]]
                       + [T.StructField(c, T.LongType()) for c in
                          ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                       + [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    return with_faults(rows).mapInArrow(_repaired(to_arrow_schema(out)), out)


def _edited(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, position, expected = "", 0, 0, None
        for batch in batches:
            done = []

            def put(conv_id, role, text):
                nonlocal position, expected
                done.append((conv_id, position, role, text))
                position, expected = position + 1, "a" if expected == "u" else "u"

            def inserts(conv_id):
                nonlocal at
                while audit[at:at + 1] == "I":
                    put(conv_id, ROLE[expected], "")
                    at += 1

            for conv_id, turn, role, text, gone, fault, edits, kind in zip(*[c.to_pylist() for c in batch.columns]):
                if kind == 0:
                    audit, at, position, expected = edits, 0, 0, "u"
                elif kind == 2:
                    inserts(conv_id)       # those behind the last row
                elif not gone:
                    inserts(conv_id)
                    edit, at = audit[at], at + 1
                    if edit == "K" and role[:1] == "s":
                        done.append((conv_id, position, role, text))
                        position += 1
                    elif edit != "D":
                        put(conv_id, role if edit == "K" else ROLE[expected], text)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema) \
                if done else pa.RecordBatch.from_pylist([], schema=schema)
    return run


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, role, text``.

    Each conversation's audit is sorted before its rows and walked along with
    them; what a letter means follows from the grammar, for after an optional
    kept system row users and assistants alternate."""
    ship_code(rows.sparkSession)
    faults = with_faults(rows)

    def null(c):
        return F.lit(None).cast(faults.schema[c].dataType).alias(c)
    marks = repairs.select("conv_id", *[null(c) for c in faults.columns if c != "conv_id"],
                           F.col("audit").alias("edits"), F.explode(F.array(F.lit(0), F.lit(2))).alias("kind"))
    both = faults.withColumns({"edits": F.lit(None).cast("string"), "kind": F.lit(1)}).unionByName(marks)
    out = T.StructType([rows.schema["conv_id"], T.StructField("position", T.LongType()),
                        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return both.repartition("conv_id").sortWithinPartitions(
        "conv_id", "kind", "gone", F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == "duplicate") \
        .mapInArrow(_edited(to_arrow_schema(out)), out)
