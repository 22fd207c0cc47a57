"""The trie of shared conversation prefixes, with subtree totals.

A node is a distinct sequence of first turns; its members are the
conversations that start with it.  Subtree totals (childless nodes, tokens that
sharing saves) are found by time-forward processing:

1. One shuffle brings the rows of a group of conversations together, in order;
   a chained 128-bit BLAKE2 names every prefix.  From here on only names
   travel, no texts.  Equal prefixes are counted with map-side partial sums.
2. Nodes are laid out in depth-first order of their path (the first 8 bytes of
   the names of the first 32 ancestors) and cut into shards of about equal
   size, wherever that falls: a turn that a third of all conversations share
   just spreads over many shards.  The cut points come from a bounded sample of
   nodes (they decide balance alone, never a result).
3. Within a shard, Spark's external sort brings the nodes in reverse level
   order.  Each node takes the totals its children sent it out of a priority
   queue, which spills sorted runs, and sends its own to its parent.  Nodes
   whose subtree reaches into the next shard (prefixes of the next cut point,
   at most 32) stay open; totals for a parent in an earlier shard (at most 32
   parents) leave the shard as one message each.
4. Open nodes and messages, at most 64 rows a shard, go through the same
   processing once more, across the shard roots.

Conversations that end at one node are hashed in order of their ids, which is
one stream of bytes: ids are joined in blocks of up to 4,096 neighbours by a
distributed aggregate first, and the blocks of a node stream through its shard.

Cases.  Null roles and texts are empty, null turns come first, rows of one turn
are taken by role, then text.  Rows without a ``conv_id`` belong to no
conversation and are left out.  An empty table has no nodes, not even a root.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from bisect import bisect_right
from typing import Callable, Iterator, List, Tuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship_code

ROOT = bytes(16)
GROUP = 100                                # conversations that share the first turns of the one numbered c - c % 100
MOST_SHARED = 5                            # crc32(c) % 6 turns of it
PATH_DEPTH = 32
ID_BLOCK = 12                              # ids are joined in blocks of 2 ** 12
SAMPLED = 16                               # nodes a shard in the sample for the cuts
HOT_CHILDREN = 1000                        # a parent of more than a 1000th of all nodes is joined by broadcast

NODE, MESSAGE, ENDS = 0, 1, 2              # rows of the time-forward pass, in this order for one node
DONE, OPEN, SENT = 0, 1, 2                 # what it gives


def grafted(conversations: DataFrame) -> DataFrame:
    """The rows of whole conversations in the form :func:`prefix_trie` takes:
    every conversation with the first turns of its group's leader (the contract)."""
    c = F.col("conv_id").cast("long")
    return conversations.select(
        c.alias("conv_id"), "turn", "role", "text", F.try_subtract(c, F.pmod(c, F.lit(GROUP))).alias("leader"),
        (F.crc32(c.cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("shared"))


def ungrafted(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the form :func:`prefix_trie` takes."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text",
                                F.lit(None).cast("long").alias("leader"), F.lit(0).cast("long").alias("shared"))


def child_name(name: bytes, role: str, text: str) -> bytes:
    r = role.encode()
    return hashlib.blake2b(name + struct.pack("<q", len(r)) + r + text.encode(), digest_size=16).digest()


_PREFIX = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("path", pa.binary()),
                     ("tokens", pa.int64()), ("conv_id", pa.int64()), ("last", pa.bool_())])
_PREFIX_DDL = "node binary, parent binary, depth long, path binary, tokens long, conv_id long, last boolean"


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every prefix of every rebuilt conversation; ``last`` marks the whole of it.

    Holds the first turns of the group's leader and the present prefix."""
    out: List[tuple] = []
    leader, head = None, []
    conv_id, at, skip, row = None, 0, 0, None

    def grow(role, text):
        nonlocal row
        out.append((*row, False))
        name = child_name(row[0], role, text)
        depth = row[2] + 1
        row = (name, row[0], depth, row[3] + name[:8] if depth <= PATH_DEPTH else row[3], len(text), conv_id)

    def flush():
        done, out[:] = list(zip(*out)), []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(done, _PREFIX)], schema=_PREFIX)

    for batch in batches:
        for c, _, role, text, lead, shared in zip(*[x.to_pylist() for x in batch.columns]):
            if c != conv_id:
                if row is not None:
                    out.append((*row, True))
                if lead != leader:
                    leader, head = lead, []
                conv_id, at, row = c, 0, (ROOT, None, 0, b"", 0, c)
                skip = shared if c != lead else 0      # the leader's own turns stay as they are
                for turn in head[:skip]:
                    grow(*turn)
            if c == leader and len(head) < MOST_SHARED:
                head.append((role, text))
            at += 1
            if at > skip:
                grow(role, text)
            if len(out) >= 8192:
                yield flush()
    if row is not None:
        out.append((*row, True))
    if out:
        yield flush()


class SpillingQueue:
    """A priority queue of ``(level, name, children, leaves, saved)`` that
    keeps at most ``limit`` entries in memory: beyond, they go as a sorted run
    to an unnamed file of this task, which ends with it."""
    _ROW = struct.Struct("<q16sqqq")

    def __init__(self, limit: int = 100_000):
        self.limit, self.heap, self.runs, self.spills = limit, [], [], 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) >= self.limit:
            f = tempfile.TemporaryFile()
            for e in sorted(self.heap):
                f.write(self._ROW.pack(*e))
            f.seek(0)
            self.heap = []
            run = self._read(f)
            self.spills += 1
            heapq.heappush(self.runs, (next(run), self.spills, run))

    def _read(self, f) -> Iterator[tuple]:
        with f:
            while data := f.read(self._ROW.size * 1024):
                yield from self._ROW.iter_unpack(data)

    def pop_for(self, level: int, name: bytes) -> Tuple[int, int, int]:
        """The sums of all entries for a node; nothing before it may be left."""
        total = [0, 0, 0]
        while True:
            first = min((q[0] for q in (self.heap, [r[0] for r in self.runs[:1]]) if q), default=None)
            if first is None or first[:2] > (level, name):
                return tuple(total)
            if first[:2] < (level, name):
                raise ValueError("a total was sent to a node that is not there")
            if self.heap and self.heap[0] == first:
                heapq.heappop(self.heap)
            else:
                _, n, run = heapq.heappop(self.runs)
                following = next(run, None)
                if following is not None:
                    heapq.heappush(self.runs, (following, n, run))
            for k in range(3):
                total[k] += first[k + 2]


_ROWS = ("shard", "depth", "node", "kind", "block", "parent", "conv_id", "n_convs", "tokens", "n_children", "n_leaves",
         "saved", "ids", "open", "away", "ends")
_RESULT = pa.schema([("kind", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()),
                     ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("tokens", pa.int64()),
                     ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
                     ("ends", pa.string())])
_RESULT_DDL = ("kind int, node binary, parent binary, depth long, conv_id long, n_convs long, tokens long, "
               "n_children long, n_leaves long, saved long, ends string")
_NOTHING = hashlib.sha256().hexdigest()


def time_forward(rows: Iterator[tuple], limit: int = 100_000) -> Iterator[tuple]:
    """``rows`` (as ``_ROWS``) by shard in reverse level order; gives done and
    open nodes as they come, and at a shard's end its messages."""
    shard, queue, sent = None, SpillingQueue(limit), {}
    now, ends = None, None                 # the node that is being read, and the digest of the ids that end there

    def close():
        r = dict(zip(_ROWS, now))
        got = queue.pop_for(-r["depth"], r["node"])
        children, leaves, saved = r["n_children"] + got[0], r["n_leaves"] + got[1], r["saved"] + got[2]
        digest = ends.hexdigest() if ends is not None else r["ends"] or _NOTHING
        same = (r["node"], r["parent"], r["depth"], r["conv_id"], r["n_convs"], r["tokens"])
        if r["open"]:
            return OPEN, *same, children, leaves, saved, digest
        leaves = leaves if children else 1
        saved += (r["n_convs"] - 1) * r["tokens"]
        if r["away"]:
            old = sent.get(r["parent"], (0, 0, 0, 0))
            sent[r["parent"]] = (r["depth"] - 1, old[1] + 1, old[2] + leaves, old[3] + saved)
        elif r["parent"] is not None:
            queue.push((-(r["depth"] - 1), r["parent"], 1, leaves, saved))
        return DONE, *same, children, leaves, saved, digest

    def leave():
        for name, (depth, children, leaves, saved) in sent.items():
            yield SENT, name, None, depth, None, None, None, children, leaves, saved, None
        sent.clear()

    for row in rows:
        if row[0] != shard:
            if now is not None:
                yield close()
                yield from leave()
            shard, queue, now = row[0], SpillingQueue(limit), None
        if row[3] == NODE:
            if now is not None:
                yield close()
            now, ends = row, None
        elif now is None or now[2] != row[2]:
            raise ValueError("totals or ids of a node that is not there")
        elif row[3] == MESSAGE:
            now = (*now[:9], now[9] + row[9], now[10] + row[10], now[11] + row[11], *now[12:])
        elif ends is None:
            ends = hashlib.sha256(row[12].encode())
        else:
            ends.update(b"," + row[12].encode())
    if now is not None:
        yield close()
        yield from leave()


def _pass(limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[c.to_pylist() for c in b.columns]))
        out: List[tuple] = []
        for r in time_forward(rows, limit):
            out.append(r)
            if len(out) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)],
                                                 schema=_RESULT)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)],
                                             schema=_RESULT)
    return run


def place(cuts: List[bytes], path: bytes, depth: int) -> Tuple[int, bool, bool]:
    """(shard, whether the subtree reaches into the next shard, whether the parent is in another shard)."""
    shard = bisect_right(cuts, path)
    opened = shard < len(cuts) and cuts[shard].startswith(path)
    parent = path[:-8] if depth <= PATH_DEPTH else path
    return shard, opened, depth > 0 and bisect_right(cuts, parent) != shard


def _cuts(nodes: DataFrame, shards: int) -> List[bytes]:
    """At most ``shards - 1`` cut points, from ``SAMPLED`` nodes a shard: names are
    digests, so the least of them are a sample, and the same in every run."""
    paths = sorted(r.path for r in nodes.orderBy("node").limit(SAMPLED * shards).select("path").collect())
    return sorted({paths[i * len(paths) // shards] for i in range(1, shards)}) if len(paths) > shards else []


def _sorted_pass(rows: DataFrame, limit: int) -> DataFrame:
    return rows.select(*_ROWS).sortWithinPartitions("shard", F.col("depth").desc(), "node", "kind", "block") \
        .mapInArrow(_pass(limit), _RESULT_DDL)


def prefix_trie(rows: DataFrame, shards: int = 0, queue_limit: int = 100_000) -> DataFrame:
    """One row for every node: ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, node, parent`` (the last
    two are the names, 16 bytes).

    ``rows`` has ``conv_id, turn, role, text, leader, shared`` (see
    :func:`grafted`): the first ``shared`` turns are the leader's.
    ``shards``: how many, by default the session's shuffle partitions."""
    spark = rows.sparkSession
    ship_code(spark)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        "leader", "shared")
    # conversations without a leader need no others beside them; ids of a group start with its leader's
    prefixes = materialise(turns.repartition(F.coalesce("leader", "conv_id")).sortWithinPartitions(
        "leader", "conv_id", F.col("turn").asc_nulls_first(), "role", "text").mapInArrow(_prefixes, _PREFIX_DDL),
        "trie-prefixes")
    nodes = materialise(prefixes.groupBy("node", "parent", "depth", "path", "tokens").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")), "trie-nodes")
    cuts = _cuts(nodes, shards)

    @F.pandas_udf("shard int, open boolean, away boolean")
    def placed(path: pd.Series, depth: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([place(cuts, p, d) for p, d in zip(path, depth)], columns=["shard", "open", "away"])

    ends = prefixes.where("last").groupBy("node", "depth", "path", F.shiftright("conv_id", ID_BLOCK).alias("block")) \
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    zero, null = F.lit(0).cast("long"), F.lit(None)
    stream = nodes.withColumns({
        "kind": F.lit(NODE), "block": null.cast("long"), "n_children": zero, "n_leaves": zero, "saved": zero,
        "ids": null.cast("string"), "ends": null.cast("string")}).unionByName(ends.withColumns({
            "kind": F.lit(ENDS), "parent": null.cast("binary"), "conv_id": null.cast("long"),
            "n_convs": null.cast("long"), "tokens": null.cast("long"), "n_children": zero, "n_leaves": zero,
            "saved": zero, "ends": null.cast("string")})) \
        .withColumn("at", placed("path", "depth")).select("*", "at.*")
    first = materialise(_sorted_pass(stream.repartitionById(len(cuts) + 1, F.col("shard")), queue_limit),
                        "trie-shards")
    # open nodes and messages: at most 2 * PATH_DEPTH rows a shard, whatever the table
    roots = first.where(F.col("kind") != DONE).withColumns({
        "shard": F.lit(0), "kind": F.when(F.col("kind") == OPEN, NODE).otherwise(MESSAGE),
        "block": null.cast("long"), "ids": null.cast("string"), "open": F.lit(False), "away": F.lit(False)})
    done = first.where(F.col("kind") == DONE).unionByName(_sorted_pass(roots.repartition(1), queue_limit)).drop("kind")
    return _with_parents(done, nodes.count())


def _with_parents(done: DataFrame, total: int) -> DataFrame:
    """Adds each parent's smallest member.  Parents of more than a
    ``HOT_CHILDREN``-th of all nodes (fewer than that many) are broadcast, so
    the shuffled join has no key with more children than that."""
    hot = F.col("n_children") * HOT_CHILDREN > F.lit(total)
    parents = done.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                                                  hot.alias("hot"))
    near = done.join(F.broadcast(parents.where("hot").drop("hot")), "parent", "left")
    found = F.col("parent_conv_id").isNotNull() | F.col("parent").isNull()
    out = near.where(found).unionByName(
        near.where(~found).drop("parent_conv_id").join(parents.where("NOT hot").drop("hot"), "parent"))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"), "node", "parent")
