"""N-gram Jaccard join over prefix trees.

Sets of word shingles are ordered by the corpus frequency of their members,
rarest first.  Two sets can only be similar enough if they share a member
among the first few (the prefix), so sets meet by their rare prefix members
alone.  Sets that meet are stored in a prefix tree: its paths are the
ordered sets, laid out in sorted order with the length each shares with the
one before.  A probe walks the tree once; what it overlaps with a shared
stretch of path is counted once, and a path is left as soon as the missed
members exceed what its remaining length allows.

Work in a group of near copies grows with the group, not with its pairs:
every member first meets the smallest document of its group, and only
pairs that the links found so far leave in different components are tried
after that, in blocks of bounded size.
"""

from __future__ import annotations

import pickle
from typing import Dict, Iterator, List, Tuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .bpe import _blocks
from .common import materialise, own_names_aside, ship_code
from .components import connected_components
from .shingles import shingle_sets


def least_overlap(a, b, percent: int):
    """Smallest intersection with ``100 * intersection >= percent * union`` for sets of ``a`` and ``b`` members."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n, percent: int):
    """Members of a set of ``n`` of which any similar set must share one."""
    return n - (percent * n + 99) // 100 + 1


# --- packing of sorted members: differences, byte by byte, compress well


def _squeeze(sorted_values: np.ndarray) -> bytes:
    diff = np.diff(sorted_values, prepend=np.uint64(0)).astype("<u8")
    return diff.view(np.uint8).reshape(-1, 8).T.tobytes()


def _expand(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


# --- 1. members of the sets, dealt by hash; 2. their frequencies, dealt back; 3. ordered sets


def _deal(width: int, buckets: int, block_chars: int):
    """Task code: documents in, one row per (block of documents, bucket of members) out."""

    def deal(own: pa.Array, texts: List[str], block: int) -> pa.RecordBatch:
        rows: List[Tuple[int, int, bytes]] = []
        sets = shingle_sets(texts, width)
        sizes = np.array([len(s) for s in sets], np.int64)
        ids = own.to_numpy(zero_copy_only=False) if own.null_count == 0 else np.array(
            [np.iinfo(np.int64).min if i is None else i for i in own.to_pylist()], np.int64)
        known = np.array([i is not None for i in own.to_pylist()]) if own.null_count else np.ones(len(ids), bool)
        # equal sets of a block are one; the smallest id speaks for them
        digests = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
        speaker: Dict[bytes, int] = {}
        for i in np.argsort(ids, kind="stable").tolist():
            if known[i] and sizes[i]:
                speaker.setdefault(digests[i], i)
        speaks = np.array([speaker.get(d, i) if k and n else i
                           for i, (d, k, n) in enumerate(zip(digests, known, sizes.tolist()))])
        chosen = sorted(speaker.values())
        members = np.concatenate([np.empty(0, np.uint64), *[sets[i] for i in chosen]])
        del sets
        owner = np.repeat(np.array(chosen, np.int32), sizes[chosen])
        by = np.argsort(members, kind="stable")
        members, owner = members[by], owner[by]
        del by
        first = np.flatnonzero(np.concatenate([[True], members[1:] != members[:-1]])) if len(members) else \
            np.empty(0, np.int64)
        count = np.diff(np.concatenate([first, [len(members)]]))
        many = count > 1
        # a member of one document here travels with it, one of several with their number
        token, mark = members[first], np.where(many, -count, owner[first] if len(first) else 0).astype(np.int32)
        del members
        home = (ids, known, sizes, speaks, digests, token[many], count[many], owner[np.repeat(many, count)])
        rows.append((-1, block, pickle.dumps(home, 5)))
        bounds = np.searchsorted(token, (np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets)))
        edges = np.concatenate([[0], bounds, [len(token)]])
        for k, (a, z) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            if z > a:
                rows.append((k, block, pickle.dumps((_squeeze(token[a:z]), mark[a:z]), 5)))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()),
             pa.array([r[0] if r[0] >= 0 else ((block + 1) * 2654435761) % buckets for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.binary())], ["kind", "bucket", "block", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for own, texts in _blocks(batches, block_chars):
            yield deal(own, texts, block)           # one block's arrays at a time
            block += 1

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task code: rows sorted by bucket in; for each block its members that occur elsewhere too, with their frequency."""

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                           pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.binary())], ["kind", "block", "payload"])

    def settle(group):
        parts = [pickle.loads(p) for _, p in group]
        tokens = [_expand(t) for t, _ in parts]
        marks = np.concatenate([m for _, m in parts])
        flat = np.concatenate(tokens)
        by = np.argsort(flat, kind="stable")
        s = flat[by]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        total = np.add.reduceat(np.where(marks < 0, -marks, 1)[by], first)
        freq = np.empty(len(flat), np.int64)
        freq[by] = np.repeat(total, np.diff(np.concatenate([first, [len(s)]])))
        at = 0
        for (block, _), t in zip(group, tokens):
            f, m = freq[at:at + len(t)], marks[at:at + len(t)]
            at += len(t)
            more = f > 1
            if more.any():
                yield 0, block, pickle.dumps((_squeeze(t[more]), m[more], np.minimum(f[more], 2**31 - 1).astype(np.int32)), 5)

    group: List[Tuple[int, bytes]] = []
    current = None
    for b in batches:
        ready = []
        # payloads stay in the batch until their group is settled
        for kind, bucket, block, payload in zip(*[b.column(c).to_pylist() for c in range(3)], b.column(3)):
            if kind < 0:
                ready.append((-1, block, payload.as_py()))
                continue
            if bucket != current and group:
                ready += settle(group)
                group = []
            current = bucket
            group.append((block, payload.as_buffer()))
        if ready:
            yield out(ready)
    if group:
        yield out(list(settle(group)))


def _order(percent: int):
    """Task code: rows sorted by block in; a row per document, with its ordered set where it may link."""

    def settle(rows):
        ids, known, sizes, speaks, digests, multi, counts, owners = next(pickle.loads(p) for k, p in rows if k < 0)
        token, doc, freq = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        ends = np.cumsum(counts)
        for k, p in rows:
            if k < 0:
                continue
            t, mark, f = pickle.loads(p)
            t = _expand(t)
            one = mark >= 0
            token.append(t[one])
            doc.append(mark[one].astype(np.int64))
            freq.append(f[one].astype(np.int64))
            at = np.searchsorted(multi, t[~one])
            n = counts[at]
            token.append(np.repeat(t[~one], n))
            freq.append(np.repeat(f[~one].astype(np.int64), n))
            if len(at):
                doc.append(owners[np.concatenate([np.arange(e - c, e) for e, c in zip(ends[at], n)])].astype(np.int64))
        token, doc, freq = np.concatenate(token), np.concatenate(doc), np.concatenate(freq)
        by = np.lexsort((token, freq, doc))
        token, doc, freq = token[by], doc[by], freq[by]
        at = np.searchsorted(doc, np.arange(len(ids) + 1))
        for i in range(len(ids)):
            n, a, z = int(sizes[i]), int(at[i]), int(at[i + 1])
            own = int(ids[i]) if known[i] else None
            row = [own, n, int(ids[speaks[i]]) if known[i] else None, None, None, None, None, None, None]
            if known[i] and n and speaks[i] == i:
                m = prefix_length(n, percent) - (n - (z - a))
                if m >= 1:
                    row[3:] = [digests[i], z - a, token[a:a + m].view(np.int64), int(freq[a + m - 1]),
                               int(token[a + m - 1].view(np.int64)), token[a:z].tobytes()]
            yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64(),
                 pa.int64(), pa.binary()]
        names = ["doc_id", "n", "speaker", "digest", "shared", "prefix", "last_freq", "last", "path"]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        group, current = [], None
        for b in batches:
            for kind, block, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if block != current and group:
                    yield out(list(settle(group)))
                    group = []
                current = block
                group.append((kind, payload.as_buffer()))
        if group:
            yield out(list(settle(group)))

    return run


def ordered_sets(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int,
                 block_chars: int = 8 << 20) -> DataFrame:
    """One row per input row: ``doc_id, n`` (set size), ``speaker`` (id of the
    document that stands for the equal sets of its block) and, for a speaker
    that may link, ``digest``, ``shared`` (members that other documents have),
    ``path`` (those, ordered by frequency and hash, 8 bytes each), ``prefix``
    (the first of them, any similar set shares one), ``last_freq, last`` (the
    prefix's end in the order).  Members of one document only come before all
    others in the order; they stay out of path and prefix."""
    spark = docs.sparkSession
    ship_code(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = source.mapInArrow(_deal(width, 4 * parts, block_chars),
                              "kind bigint, bucket bigint, block bigint, payload binary")
    # buckets hold about as many members each: four to a partition, by number
    counted = dealt.repartitionById(parts, F.col("bucket").cast("int")).sortWithinPartitions("bucket") \
        .mapInArrow(_count, "kind bigint, block bigint, payload binary")
    return counted.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(
        _order(percent), "doc_id bigint, n bigint, speaker bigint, digest binary, shared bigint, prefix array<bigint>, "
                         "last_freq bigint, last bigint, path binary")


# --- 4. groups of sets in a prefix tree


class TreeWalk:
    """Probes of one group over paths that come in sorted order.

    For every probe the overlap with each depth of the path it last walked is
    kept; ``shared`` is how much of that the present path begins with."""

    def __init__(self, probes: List[tuple], percent: int):
        self.percent = percent
        self.ids = [p[0] for p in probes]
        self.n = np.array([p[1] for p in probes], np.int64)
        self.comp = np.array([p[2] for p in probes], np.int64)
        self.rest = np.array([p[4] for p in probes], np.int64)
        self.end = [p[5] for p in probes]
        self.sets = [np.sort(np.frombuffer(p[3], np.uint64)) for p in probes]
        self.shared = np.zeros(len(probes), np.int64)
        self.walked: List[np.ndarray] = [np.zeros(1, np.int64) for _ in probes]
        self.path = np.empty(0, np.uint64)
        self.joined: Dict[int, int] = {}

    def find(self, comp: int) -> int:
        while self.joined.get(comp, comp) != comp:
            comp = self.joined[comp]
        return comp

    def member(self, doc, n, comp, path, rest, end, half, whole) -> Iterator[Tuple[int, int]]:
        """(probe, doc) that may link for the next path.  With ``whole`` sets a found
        pair is a link: it joins the two components, and pairs that are joined
        already are left out."""
        path = np.frombuffer(path, np.uint64)
        m = min(len(path), len(self.path))
        differ = np.flatnonzero(path[:m] != self.path[:m])
        np.minimum(self.shared, int(differ[0]) if len(differ) else m, out=self.shared)
        self.path = path
        need = least_overlap(self.n, n, self.percent)
        ok = (self.comp != comp) & (np.minimum(self.n, n) * 100 >= self.percent * np.maximum(self.n, n))
        for k in np.flatnonzero(ok).tolist():
            if half and self.ids[k] >= doc:
                continue
            if whole and self.find(int(self.comp[k])) == self.find(comp):
                continue
            own = self.sets[k]
            # whichever prefix ends first bounds what comes after it
            after = (self.rest[k] if self.end[k] <= end else rest) if rest or self.rest[k] else 0
            depth, walked = int(self.shared[k]), self.walked[k]
            have = int(walked[depth])
            if have + min(len(path) - depth, len(own) - have) + after < need[k]:
                continue                       # the shared stretch missed too much: the subtree is left
            tail = path[depth:]
            at = np.minimum(np.searchsorted(own, tail), len(own) - 1)
            counts = np.cumsum(own[at] == tail) + have
            self.walked[k] = np.concatenate([walked[:depth + 1], counts])
            self.shared[k] = len(path)
            if int(self.walked[k][-1]) + after >= need[k]:
                if whole:
                    self.joined[self.find(comp)] = self.find(int(self.comp[k]))
                yield self.ids[k], doc


def _walk(percent: int, whole: bool):
    """Task code: rows sorted by group, role and path in; links out (``whole``), or
    of each group the documents that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes: List[tuple] = []
        walk, current, seen = None, None, set()
        found: List[tuple] = []
        docs = set()

        def out():
            kinds = [pa.int64()] * len(found[0])
            names = ["a", "b"] if whole else [*_GROUP, "role", "doc"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

        for b in batches:
            cols = [b.column(c).to_pylist() for c in range(b.num_columns)]
            for g1, s1, g2, s2, role, doc, n, comp, path, rest, freq, last in zip(*cols):
                if (g1, s1, g2, s2) != current:
                    if docs:
                        found += [(*current, r, d) for r, d in sorted(docs)]
                    current, probes, walk, seen, docs = (g1, s1, g2, s2), [], None, set(), set()
                if role == 0:
                    if (doc, path) not in seen:
                        probes.append((doc, n, comp, path, rest, (freq, last % (1 << 64))))
                    seen.add((doc, path))
                    continue
                if walk is None:
                    walk = TreeWalk(probes, percent)
                pairs = walk.member(doc, n, comp, path, rest, (freq, last % (1 << 64)), (g1, s1) == (g2, s2), whole)
                if whole:
                    found += pairs
                else:
                    for x, y in pairs:
                        docs.add((0, x))
                        docs.add((1, y))
            if found:
                yield out()
                found = []
        if docs:
            found += [(*current, r, d) for r, d in sorted(docs)]
            yield out()

    return run


_GROUP = ["g1", "s1", "g2", "s2"]


def tree_join(rows: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Walk the probes (``role`` 0) of each group through the tree of its members
    (1).  ``rows``: the group's four keys, ``role, doc, n, comp, path, rest``
    (members after the path), ``freq, last`` (the path's end in the order).
    Pairs of one ``comp`` are left out, and where both halves of the key are the
    same each pair is taken once.

    With ``whole`` sets: links ``(a, b)`` that reach ``percent``, as many as join
    what a group's links join (a forest, never all pairs).  Else, on prefixes:
    the group's keys, ``role, doc`` of documents in pairs that may reach it."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*_GROUP, F.col("role").cast("bigint"), "doc", "n", "comp", "path", "rest", "freq", "last")
    schema = "a bigint, b bigint" if whole else ", ".join(f"{c} bigint" for c in [*_GROUP, "role", "doc"])
    return rows.repartition(parts, *_GROUP).sortWithinPartitions(*_GROUP, "role", "path").mapInArrow(_walk(percent, whole), schema)


def _whole(sets: DataFrame) -> DataFrame:
    """Whole sets as rows of :func:`tree_join`."""
    zero = F.lit(0).cast("bigint")
    return sets.select("doc", "n", "path", zero.alias("rest"), zero.alias("freq"), zero.alias("last"))


def verify(pairs: DataFrame, sets: DataFrame, percent: int, group: int = 256) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets reach ``percent``.  Members of one
    ``a`` are dealt to groups of about ``group``; each holds ``a``'s set once."""
    size = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("k"))
    dealt = pairs.join(size, "a").select(
        F.col("a").alias("g1"), F.pmod(F.xxhash64("b"), F.ceil(F.col("k") / group)).alias("s1"),
        F.lit(0).cast("bigint").alias("g2"), F.lit(-1).cast("bigint").alias("s2"), "b")
    dealt = materialise(dealt, "pairs-dealt")
    probes = dealt.select(*_GROUP, F.col("g1").alias("doc"), F.lit(0).alias("role")).distinct()
    members = dealt.select(*_GROUP, F.col("b").alias("doc"), F.lit(1).alias("role"))
    rows = probes.unionByName(members).join(_whole(sets), "doc").withColumn("comp", F.col("doc"))
    return tree_join(rows, percent, whole=True).distinct()


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                       percent: int = 85, block: int = 128) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles`` (size of its set of distinct
    ``width``-word shingles) and ``component_id`` (smallest id reachable by
    links, its own included).  Two documents link when ``100 * intersection >=
    percent * union``.

    Words are runs of non-white-space after lower-casing A-Z; a text with
    fewer than ``width`` words is one shingle, one without words has an empty
    set and no links.  Shingles are compared as 64-bit hashes.

    Defined cases: null text counts as empty; a row without an id gets its
    ``n_shingles``, a null ``component_id`` and no links; rows that repeat an id
    are one document that links by any of its texts; an empty table gives an
    empty result; other columns are not looked at.  Ids are integers; a column
    of another type is refused with a TypeError before any job."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"ids of {id_col!r} are {docs.schema[id_col].dataType.simpleString()}, not integers; number the rows first")
    table = materialise(ordered_sets(docs, id_col, text_col, width, percent), "ordered-sets")
    cand = table.where(F.col("digest").isNotNull())
    # equal sets of all blocks: the smallest id speaks for them
    speaker = cand.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    small = cand.select("digest", "doc_id", "n", "shared", "prefix", F.substring(
        F.col("path"), F.lit(1), F.lit(8) * F.size("prefix")).alias("head"), "last_freq", "last").join(speaker, "digest")
    small = materialise(small, "speakers")
    copies = small.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")) \
        .unionByName(table.where("speaker <> doc_id").select(F.col("doc_id").alias("a"), F.col("speaker").alias("b")))
    reps = small.where("doc_id = rep").dropDuplicates(["digest"])
    sets = cand.select(F.col("doc_id").alias("doc"), "n", "path")
    # postings of the prefixes that meet at least two sets; the smallest document of each is its pivot
    post = reps.select(F.explode("prefix").alias("token"), F.col("doc_id").alias("doc"), "n")
    pivot = post.groupBy("token").agg(F.min(F.struct("doc", "n")).alias("p"), F.count(F.lit(1)).alias("k")).where("k > 1")
    shared = materialise(post.join(pivot, "token").select("token", "doc", "n", F.col("p.doc").alias("pivot"),
                                                          F.col("p.n").alias("pivot_n")), "postings")
    near = F.least("n", "pivot_n") * 100 >= F.greatest("n", "pivot_n") * percent
    pairs = shared.where(near & (F.col("doc") != F.col("pivot"))) \
        .select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    links = materialise(verify(pairs, sets, percent).unionByName(copies), "links-by-pivot")
    comp = materialise(connected_components(links), "components-by-pivot")

    # pairs that the pivots left apart, by blocks of documents that meet
    homes = shared.groupBy("doc").agg(F.min("pivot").alias("home"))
    sizes = homes.groupBy("home").agg(F.count(F.lit(1)).alias("k"))
    homes = homes.join(sizes, "home").select("doc", "home", F.pmod(
        F.xxhash64("doc"), F.ceil(F.col("k") / block)).alias("part"))
    homes = homes.join(comp.withColumnRenamed("node", "doc"), "doc", "left") \
        .select("doc", "home", "part", F.coalesce("component", "doc").alias("comp"))
    homes = materialise(homes, "blocks")
    meets = shared.select("token", "doc").join(homes, "doc")
    apart = meets.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
    cells = meets.groupBy("token", "home", "part").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")) \
        .join(apart, "token")
    cells = materialise(cells, "cells")
    x = cells.select("token", F.col("home").alias("g1"), F.col("part").alias("s1"), F.col("lo").alias("lo1"),
                     F.col("hi").alias("hi1"))
    y = cells.select("token", F.col("home").alias("g2"), F.col("part").alias("s2"), F.col("lo").alias("lo2"),
                     F.col("hi").alias("hi2"))
    one_comp = (F.col("lo1") == F.col("hi1")) & (F.col("lo2") == F.col("hi2")) & (F.col("lo1") == F.col("lo2"))
    groups = x.join(y, "token").where((F.struct("g1", "s1") <= F.struct("g2", "s2")) & ~one_comp) \
        .select(*_GROUP).distinct()
    groups = materialise(groups, "block-pairs")
    heads = reps.select(F.col("doc_id").alias("doc"), "n", "prefix", "head", "shared", F.col("last_freq").alias("freq"), "last") \
        .join(homes, "doc")
    heads = materialise(heads.select("doc", "n", "comp", "home", "part", F.col("head").alias("path"),
                                     (F.col("shared") - F.size("prefix")).cast("bigint").alias("rest"), "freq", "last"),
                        "prefixes")
    probes = groups.join(heads, (F.col("g1") == F.col("home")) & (F.col("s1") == F.col("part"))).withColumn("role", F.lit(0))
    members = groups.join(heads, (F.col("g2") == F.col("home")) & (F.col("s2") == F.col("part"))).withColumn("role", F.lit(1))
    maybe = materialise(tree_join(probes.unionByName(members), percent, whole=False), "prefixes-left")
    late = tree_join(maybe.join(homes.select("doc", "comp"), "doc").join(_whole(sets), "doc"), percent, whole=True)
    stars = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
    comp = connected_components(late.unionByName(stars))
    out = table.select("doc_id", F.col("n").alias("n_shingles")).join(comp, F.col("doc_id") == F.col("node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


@own_names_aside
def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                         percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest id, all
    columns as they were.  Rows without an id stay."""
    gone = ngram_jaccard_join(docs, id_col, text_col, width, percent).where("component_id <> doc_id") \
        .select(F.col("doc_id").alias("__cf_gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__cf_gone"), "left_anti").select(*docs.columns)
