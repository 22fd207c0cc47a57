"""Point-in-time (as-of) join of feature sources onto a spine.

For every spine row ``(keys, t)`` pick the source row with the same keys and
``t - ttl <= ts <= t`` that ranks highest by ``(created, ts, features...)``
(NULL lowest).  No TTL means no time bound at all (latest row overall).

Strategies (one result, different plans):

``bucketed`` (default, any TTL)
    Time is cut into buckets of width ``w <= ttl``.  The window
    ``[t - ttl, t]`` is then (a) a *prefix* of bucket ``b(t)``: rows with
    ``ts <= t``; (b) a *suffix* of bucket ``b(t - ttl)``: rows with
    ``ts >= t - ttl``; (c) the whole buckets strictly between (none when
    ``w == ttl``).  Source rows, spine rows and one "probe" row at
    ``t - ttl`` per spine row and distinct TTL are unioned; one shuffle on
    ``(keys, bucket)`` feeds two running-max windows (ascending for
    prefixes, descending for suffixes); (c) joins maxima of dyadic blocks of
    buckets, O(log(ttl / w)) per spine row.  A final aggregate on the spine
    key keeps the best candidate.  Work is linear in rows: no pairs are
    formed.  Views on the same keys share the pass.  A bucket that holds too
    many rows of one key is cut into slices at quantiles of its times
    (:func:`.asof_stats.pass_stats`), which then are (a), (b) and (c); heavy
    copies (equal keys and time) are collapsed first.
``join``
    Equi-join on the keys with the TTL range in the join condition, then
    keep the best row per spine row.  Forms every (spine, source) pair of a
    key inside the TTL, so use it only where that fan-out is known small.

No TTL: the source is first reduced to its best row per key (partial
aggregate), then left-joined: no fan-out.  Without keys the reduced source
is a single row, attached as a scalar subquery.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from typing import Dict, List, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import bucket_of, epoch_micros
from .asof_stats import PassStats, pass_stats, with_slice
from .frame import is_orderable

T_COL = "__cf_t"      # epoch micros of the source ts / spine event ts
C_COL = "__cf_c"      # epoch micros of the source created ts
KIND = "__cf_kind"    # 0 source, 1 spine, 2 probe at t - ttl
BUCKET = "__cf_b"
RANK = "__cf_r"       # ranking struct of a source row (see RankSpec), one per view
GKEY = "__cf_g"       # struct of the spine dedup key
SPAY = "__cf_s"       # struct of the other spine columns
BEST = "__cf_best"    # best ranking struct found for a spine row, one per view
VIEW = "__cf_view"    # index of the view a source / probe row belongs to
HOT = "__cf_hot"      # whether the row's bucket is cut into slices

STRATEGIES = ("bucketed", "join")
#: Rows that a task sorts at once, about.  They take up to 400 bytes each in memory.
ROWS_A_TASK = 200_000


class RankSpec:
    """How source rows are ranked and carried.

    Order: created (if any), ts, then the orderable features in request
    order (ties break by features, descending, NULL lowest).  When every
    feature is orderable the ranking struct *is* the payload,
    ``struct(created, ts, f1, f2, ...)``, and ``best`` is ``max``; otherwise
    it is ``struct(o: ranking fields, p: all features)`` and ``best`` is
    ``max_by(r, r.o)``."""

    def __init__(self, source: DataFrame, features: Sequence[str], has_created: bool):
        self.features = list(features)
        self.orderable = all(is_orderable(source.schema[f].dataType) for f in features)
        order = ([F.col(C_COL)] if has_created else []) + [F.col(T_COL)]
        if self.orderable:
            fields = order + [F.col(f) for f in features]
            self.expr = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(fields)])
            self._field = {f: f"r{len(order) + i}" for i, f in enumerate(features)}
        else:
            order += [F.col(f) for f in features if is_orderable(source.schema[f].dataType)]
            o = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
            p = F.struct(*[F.col(f) for f in features])
            self.expr = F.struct(o.alias("o"), p.alias("p"))
            self._field = None

    def best(self, c: Column) -> Column:
        return F.max(c) if self.orderable else F.max_by(c, c["o"])

    def feature(self, c: Column, name: str) -> Column:
        return c[self._field[name]] if self._field is not None else c["p"][name]


def _struct_or_null(cols: Sequence[str]) -> Column:
    if not cols:
        return F.lit(None).cast("struct<_:int>")
    return F.struct(*[F.col(c) for c in cols])


def _null_like(df: DataFrame, name: str) -> Column:
    """A NULL of the type column ``name`` has in ``df`` (read from the
    already analyzed schema: no new plan analysis)."""
    return F.lit(None).cast(df.schema[name].dataType)


def _dealt(df: DataFrame, rows: int, cols: Sequence[str]) -> DataFrame:
    """``df``, about ``rows`` of them, dealt by ``cols`` over enough tasks.  Adaptive
    execution would merge partitions by their compressed bytes, up to a fixed size in which
    these narrow, much repeated rows are many: what a task sorts then grows with the
    input.  A number of partitions that is asked for it leaves as it is."""
    n = -(-rows // ROWS_A_TASK)
    return df.repartition(n, *cols) if n > 1 else df


@dataclass
class AsofView:
    """One prepared source for :func:`point_in_time_join_many`.

    ``source`` holds the key columns under the spine's key names, ``T_COL``
    (and ``C_COL`` if ``has_created``) as epoch micros, and the features under
    their output names.  ``width``: bucket width in micros (None: the TTL), or
    ``"auto"``: the TTL, with the pass's statistics."""

    source: DataFrame
    features: List[str]
    ttl_us: Optional[int]
    has_created: bool = False
    width: Union[int, str, None] = "auto"
    dedup_source: bool = False


def point_in_time_join(spine: DataFrame, spine_ts: str, group_key: Sequence[str],
                       source: DataFrame, keys: Sequence[str], features: Sequence[str],
                       ttl_us: Optional[int], has_created: bool = False,
                       strategy: str = "bucketed", bucket_width_us: Union[int, str, None] = "auto",
                       keep_unmatched: bool = False, max_bucket_rows: int = 2_000_000) -> DataFrame:
    """As-of join one prepared source onto the spine (see :class:`AsofView`).

    ``group_key`` (spine columns) identifies a spine row: spine rows equal on
    it collapse to one.  Returns the spine columns in their order followed by
    ``features``."""
    view = AsofView(source, list(features), ttl_us, has_created, bucket_width_us)
    return point_in_time_join_many(spine, spine_ts, group_key, keys, [view], strategy,
                                   keep_unmatched, max_bucket_rows)


@dataclass
class AsofPass:
    """Views that share their join keys, joined in one pass over the spine.

    ``stats`` and ``buckets`` as in :func:`point_in_time_join_many`."""

    keys: List[str]
    views: List[AsofView]
    strategy: str = "bucketed"
    stats: Optional[PassStats] = None
    buckets: int = 0
    dedup_spine: bool = False


def point_in_time_join_many(spine: DataFrame, spine_ts: str, group_key: Sequence[str],
                            keys: Sequence[str], views: Sequence[AsofView],
                            strategy: str = "bucketed", keep_unmatched: bool = False,
                            max_bucket_rows: int = 2_000_000, dedup_spine: bool = False,
                            stats: Optional[PassStats] = None, buckets: int = 0) -> DataFrame:
    """As-of join several views that share the same join keys.

    With the ``bucketed`` strategy and TTLs on all views, the views share one
    shuffle on ``(keys, bucket)`` and one final aggregate: each view's source
    rows carry that view's ranking column, each spine row yields one probe
    per view.  Otherwise each view is a pass of its own
    (:func:`point_in_time_join_passes`).  A spine row must match every TTL
    view (unless ``keep_unmatched``).

    ``dedup_spine`` answers each distinct (keys, time) point of the spine
    once and joins the answers back (the distinct's partial step merges
    copies on every task); a view's ``dedup_source`` keeps only the best
    source row per (keys, time) the same way.  Both are set from the pass's
    ``stats`` when copies are heavy; results are the same either way.  With
    ``stats`` no set of spine copies exceeds the row budget, so the final
    aggregate skips its map-side partial step.

    ``buckets``: all sources are stored in that many buckets of exactly
    ``keys``, in the spine's types.  The spine rows then go to the sources'
    buckets, and no source is shuffled; where a group is hot, slices need a
    shuffle of their own, and ``buckets`` is not used."""
    views = list(views)
    if len(views) > 1 and not (strategy == "bucketed" and all(v.ttl_us is not None for v in views)):
        passes = [AsofPass(list(keys), [v], strategy, None, 0, dedup_spine) for v in views]
    else:
        passes = [AsofPass(list(keys), views, strategy, stats, buckets, dedup_spine)]
    return point_in_time_join_passes(spine, spine_ts, group_key, passes, keep_unmatched, max_bucket_rows)


def point_in_time_join_passes(spine: DataFrame, spine_ts: str, group_key: Sequence[str], passes: Sequence[AsofPass],
                              keep_unmatched: bool = False, max_bucket_rows: int = 2_000_000,
                              checkpoint_every: Optional[int] = None) -> DataFrame:
    """As-of join of passes over different key sets.

    Every pass reads the spine itself and gives candidates, ``(spine row, best
    source row per view)``; those of all passes meet in one final aggregate by
    spine row.  So plan and scans grow in proportion to the passes, the spine's
    payload is carried once, by the first, and a spine row that one view drops
    is dropped at the end.  ``checkpoint_every`` writes the candidates of that
    many passes at a time to ``spark.checkpoint.dir``."""
    for x in passes:
        if x.strategy not in STRATEGIES:
            raise ValueError(f"unknown as-of strategy {x.strategy!r}; use one of {STRATEGIES}")
    spine_cols = list(spine.columns)
    payload_cols = [c for c in spine_cols if c not in group_key]
    spine_orderable = all(is_orderable(spine.schema[c].dataType) for c in payload_cols)
    ready, views, ranks, offset = [], [], [], 0
    for n, x in enumerate(passes):
        cands, own = _candidates(spine, spine_ts, group_key, payload_cols, x, keep_unmatched, max_bucket_rows, n == 0)
        # the views' best columns are numbered through all passes
        ready.append(cands.select(GKEY, SPAY, *[F.col(_b(i)).alias(_b(offset + i)) for i in range(len(own))]))
        views += [(v, x) for v in x.views]
        ranks += own
        offset += len(own)
    bests = [_b(i) for i in range(offset)]
    if len(ready) == 1:
        all_cands = ready[0]
    else:
        kinds = {b: _null_like(r, b) for r in ready for b in r.columns if b in bests}
        all_cands = None
        for n, r in enumerate(ready, start=1):
            part = r.select(GKEY, SPAY, *[F.col(b) if b in r.columns else kinds[b].alias(b) for b in bests])
            all_cands = part if all_cands is None else all_cands.unionByName(part)
            if checkpoint_every and n % checkpoint_every == 0 and n < len(ready):
                all_cands = all_cands.checkpoint(eager=True)

    spay = F.max(SPAY) if spine_orderable else F.first(SPAY, ignorenulls=True)
    if all(x.stats is not None for x in passes):
        # a spine row's candidates come from different window partitions, and
        # the stats jobs bounded any copies: shuffle first, aggregate once
        rows = sum(x.stats.rows for x in passes)
        all_cands = _dealt(all_cands, rows, [GKEY]) if rows > ROWS_A_TASK else all_cands.repartition(GKEY)
    # otherwise keep the map-side partial step: it merges copies of a spine
    # row before the shuffle (no TTL, no statistics)
    out = all_cands.groupBy(GKEY).agg(*[rk.best(F.col(b)).alias(b) for rk, b in zip(ranks, bests)], spay.alias(SPAY))
    for (v, _), b in zip(views, bests):
        if v.ttl_us is not None and not keep_unmatched:
            out = out.where(F.col(b).isNotNull())
    cols = [(F.col(GKEY)[c] if c in group_key else F.col(SPAY)[c]).alias(c) for c in spine_cols]
    for rk, b, (v, _) in zip(ranks, bests, views):
        cols += [rk.feature(F.col(b), f).alias(f) for f in v.features]
    return out.select(*cols)


def _candidates(spine: DataFrame, spine_ts: str, group_key: Sequence[str], payload_cols: Sequence[str], x: AsofPass,
                keep_unmatched: bool, max_bucket_rows: int, payload: bool) -> tuple:
    """``(GKEY, SPAY, best columns)`` of one pass, and the views' ranks.  Without
    ``payload`` SPAY is NULL.  Statistics made here are left in ``x.stats``."""
    keys, views, strategy, dedup_spine = list(x.keys), list(x.views), x.strategy, x.dedup_spine
    w = None
    if strategy == "bucketed" and all(v.ttl_us is not None for v in views):
        w = min(min(v.ttl_us if v.width in (None, "auto") else int(v.width), v.ttl_us) for v in views)
        if x.stats is None and any(v.width == "auto" for v in views):
            x.stats = pass_stats(spine, spine_ts, keys, [(_keys_as(v.source, spine, keys), v.ttl_us) for v in views], w,
                                 max_bucket_rows)
        if x.stats is not None:
            dedup_spine = dedup_spine or x.stats.spine_copies
            views = [replace(v, dedup_source=v.dedup_source or c) for v, c in zip(views, x.stats.source_copies)]

    srcs, ranks = [], []
    for i, v in enumerate(views):
        # cast source keys to the spine key types so both sides partition alike
        src = v.source.select(
            *[F.col(k).cast(spine.schema[k].dataType).alias(k) for k in keys],
            F.col(T_COL).cast("long").alias(T_COL),
            *([F.col(C_COL).cast("long").alias(C_COL)] if v.has_created else []),
            *[F.col(f) for f in v.features])
        rank = RankSpec(src, v.features, v.has_created)
        # a NULL time is outside every TTL; without TTL it only ranks lowest
        ok = F.lit(True) if v.ttl_us is None else F.col(T_COL).isNotNull()
        for k in keys:                              # NULL keys never match
            ok = ok & F.col(k).isNotNull()
        src = src.where(ok).select(*keys, T_COL, rank.expr.alias(_r(i)))
        if v.dedup_source:
            # only the best row per (keys, time) can ever win
            src = src.groupBy(*keys, T_COL).agg(rank.best(F.col(_r(i))).alias(_r(i)))
        srcs.append(src)
        ranks.append(rank)

    sp = spine.select(*[F.col(k) for k in keys],
                      epoch_micros(spine_ts, spine.schema[spine_ts].dataType).alias(T_COL),
                      _struct_or_null(group_key).alias(GKEY),
                      _struct_or_null(payload_cols).alias(SPAY))
    null_s = _null_like(sp, SPAY)
    if not payload:
        sp = sp.withColumn(SPAY, null_s)
    valid = F.col(T_COL).isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    sp_ok = sp.where(valid)
    null_r = [_null_like(srcs[i], _r(i)) for i in range(len(views))]
    bests = [_b(i) for i in range(len(views))]

    v0 = views[0]
    probe = sp_ok
    if dedup_spine and v0.ttl_us is not None:
        # heavy copies on (keys, time): answer each distinct point once (the
        # distinct's partial step merges copies on every task), then join the
        # answers back; a hot point is then the skewed side of an equi-join
        # with a unique right side, which AQE splits
        pts = sp_ok.select(*keys, T_COL).distinct()
        probe = pts.select(*keys, T_COL, F.struct(*keys, T_COL).alias(GKEY), null_s.alias(SPAY))
    if v0.ttl_us is None:
        cands = _no_ttl(sp, srcs[0], keys, ranks[0])
    elif strategy == "join":
        cands = _join_plan(probe, srcs[0], keys, v0.ttl_us, keep_unmatched and probe is sp_ok)
    else:
        st = x.stats or PassStats()
        cands = _bucketed_plan(probe, srcs, keys, [v.ttl_us for v in views], w, ranks, null_r, null_s, st,
                               0 if st.slices.cuts else x.buckets)
    if probe is not sp_ok:
        answers = cands.groupBy(GKEY).agg(*[rk.best(F.col(b)).alias(b) for rk, b in zip(ranks, bests)]) \
            .select(*[F.col(GKEY)[k].alias(k) for k in keys], F.col(GKEY)[T_COL].alias(T_COL), *bests)
        cands = sp_ok.join(answers, [*keys, T_COL], "left").select(GKEY, SPAY, *bests)
    if keep_unmatched and v0.ttl_us is not None:
        cands = cands.unionByName(sp.where(~valid).select(
            GKEY, SPAY, *[nr.alias(b) for nr, b in zip(null_r, bests)]))
    return cands, ranks


def _r(i: int) -> str:
    return f"{RANK}{i}"


def _b(i: int) -> str:
    return f"{BEST}{i}"


def _no_ttl(sp: DataFrame, src: DataFrame, keys: List[str], rank: RankSpec) -> DataFrame:
    """Latest source row per key over all time (future rows included)."""
    if keys:
        latest = src.groupBy(*keys).agg(rank.best(F.col(_r(0))).alias(_b(0)))
        j = sp.join(latest, keys, "left")
    else:
        # no keys: one best row overall, evaluated once as a scalar subquery
        # (a global aggregate with partial aggregation on every task)
        latest = src.agg(rank.best(F.col(_r(0))).alias(_b(0)))
        j = sp.select(GKEY, SPAY, latest.scalar().alias(_b(0)))
    return j.select(GKEY, SPAY, _b(0))


def _join_plan(sp: DataFrame, src: DataFrame, keys: List[str], ttl_us: int,
               keep_unmatched: bool) -> DataFrame:
    if not keys:
        raise ValueError("the 'join' strategy needs join keys; entityless views use 'bucketed'")
    r = src.select(*[F.col(k).alias(f"__cf_rk{i}") for i, k in enumerate(keys)],
                   F.col(T_COL).alias("__cf_rt"), _r(0))
    cond = None
    for i, k in enumerate(keys):
        c = sp[k] == r[f"__cf_rk{i}"]
        cond = c if cond is None else cond & c
    cond = cond & (r["__cf_rt"] <= sp[T_COL]) & (r["__cf_rt"] >= sp[T_COL] - F.lit(ttl_us))
    j = sp.join(r, cond, "left" if keep_unmatched else "inner")
    return j.select(GKEY, SPAY, F.col(_r(0)).alias(_b(0)))


def _keys_as(source: DataFrame, spine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` with its keys in the spine's types, so that both sides hash alike."""
    return source.select(*[F.col(c).cast(spine.schema[c].dataType).alias(c) if c in keys else F.col(c)
                           for c in source.columns])


def _bucketed_plan(sp: DataFrame, srcs: List[DataFrame], keys: List[str], ttls: List[int], w: int,
                   ranks: List[RankSpec], null_r: List[Column], null_s: Column, stats: PassStats,
                   buckets: int = 0) -> DataFrame:
    """``w``: bucket width; the hot buckets in the slices of ``stats`` are cut
    further, and its rows tell over how many tasks to deal (none: as Spark does).
    With ``buckets`` the spine rows are dealt as the stored sources are: the
    union then keeps that partitioning, and the windows need no shuffle."""
    if w <= 0 or any(w > ttl for ttl in ttls):
        raise ValueError("bucket width must be positive and not larger than any TTL")
    n = len(srcs)
    t = F.col(T_COL)
    null_g = _null_like(sp, GKEY)
    hot, factor = stats.slices.frame(sp.sparkSession), stats.slices.factor
    # keys under new names: a union compares the partitionings of its inputs by
    # column, and a table's own columns carry the table's name
    named = [f"__cf_k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(x) for k, x in zip(keys, named)]
    parts = []
    for i, src in enumerate(srcs):
        rows = with_slice(src, keys, t, w, hot, factor, BUCKET)
        parts.append(rows.select(*renamed, T_COL, F.lit(0).alias(KIND), F.lit(i).alias(VIEW), BUCKET,
                                 *[(F.col(_r(j)) if j == i else null_r[j]).alias(_r(j)) for j in range(n)],
                                 null_g.alias(GKEY), null_s.alias(SPAY)))
    # each spine row yields itself (kind 1, at t) and one probe (kind 2, at
    # t - ttl) per distinct TTL, shared by the views with that TTL, all from
    # one scan of the spine; a probe row's VIEW is its TTL's index
    distinct_ttls = list(dict.fromkeys(ttls))
    items = [F.struct(t.alias(T_COL), F.lit(1).alias(KIND), F.lit(-1).alias(VIEW), F.col(SPAY).alias(SPAY))]
    for i, ttl in enumerate(distinct_ttls):
        items.append(F.struct((t - F.lit(ttl)).alias(T_COL), F.lit(2).alias(KIND), F.lit(i).alias(VIEW),
                              null_s.alias(SPAY)))
    pair = F.col("__cf_pair")
    points = sp.select(*keys, GKEY, F.explode(F.array(*items)).alias("__cf_pair")).select(
        *keys, pair[T_COL].alias(T_COL), pair[KIND].alias(KIND), pair[VIEW].alias(VIEW), GKEY, pair[SPAY].alias(SPAY))
    e_rows = with_slice(points, keys, t, w, hot, factor, BUCKET).select(
        *renamed, T_COL, KIND, VIEW, BUCKET, *[null_r[j].alias(_r(j)) for j in range(n)], GKEY, SPAY)
    if buckets:
        e_rows = e_rows.repartition(buckets, *named)
    u = parts[0]
    for p in parts[1:] + [e_rows]:
        u = u.unionByName(p)
    part = [*named, BUCKET]
    if not buckets:
        u = _dealt(u, stats.rows, part)
    # source rows sort before spine/probe rows at equal time: both bounds inclusive
    up = Window.partitionBy(*part).orderBy(t.asc(), F.col(KIND).asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*part).orderBy(t.desc(), F.col(KIND).asc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind, view = F.col(KIND), F.col(VIEW)
    best = [F.when(kind == 1, ranks[j].best(F.col(_r(j))).over(up))
            .when((kind == 2) & (view == distinct_ttls.index(ttls[j])),
                  ranks[j].best(F.col(_r(j))).over(down)).alias(_b(j))
            for j in range(n)]
    out = u.select(KIND, GKEY, SPAY, *best).where(kind > 0).select(GKEY, SPAY, *[_b(j) for j in range(n)])
    for i, (src, ttl) in enumerate(zip(srcs, ttls)):
        if w < ttl or hot is not None:
            rows = stats.rows if w < ttl else sum(stats.counts.values())
            inner = _middle_blocks(sp, src, keys, ttl, w, hot, factor, ranks[i], _r(i), rows)
            out = out.unionByName(inner.select(
                GKEY, null_s.alias(SPAY),
                *[(F.col(BEST) if j == i else null_r[j]).alias(_b(j)) for j in range(n)]))
    return out


def _middle_blocks(sp: DataFrame, src: DataFrame, keys: List[str], ttl_us: int, w: int, hot: Optional[DataFrame],
                   factor: int, rank: RankSpec, rcol: str, rows: int) -> DataFrame:
    """Best source row of the whole slices strictly between those of ``t - ttl`` and ``t``.

    Slice numbers grow with time, so these are a range of numbers, covered by
    dyadic blocks (segment-tree decomposition), at most 2 per level: a spine
    row joins O(log(ttl / w * factor)) block maxima.  Block maxima come from
    per-slice maxima (a partial aggregate over the source), then every level
    from those small rows in one more aggregate.  With ``w == ttl`` only hot
    buckets have slices in between; other rows do not take part.  ``rows``: of
    the pass that do, for the number of tasks."""
    t = F.col(T_COL)
    r = F.col(rcol)
    per_bucket = with_slice(src, keys, t, w, hot, factor, BUCKET, HOT)
    ends = with_slice(sp, keys, t, w, hot, factor, "__cf_end", "__cf_hot1")
    ends = with_slice(ends, keys, t - F.lit(ttl_us), w, hot, factor, "__cf_first", "__cf_hot0")
    if w == ttl_us:
        per_bucket = per_bucket.where(HOT)
        ends = ends.where(F.col("__cf_hot0") | F.col("__cf_hot1"))
    levels = max(1, math.ceil(math.log2((math.ceil(ttl_us / w) + 1) * factor + 1)))
    first_b = F.col("__cf_first") + F.lit(1)        # half-open [first_b, end_b)
    end_b = F.col("__cf_end")
    blocks = []
    for j in range(levels + 1):
        lj = F.shiftright(first_b + F.lit((1 << j) - 1), j)   # ceil(first_b / 2^j)
        rj = F.shiftright(end_b, j)                           # floor(end_b / 2^j)
        inside = lj < rj
        blocks.append(F.when(inside & (F.pmod(lj, F.lit(2)) == 1),
                             F.struct(F.lit(j).alias("lvl"), lj.alias("blk"))))
        blocks.append(F.when(inside & (F.pmod(rj, F.lit(2)) == 1),
                             F.struct(F.lit(j).alias("lvl"), (rj - F.lit(1)).alias("blk"))))
    mids = ends.select(*keys, GKEY, F.explode(F.filter(F.array(*blocks), lambda x: x.isNotNull())).alias("m")) \
        .select(*keys, GKEY, F.col("m.lvl").alias("__cf_lvl"), F.col("m.blk").alias("__cf_blk"))
    per_bucket = per_bucket.groupBy(*keys, BUCKET).agg(rank.best(r).alias(BEST))
    lv = F.explode(F.array(*[F.struct(F.lit(j).alias("lvl"), F.shiftright(F.col(BUCKET), j).alias("blk"))
                             for j in range(levels + 1)])).alias("m")
    block = [*keys, "__cf_lvl", "__cf_blk"]
    per_block = per_bucket.select(*keys, BEST, lv) \
        .select(*keys, F.col("m.lvl").alias("__cf_lvl"), F.col("m.blk").alias("__cf_blk"), BEST)
    # about a block per level on either side
    per_block = _dealt(per_block, rows * levels, block).groupBy(*block).agg(rank.best(F.col(BEST)).alias(BEST))
    return _dealt(mids, rows * levels, block).join(per_block, block).select(GKEY, BEST)


@dataclass
class AsofPlanStats:
    """Statistics of a view by itself: the width of the narrowest slice of its
    hottest key were its rows even in time, whether copies (rows equal on keys
    and time, which no time slicing can split) are heavy on either side, and an
    upper bound on the (spine, source) pairs the ``join`` strategy would form,
    next to the row total."""

    width: int
    source_copies: bool = False
    spine_copies: bool = False
    pairs: int = 0
    rows: int = 0
    hot_keys: Optional[Dict[int, int]] = None   # hash of keys -> k: its hottest bucket needs 2^k slices

    def __post_init__(self):
        if self.hot_keys is None:
            self.hot_keys = {}

    def join_is_bounded(self, factor: int = 4) -> bool:
        """The ``join`` plan forms at most ``factor`` pairs per input row."""
        return self.pairs <= factor * max(self.rows, 1)


def join_pairs(spine: DataFrame, spine_ts: str, source: DataFrame, keys: Sequence[str], ttl_us: int) -> tuple:
    """(upper bound on the pairs of the ``join`` strategy, rows of both sides).

    Spine rows of a TTL-wide bucket times source rows of that bucket and the
    one before, which hold every row of any TTL window ending in it; counted
    with partial aggregates, one row comes back."""
    h = F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("long")
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    sp_t = epoch_micros(spine_ts, spine.schema[spine_ts].dataType)

    def side(df, t, spine_side):
        shifts = F.array(F.lit(0)) if spine_side else F.array(F.lit(0), F.lit(1))
        return df.where(ok & t.isNotNull()).select(h.alias("__cf_h"), bucket_of(t, ttl_us).alias("b"),
                                                   F.explode(shifts).alias("shift"), F.lit(spine_side).alias("spine"))
    u = side(source, F.col(T_COL).cast("long"), False).unionByName(side(spine, sp_t, True))
    n = u.groupBy("__cf_h", (F.col("b") + F.col("shift")).alias("b")).agg(
        F.count_if(F.col("shift") == 0).alias("n"), F.count_if(~F.col("spine")).alias("n_src"),
        F.count_if("spine").alias("n_spine")).agg(F.sum("n").alias("rows"),
                                                  F.sum(F.col("n_spine") * F.col("n_src")).alias("pairs")).first()
    return int(n["pairs"] or 0), int(n["rows"] or 0)


def asof_plan_stats(spine: DataFrame, spine_ts: str, views: Sequence[tuple],
                    max_bucket_rows: int, pair_bound: bool = False) -> List[AsofPlanStats]:
    """Statistics of every view ``(prepared_source, keys, ttl_us)`` by itself,
    from :func:`.asof_stats.pass_stats`; with ``pair_bound`` also the pairs."""
    out = []
    for src, keys, ttl_us in views:
        st = pass_stats(spine, spine_ts, keys, [(src, ttl_us)], ttl_us, max_bucket_rows)
        per_key: Dict[int, int] = {}
        for (h, _), cuts in st.slices.cuts.items():
            per_key[h] = max(per_key.get(h, 0), len(cuts).bit_length())
        pairs, rows = join_pairs(spine, spine_ts, src, keys, ttl_us) if pair_bound else (0, st.rows)
        out.append(AsofPlanStats(width=max(1, ttl_us >> max(per_key.values(), default=0)), hot_keys=per_key,
                                 source_copies=st.source_copies[0], spine_copies=st.spine_copies, pairs=pairs, rows=rows))
    return out


def auto_bucket_widths(spine: DataFrame, spine_ts: str, views: Sequence[tuple],
                       max_bucket_rows: int) -> List[int]:
    """Bucket widths of :func:`asof_plan_stats`."""
    return [st.width for st in asof_plan_stats(spine, spine_ts, views, max_bucket_rows)]


def auto_bucket_width(spine: DataFrame, spine_ts: str, source: DataFrame, keys: Sequence[str],
                      ttl_us: int, max_bucket_rows: int) -> int:
    """Single-view form of :func:`auto_bucket_widths`."""
    return auto_bucket_widths(spine, spine_ts, [(source, list(keys), ttl_us)], max_bucket_rows)[0]
