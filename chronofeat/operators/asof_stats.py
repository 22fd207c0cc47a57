"""Statistics of an as-of pass: hot groups with their time slices, heavy copies
and numbers of keys.

One job over keys and times of all sources and the spine keeps a frequent-items
sketch of ``(keys, time bucket)`` groups on every task: what is shuffled is the
sketches, merged in two steps.  Only if a group is estimated above the row
budget does a second job run, over the rows of at most ``HOT_GROUPS`` candidate
groups (broadcast): it counts them exactly and merges a quantile sketch of
their times, which gives cut points where the rows are, not where a bucket
would be halved.  At most ``HOT_GROUPS`` rows reach the driver, whatever the
data: the budget is raised to ``rows / HOT_GROUPS`` where it is smaller.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Dict, List, Optional, Sequence, Tuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecols import bucket_of, epoch_micros

T_COL = "__cf_t"
HOT_GROUPS = 1024
#: Items of the sketch.  Its error is at most 3.5 / TRACKED of all rows, so every group of more than twice that
#: share, and with it each above rows / HOT_GROUPS, is among its items.
TRACKED = 8 * HOT_GROUPS
MERGERS = 32                               # tasks that merge sketches before the last one


@dataclass
class Slices:
    """Time slices of hot groups: ``(hash of keys, bucket) -> cut times``.

    Slice ``n`` of bucket ``b`` has the number ``b * factor + n``; it starts at
    the n-th cut.  Buckets that are not listed are slice 0 of themselves."""
    cuts: Dict[Tuple[int, int], List[int]] = field(default_factory=dict)

    @property
    def factor(self) -> int:
        """The least power of two above every number of cuts."""
        return 1 << max((len(c) for c in self.cuts.values()), default=0).bit_length()

    def frame(self, spark) -> Optional[DataFrame]:
        """At most ``HOT_GROUPS`` rows and three times as many cuts: a proven bound for a broadcast."""
        if not self.cuts:
            return None
        rows = [(h, b, c) for (h, b), c in sorted(self.cuts.items())]
        return spark.createDataFrame(rows, "__cf_hk long, __cf_hb long, __cf_cuts array<bigint>")


@dataclass
class PassStats:
    rows: int = 0
    slices: Slices = field(default_factory=Slices)
    counts: Dict[Tuple[int, int], int] = field(default_factory=dict)     # rows of each hot group
    source_copies: List[bool] = field(default_factory=list)              # per view
    spine_copies: bool = False
    spine_keys: int = 0                                                  # approximate numbers of distinct keys
    source_keys: List[int] = field(default_factory=list)


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys]) if keys else F.lit(0).cast("long")


def _top(item: str, k: int, where: str = "") -> Column:
    return F.expr(f"approx_top_k_accumulate({item}, {TRACKED}){f' FILTER (WHERE {where})' if where else ''}")


def _rows(spine: DataFrame, spine_ts: str, keys: Sequence[str], sources: Sequence[Tuple[DataFrame, int]],
          width: int) -> DataFrame:
    """``__cf_v, __cf_h, __cf_t, __cf_b, __cf_g`` of every row that the pass
    sorts: source rows (view's number), spine rows (-1) and their probes at
    ``t - ttl`` (-2)."""
    parts = []
    for i, (src, _) in enumerate(sources):
        parts.append((src, F.array(F.struct(F.lit(i).alias("v"), F.col(T_COL).cast("long").alias("t")))))
    t = epoch_micros(spine_ts, spine.schema[spine_ts].dataType)
    points = [F.struct(F.lit(-1).alias("v"), t.alias("t"))]
    points += [F.struct(F.lit(-2).alias("v"), (t - F.lit(ttl)).alias("t")) for ttl in dict.fromkeys(x for _, x in sources)]
    parts.append((spine, F.array(*points)))
    out = None
    for df, at in parts:
        ok = F.lit(True)
        for k in keys:
            ok = ok & F.col(k).isNotNull()
        part = df.where(ok).select(key_hash(keys).alias("__cf_h"), F.explode(at).alias("x")).where("x.t IS NOT NULL") \
            .select(F.col("x.v").alias("__cf_v"), "__cf_h", F.col("x.t").alias(T_COL),
                    bucket_of(F.col("x.t"), width).alias("__cf_b"))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("__cf_g", F.xxhash64("__cf_h", "__cf_b"))


def _sketched(u: DataFrame, views: int, max_bucket_rows: int) -> PassStats:
    """Row count, numbers of keys, and groups estimated above the budget (in ``counts``, by hash)."""
    # one row more: sketches of no rows at all cannot be combined
    none = u.sparkSession.range(1).select(F.lit(-3).alias("__cf_v"), *[F.lit(0).cast("long").alias(c) for c in u.columns[1:]])
    first = u.unionByName(none).groupBy((F.spark_partition_id() % MERGERS).alias("m")).agg(
        F.count(F.lit(1)).alias("rows"), _top("__cf_g", HOT_GROUPS).alias("top"),
        *[F.hll_sketch_agg(F.when(F.col("__cf_v") == v, F.col("__cf_h"))).alias(f"k{v + 1}") for v in range(-1, views)])
    r = first.agg(F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("top"),
                  *[F.hll_union_agg(f"k{v}").alias(f"k{v}") for v in range(views + 1)]) \
        .select("rows", F.filter(F.expr(f"approx_top_k_estimate(top, {HOT_GROUPS})"), lambda x: x["count"] > F.greatest(
            F.lit(max_bucket_rows), F.expr(f"(rows - 1) div {HOT_GROUPS}"))).alias("top"),
                *[F.hll_sketch_estimate(f"k{v}").alias(f"k{v}") for v in range(views + 1)]).first()
    return PassStats(rows=int(r["rows"]) - 1, counts={x["item"]: x["count"] for x in r["top"] or []},
                     spine_keys=int(r["k0"] or 0), source_keys=[int(r[f"k{v + 1}"] or 0) for v in range(views)])


def pass_stats(spine: DataFrame, spine_ts: str, keys: Sequence[str], sources: Sequence[Tuple[DataFrame, int]],
               width: int, max_bucket_rows: int) -> PassStats:
    """Statistics of one as-of pass over ``sources`` (prepared source, TTL in
    micros) with buckets of ``width`` micros."""
    u = _rows(spine, spine_ts, keys, sources, width)
    seen = _sketched(u, len(sources), max_bucket_rows)
    budget, named = max(max_bucket_rows, seen.rows // HOT_GROUPS), seen.counts
    out = PassStats(seen.rows, Slices(), {}, [False] * len(sources), False, seen.spine_keys, seen.source_keys)
    if not named:
        return out
    spark = spine.sparkSession
    wanted = spark.createDataFrame([(g,) for g in named], "__cf_g long")      # at most HOT_GROUPS rows
    hot = u.join(F.broadcast(wanted), "__cf_g")
    # as many quantiles as the hottest group needs; slices aim at half the budget, for the sketch's error
    need = max(2, -(-2 * max(named.values()) // budget))
    grid = 1 << min(need - 1, 4 * HOT_GROUPS - 1).bit_length()
    shares = F.array(*[F.lit(i / grid) for i in range(1, grid)])
    found = hot.groupBy("__cf_h", "__cf_b").agg(F.count(F.lit(1)).alias("n"),
                                                F.percentile_approx(T_COL, shares, 4 * grid).alias("q")) \
        .where(F.col("n") > F.lit(budget)).collect()
    for r in found:
        step = max(1, grid // max(2, -(-2 * r["n"] // budget)))
        start = r["__cf_b"] * width
        # the first cut lies above the bucket's start; equal quantiles are one cut, and the copies there one slice
        cuts = sorted({int(q) for q in r["q"][step - 1::step] if q > start})
        at = (int(r["__cf_h"]), int(r["__cf_b"]))
        out.counts[at] = int(r["n"])
        if cuts:
            out.slices.cuts[at] = cuts
    # copies (equal keys and time) cannot be cut; heavy ones are among the sketch's items of the hot rows
    copies = hot.withColumn("__cf_c", F.xxhash64("__cf_h", T_COL)).groupBy(
        (F.spark_partition_id() % MERGERS).alias("m")).agg(
        *[_top("__cf_c", 1, f"__cf_v = {v}").alias(f"c{v + 1}") for v in range(-1, len(sources))])
    r = copies.agg(*[F.expr(f"approx_top_k_combine(c{v}, {TRACKED})").alias(f"c{v}") for v in range(len(sources) + 1)]) \
        .select(*[F.expr(f"approx_top_k_estimate(c{v}, 1)").alias(f"c{v}") for v in range(len(sources) + 1)]).first()
    heavy = [bool(r[f"c{v}"]) and r[f"c{v}"][0]["count"] > budget for v in range(len(sources) + 1)]
    out.spine_copies, out.source_copies = heavy[0], heavy[1:]
    return out


def with_slice(df: DataFrame, keys: Sequence[str], time: Column, width: int, hot: Optional[DataFrame], factor: int,
               bucket: str, flag: Optional[str] = None) -> DataFrame:
    """Adds ``bucket``: the number of the slice that ``time`` falls into for
    the row's keys (the plain time bucket where no group is hot).  ``flag``
    names a column that tells whether the group is hot."""
    b = bucket_of(time, width)
    if hot is None:
        out = df.withColumn(bucket, b)
        return out.withColumn(flag, F.lit(False)) if flag else out
    cols = df.columns
    out = df.withColumns({"__cf_hk": key_hash(keys), "__cf_hb": b, "__cf_at": time}) \
        .join(F.broadcast(hot), ["__cf_hk", "__cf_hb"], "left").withColumn("__cf_n", F.lit(0))
    step = factor // 2
    while step:                            # binary search: the number of cuts at or before the time
        ahead = F.get("__cf_cuts", F.col("__cf_n") + F.lit(step - 1)) <= F.col("__cf_at")
        out = out.withColumn("__cf_n", F.col("__cf_n") + F.when(ahead, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    number = F.col("__cf_hb") * F.lit(factor).cast("long") + F.col("__cf_n")
    return out.select(*cols, number.alias(bucket),
                      *([F.col("__cf_cuts").isNotNull().alias(flag)] if flag else []))
