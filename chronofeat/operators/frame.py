"""Frame operators: projections, predicates, dedup, latest-row, sort.

Each function is ``DataFrame -> DataFrame`` (or a schema lookup) and stays
lazy.  Aggregations that pick "the latest row" use ``max(struct(...))``:
a hash aggregate with a map-side partial step, so a hot key is reduced on
every map task before the shuffle instead of being collected into one task.
"""

from __future__ import annotations

from typing import Iterable, List, Mapping, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import (
    epoch_micros,
    micros_literal,
    python_to_micros,
    raw_bounds,
    ttl_micros,
)
from ..session import scratch_path

# ---------------------------------------------------------------------------
# Projections and schema lookups


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in columns])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Simultaneous rename; unmapped columns kept, unknown keys ignored.
    ``{a: b, b: a}`` swaps the two columns."""
    if not mapping:
        return df
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def add_static_column(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def columns_list(df: DataFrame) -> List[str]:
    return list(df.columns)


_DTYPE_GROUPS = {
    "datetime": (T.TimestampType, T.TimestampNTZType),
    "datetimetz": (T.TimestampType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
    "date": (T.DateType,),
    "number": (T.NumericType,),
    "string": (T.StringType,),
    "bool": (T.BooleanType,),
}


def select_dtypes_columns(df: DataFrame, include: Iterable[str]) -> List[str]:
    """Columns whose type is in one of the ``include`` groups."""
    kinds = tuple(k for g in include for k in _DTYPE_GROUPS.get(g, ()))
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, kinds) and f.name not in out:
            out.append(f.name)
    return out


def detect_event_timestamp_column(df: DataFrame, default: str = "event_timestamp") -> str:
    """``event_timestamp`` if present, else the only timestamp column."""
    if default in df.columns:
        return default
    cands = select_dtypes_columns(df, ["datetime"])
    if len(cands) == 1:
        return cands[0]
    raise ValueError(
        f"no event time found: name one column {default!r} or pass a frame with exactly "
        f"one timestamp column (here: {cands})")


# ---------------------------------------------------------------------------
# Left equi-join of the entity table with a frame


def join_left(left: DataFrame, right: DataFrame, keys: Sequence[str],
              max_rows_per_key: Optional[int] = None) -> DataFrame:
    """Left outer equi-join on ``keys`` (entity table on the left).

    A non-key column present on both sides is an error (named), rather than
    an ambiguous column or a silent suffix.  Physical strategy is left to
    Spark: broadcast only when the right side's size is below the configured
    limit (also re-decided by AQE at runtime), else a sort-merge join whose
    skewed *left* partitions AQE splits.

    AQE cannot split the right side of a left join.  With
    ``max_rows_per_key=N`` right-side keys holding more than N rows are
    salted: rows per key are counted (partial counts on every task) and
    joined back to both sides, where the right side's hot keys are the large
    left side of an equi-join with a unique right side, which AQE splits.
    Each hot key's right rows spread round-robin over ``ceil(count / N)``
    salts, and the matching left rows are replicated once per salt.  Other
    keys keep salt 0.  Nothing is collected or broadcast by force.  The
    result is the same rows."""
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    if clash:
        raise ValueError(f"columns {clash} exist on both sides of the join; rename or drop them")
    keys = list(keys)
    if not max_rows_per_key:
        return left.join(right, keys, "left")
    hot = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cf_n")) \
        .where(F.col("__cf_n") > F.lit(max_rows_per_key)) \
        .select(*keys, F.ceil(F.col("__cf_n") / F.lit(max_rows_per_key)).cast("int").alias("__cf_salts"))
    salts = F.coalesce(F.col("__cf_salts"), F.lit(1))
    # numbered before the first shuffle: a task that runs again salts its rows alike,
    # and exact duplicates spread too
    r = right.withColumn("__cf_id", F.monotonically_increasing_id()).join(hot, keys, "left") \
        .withColumn("__cf_salt", F.pmod(F.col("__cf_id"), salts.cast("long"))) \
        .withColumn("__cf_hit", F.lit(True)).drop("__cf_salts", "__cf_id")
    lft = left.join(hot, keys, "left") \
        .withColumn("__cf_hot", F.col("__cf_salts").isNotNull()) \
        .withColumn("__cf_salt", F.explode(F.sequence(F.lit(0).cast("long"), (salts - 1).cast("long")))) \
        .drop("__cf_salts")
    out = lft.join(r, keys + ["__cf_salt"], "left")
    # a hot key always has right rows, so a replica of it that met none (its
    # salt got no right row) is not an unmatched row: drop it
    out = out.where(~F.col("__cf_hot") | F.col("__cf_hit").isNotNull())
    return out.select(*[F.col(c) for c in left.columns],
                      *[F.col(c) for c in right.columns if c not in keys])


# ---------------------------------------------------------------------------
# Time predicates


def filter_ttl(df: DataFrame, event_ts: str, ts: str, ttl) -> DataFrame:
    """Keep rows with ``event_ts - ttl <= ts <= event_ts`` (both inclusive).
    No TTL (None / 0): no filter at all.  A NULL time drops the row."""
    us = ttl_micros(ttl)
    if us is None:
        return df
    e = epoch_micros(event_ts, df.schema[event_ts].dataType)
    t = epoch_micros(ts, df.schema[ts].dataType)
    return df.where((t >= e - F.lit(us)) & (t <= e))


def filter_time_range(df: DataFrame, ts: str, start, end, iso_text: bool = False) -> DataFrame:
    """Keep rows with ``start <= ts < end`` (half-open).

    The bounds become literals of the column's own type, so the predicate is
    pushed into the Parquet scan and prunes row groups; for text only if
    ``iso_text`` says that it begins with yyyy-MM-dd."""
    dt = df.schema[ts].dataType
    if not isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        # dates, strings, numbers: own bounds for the scan, then parsed epoch micros (exact)
        bounds = raw_bounds(ts, dt, python_to_micros(start), python_to_micros(end), iso_text)
        if bounds is not None:
            df = df.where(bounds)
        m = epoch_micros(ts, dt)
        return df.where((m >= F.lit(python_to_micros(start))) & (m < F.lit(python_to_micros(end))))
    lo = micros_literal(python_to_micros(start), dt)
    hi = micros_literal(python_to_micros(end), dt)
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


# ---------------------------------------------------------------------------
# ordering helpers


def is_orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)) if hasattr(T, "VariantType") else isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.ArrayType):
        return is_orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(is_orderable(f.dataType) for f in dt.fields)
    return True


def rank_fields(df: DataFrame, order_cols: Sequence[Union[str, Column]],
                tie_cols: Sequence[str]) -> List[Column]:
    """Fields of the ranking struct: order columns, then orderable tie columns."""
    out = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    for c in tie_cols:
        if is_orderable(df.schema[c].dataType):
            out.append(F.col(c))
    return out


def latest_struct_agg(order: List[Column], payload: List[Column], all_orderable: bool) -> Column:
    """Aggregate picking the row with the largest ``order`` struct.

    Struct comparison is field by field with NULL lowest, so rows with a
    NULL ``created`` lose to rows that have one.  When every payload field
    is orderable one ``max(struct(order, payload))`` does it; otherwise
    ``max_by(payload, order)``."""
    o = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    p = F.struct(*payload)
    if all_orderable:
        return F.max(F.struct(o.alias("o"), p.alias("p")))["p"]
    return F.max_by(p, o)


def keep_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[Union[str, Column]],
                tie_break: bool = True) -> DataFrame:
    """One row per ``keys``: the one with the largest ``order_cols`` (NULL
    lowest), ties broken by the remaining columns (descending, NULL lowest).

    With no keys the whole frame collapses to one row (global aggregate with
    partial aggregation on every task)."""
    others = [c for c in df.columns if c not in keys]
    named_order = {c for c in order_cols if isinstance(c, str)}
    tie = [c for c in others if c not in named_order] if tie_break else []
    orderable = all(is_orderable(df.schema[c].dataType) for c in others)
    if orderable and tie_break and all(isinstance(c, str) for c in order_cols):
        # the ranking struct (order columns, then every other column as a tie
        # breaker) already holds the whole row: shuffle each column once
        fields = list(dict.fromkeys([*order_cols, *tie]))
        best = F.max(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(fields)])).alias("__cf_best")
        name = {c: f"c{i}" for i, c in enumerate(fields)}
    else:
        order = rank_fields(df, order_cols, tie)
        payload = [F.col(c) for c in others]
        best = latest_struct_agg(order, payload, orderable).alias("__cf_best")
        name = {c: c for c in others}
    agg = df.groupBy(*keys).agg(best) if keys else df.agg(best)
    return agg.select(*[F.col(k) for k in keys], *[F.col("__cf_best")[name[c]].alias(c) for c in others]) \
        .select(*df.columns)


# ---------------------------------------------------------------------------
# dedup


def drop_duplicates_keep_last(df: DataFrame, subset: Sequence[str],
                              order_by: Sequence[Union[str, Column]]) -> DataFrame:
    """Distinct on ``subset`` keeping the last row in ``order_by`` order.

    Unlike ``dropDuplicates`` (which keeps an arbitrary row) the survivor is
    determined: largest ``order_by``, then largest remaining columns."""
    return keep_latest(df, list(subset), list(order_by))


def drop_df_duplicates(df: DataFrame, keys: Sequence[str], ts: str,
                       created: Optional[str] = None,
                       entity_ts: Optional[str] = None) -> DataFrame:
    """Latest row per key: rank by ``created`` then ``ts`` (created outranks
    the event time), NULL lowest.  Key = ``keys`` (+ ``entity_ts``)."""
    k = list(keys) + ([entity_ts] if entity_ts else [])
    order = ([created] if created else []) + [ts]
    return keep_latest(df, k, order)


# ---------------------------------------------------------------------------
# D3: sort


def sort_columns(by: Union[str, Sequence[str]], ascending: Union[bool, Sequence[bool]] = True,
                 na_position: str = "last") -> List[Column]:
    by = [by] if isinstance(by, str) else list(by)
    asc = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    out = []
    for c, a in zip(by, asc):
        col = F.col(c)
        if a:
            out.append(col.asc_nulls_first() if na_position == "first" else col.asc_nulls_last())
        else:
            out.append(col.desc_nulls_first() if na_position == "first" else col.desc_nulls_last())
    return out


def sort_values(df: DataFrame, by, ascending=True, na_position: str = "last") -> DataFrame:
    """Global sort (range-partitioned, then sorted per partition)."""
    return df.orderBy(*sort_columns(by, ascending, na_position))


def with_sort_position(df: DataFrame, order: Sequence[Column], pos_col: str = "pos",
                       num_partitions: Optional[int] = None) -> DataFrame:
    """Add the 1-based position of every row in the global ``order``.

    Writes the rows once under the shared folder; for rows that hold little
    besides their order columns that is the cheaper way.
    :func:`sort_positions` writes none of them.

    Distributed: range-partition on the order, sort inside each partition,
    take the in-partition index from ``monotonically_increasing_id`` (its low
    33 bits), count rows per partition, and add the running count of the
    earlier partitions.  The per-partition count table has one row per
    partition (a proven bound), so it is broadcast.  A fixed partition
    count keeps AQE from re-coalescing this shuffle, so partition indexes
    are the range indexes.  Ties in ``order`` get an arbitrary relative
    position, as in any sort; include a unique column for repeatable output.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    tagged = ranged.select("*", F.shiftright(mid, 33).alias("__cf_pid"),
                           mid.bitwiseAND(F.lit((1 << 33) - 1)).alias("__cf_idx"))
    path = scratch_path(spark, "sorted")
    tagged.write.parquet(path)
    tagged = spark.read.schema(tagged.schema).parquet(path)
    counts = tagged.groupBy("__cf_pid").agg(F.count(F.lit(1)).alias("__cf_n"))
    w = Window.orderBy("__cf_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__cf_pid", F.coalesce(F.sum("__cf_n").over(w), F.lit(0)).alias("__cf_off"))
    out = tagged.join(F.broadcast(offsets), "__cf_pid")
    return out.select(*[F.col(c) for c in df.columns],
                      (F.col("__cf_off") + F.col("__cf_idx") + F.lit(1)).cast("long").alias(pos_col))


def _as_list(v, n: int) -> list:
    return list(v) if isinstance(v, (list, tuple)) else [v] * n


def _at_or_before(cut: Column, by: Sequence[str], asc: Sequence[bool], nulls_first: bool) -> Column:
    """Whether the struct ``cut`` (fields ``c0, c1, ...``) comes before a row's
    ``by`` columns in their order, or is equal to them."""
    out = F.lit(True)
    for i in reversed(range(len(by))):
        a, b = cut[f"c{i}"], F.col(by[i])
        less = F.when(a.isNull(), b.isNotNull() & F.lit(nulls_first)).when(b.isNull(), F.lit(not nulls_first)) \
            .otherwise(a < b if asc[i] else a > b)
        out = less | (a.eqNullSafe(b) & out)
    return out


def sort_positions(df: DataFrame, by: Union[str, Sequence[str]], ascending=True, na_position: str = "last",
                   pos_col: str = "pos", num_partitions: Optional[int] = None, sampled: int = 16) -> DataFrame:
    """Add the 1-based position of every row in the global order of ``by``
    (as :func:`sort_values` orders), without writing the rows anywhere.

    Cut points come from a random sample of ``sampled`` rows a partition (order
    columns only; they decide balance alone) and are written once, so that both
    passes below agree on them.  The first pass reads the order columns, finds
    each row's range by binary search among the cuts and counts ranges, with
    partial sums: one number a partition comes back.  The second sends each row
    to its range, sorts there, and adds the counts of the ranges before it.  So
    the payload is shuffled once and never stored.  Equal rows in ``by`` get an
    arbitrary order among themselves and share a range.  ``df`` is read three
    times and must give the same rows each time."""
    spark = df.sparkSession
    by = [by] if isinstance(by, str) else list(by)
    asc = _as_list(ascending, len(by))
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = na_position == "first"
    # at most sampled * n rows of the order columns, sorted in one task
    w = Window.orderBy(*sort_columns(by, asc, na_position))
    some = df.select(*by).orderBy(F.rand(1)).limit(sampled * n).withColumn("__cf_rn", F.row_number().over(w))
    cuts = some.where(F.col("__cf_rn") % sampled == 0).agg(F.sort_array(F.collect_list(F.struct(
        F.col("__cf_rn").alias("rn"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(by)]))).alias("cuts"))
    path = scratch_path(spark, "sort-cuts")
    cuts.write.parquet(path)
    cuts = spark.read.schema(cuts.schema).parquet(path).scalar()

    def ranged(rows: DataFrame) -> DataFrame:
        out, step = rows.withColumn("__cf_range", F.lit(0)), 1 << (n.bit_length() - 1)
        while step:
            cut = F.get(cuts, F.col("__cf_range") + F.lit(step - 1))
            ahead = cut.isNotNull() & _at_or_before(cut, by, asc, first)
            out = out.withColumn("__cf_range", F.col("__cf_range") + F.when(ahead, F.lit(step)).otherwise(F.lit(0)))
            step //= 2
        # Each step names the last one several times.  Where the range is joined on, the planner puts
        # expressions in place of names, down to the scan: fivefold more with every step.  It looks through
        # no generator, so the joined column comes out of one.
        return out.withColumn("__cf_range", F.explode(F.array("__cf_range")))

    counts = {r[0]: r[1] for r in ranged(df.select(*by)).groupBy("__cf_range").count().collect()}    # at most n + 1
    offsets, total = [], 0
    for k in range(n + 1):
        offsets.append((k, total))
        total += counts.get(k, 0)
    table = spark.createDataFrame(offsets, "__cf_range int, __cf_off long")
    out = ranged(df).join(F.broadcast(table), "__cf_range").repartitionById(n + 1, F.col("__cf_range")) \
        .sortWithinPartitions(*sort_columns(by, asc, na_position))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return out.select(*[F.col(c) for c in df.columns], (F.col("__cf_off") + place + F.lit(1)).cast("long").alias(pos_col))


# ---------------------------------------------------------------------------
# Event time range


def event_timestamp_range(df: DataFrame, ts: str) -> DataFrame:
    """One row ``(min_ts, max_ts)``: a global aggregate, partial on each task."""
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def check_unique_names(cols: Sequence[str]) -> List[str]:
    """Column list with duplicates removed, order kept."""
    out: List[str] = []
    for c in cols:
        if c not in out:
            out.append(c)
    return out
