"""Historical retrieval: point-in-time join of many feature views.

``get_historical_features`` composes one lazy DataFrame: for each requested
view, read its source (column-pruned, time-bounded), project it (field
mapping, key map, feature names) and as-of join it onto the running result.
Views on the same keys and bucket width share a pass; every pass reads the
spine, and one final aggregate brings the passes' answers together.  The
only eager work is small and bounded: the spine's min/max event time, which
bounds every source scan (``prune_by_spine_range=False`` skips it), one
statistics job a pass (``bucket_width=None`` skips it; with hot keys two more,
over their rows), the pair counts of ``strategy="join"``, and the key filter.
"""

from __future__ import annotations

import warnings
from typing import Any, Iterable, List, Optional, Sequence, Tuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ondemand import apply_on_demand
from ..functions.timecols import epoch_micros, micros_literal, raw_bounds, ttl_micros
from ..model import (
    DEFAULT_EVENT_TIMESTAMP_COL,
    FULL_NAME_SEPARATOR,
    BucketedTableSource,
    FeatureView,
    OnDemandFeatureView,
    group_feature_refs,
)
from ..operators.asof import C_COL, T_COL, AsofPass, AsofView, join_pairs, point_in_time_join_passes
from ..operators.asof_stats import PassStats, key_hash, pass_stats
from ..operators.frame import detect_event_timestamp_column, rename_columns
from ..operators.keyfilter import MAX_KEYS, KeyFilter, can_filter
from ..session import shared_dir
from ..sources.readers import bucket_spec, check_columns, prune_partitions, read_source

#: The ``join`` strategy is used up to this many pairs per input row.
JOIN_PAIRS_PER_ROW = 4


def prepare_entity_df(entity_df: Any, spark: Optional[SparkSession] = None) -> DataFrame:
    """Spine ingest: a Spark DataFrame passes through; a pandas DataFrame is
    converted (naive datetimes are taken as UTC, not as session-local time);
    anything else is a ``ValueError``."""
    if isinstance(entity_df, DataFrame):
        return entity_df
    try:
        import pandas as pd
    except ImportError:  # pragma: no cover
        pd = None
    if pd is not None and isinstance(entity_df, pd.DataFrame):
        spark = spark or SparkSession.getActiveSession()
        if spark is None:
            raise ValueError("a SparkSession is needed to convert a pandas entity_df")
        pdf = entity_df.copy()
        for c in pdf.columns:
            if pd.api.types.is_datetime64_any_dtype(pdf[c]) and getattr(pdf[c].dt, "tz", None) is None:
                pdf[c] = pdf[c].dt.tz_localize("UTC")
        return spark.createDataFrame(pdf)
    raise ValueError(
        f"cannot read entities from a {type(entity_df).__name__}: "
        f"pass a Spark or a pandas DataFrame as entity_df")


def output_feature_name(view: FeatureView, feature: str, full_feature_names: bool) -> str:
    if full_feature_names:
        return f"{view.name_to_use()}{FULL_NAME_SEPARATOR}{feature}"
    return feature


def prepare_view_source(spark: SparkSession, view: FeatureView, features: Sequence[str],
                        out_names: Sequence[str], bounds_us: Optional[Tuple[int, int]] = None
                        ) -> Tuple[DataFrame, bool]:
    """Source of one view as ``keys (spine names), T_COL, [C_COL], features``.

    The field mapping is applied first; the key map then names the source's
    entity columns after the spine columns.  ``bounds_us`` (inclusive epoch
    micros) becomes a literal predicate on the raw time column, which reaches
    the Parquet scan, and on the date partition column if its grain is declared."""
    src = view.source
    df = read_source(spark, src)
    df = rename_columns(df, src.mapping)
    ts, cr = src.timestamp_field, src.created_timestamp_column
    check_columns(df, list(view.entities) + [ts] + ([cr] if cr else []), src)
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise ValueError(f"view {view.name!r}: features {missing} not in source columns {df.columns}")
    tdt = df.schema[ts].dataType
    if bounds_us is not None:
        lo, hi = bounds_us
        if isinstance(tdt, (T.TimestampType, T.TimestampNTZType)):
            df = df.where((F.col(ts) >= micros_literal(lo, tdt)) & (F.col(ts) <= micros_literal(hi, tdt)))
        else:   # dates, strings, numbers: own bounds for the scan, then parsed micros (exact)
            bounds = raw_bounds(ts, tdt, lo, hi, src.timestamp_text == "iso")
            if bounds is not None:
                df = df.where(bounds)
            m = epoch_micros(ts, tdt)
            df = df.where((m >= F.lit(lo)) & (m <= F.lit(hi)))
        df = prune_partitions(df, src, lo, hi)
    key_map = view.key_map
    cols = [F.col(k).alias(key_map.get(k, k)) for k in view.entities]
    cols.append(epoch_micros(ts, tdt).alias(T_COL))
    if cr:
        cols.append(epoch_micros(cr, df.schema[cr].dataType).alias(C_COL))
    cols += [F.col(f).alias(o) for f, o in zip(features, out_names)]
    return df.select(*cols), bool(cr)


def feature_projection(view: FeatureView, features: Sequence[str], full_feature_names: bool = False,
                       spark: Optional[SparkSession] = None) -> DataFrame:
    """The view's source as the join sees it: field mapping applied, entity
    columns under their (key-mapped) names, the time column(s), then the
    features under their output names."""
    spark = spark or SparkSession.getActiveSession()
    src = view.source
    df = read_source(spark, src)
    df = rename_columns(df, src.mapping)
    key_map = view.key_map
    ts, cr = src.timestamp_field, src.created_timestamp_column
    cols = [F.col(k).alias(key_map.get(k, k)) for k in view.entities] + [F.col(ts)]
    if cr:
        cols.append(F.col(cr))
    cols += [F.col(f).alias(output_feature_name(view, f, full_feature_names)) for f in features]
    return df.select(*cols)


def spine_time_bounds(spine: DataFrame, ts: str) -> Optional[Tuple[int, int]]:
    """(min, max) event time of the spine in epoch micros; one small job
    (a global aggregate: one row comes back)."""
    row = spine.agg(F.min(epoch_micros(ts, spine.schema[ts].dataType)).alias("lo"),
                    F.max(epoch_micros(ts, spine.schema[ts].dataType)).alias("hi")).first()
    if row is None or row["lo"] is None:
        return None
    return int(row["lo"]), int(row["hi"])


def _pruned(spine: DataFrame, keys: Sequence[str], srcs: List[DataFrame], mode: str, stats: Optional[PassStats],
            filters: dict) -> List[DataFrame]:
    """``srcs`` without rows of keys that the spine lacks, where that pays.
    ``filters`` keeps the filter of each key set for later passes."""
    if mode == "off" or not can_filter(spine, keys) or (mode == "auto" and stats is None):
        return srcs
    if stats is not None:
        count = stats.spine_keys
    else:
        count = int(spine.agg(F.approx_count_distinct(key_hash(keys))).first()[0])
    wanted = [mode == "on" or 2 * count <= stats.source_keys[i] for i in range(len(srcs))]
    if count > MAX_KEYS or not any(wanted):
        return srcs
    if tuple(keys) not in filters:
        filters[tuple(keys)] = KeyFilter(spine, keys, count)
    return [filters[tuple(keys)].prune(s) if use else s for s, use in zip(srcs, wanted)]


def _stored_buckets(spark: SparkSession, spine: DataFrame, views: Sequence[FeatureView]) -> int:
    """The number of buckets that all of these views' sources are stored in by
    exactly their keys, in the spine's types; 0 if they are not."""
    found = set()
    for v in views:
        src = v.source
        if not isinstance(src, BucketedTableSource) or not v.entities:
            return 0
        n, cols = bucket_spec(spark, src.table)
        stored = rename_columns(spark.table(src.table), src.mapping)
        if [src.mapping.get(c, c) for c in cols] != list(v.entities) or any(
                stored.schema[e].dataType != spine.schema[k].dataType for e, k in zip(v.entities, v.join_keys)):
            return 0
        found.add(n)
    return found.pop() if len(found) == 1 else 0


def get_historical_features(entity_df: Any, feature_views: Sequence[FeatureView],
                            feature_refs: Iterable, full_feature_names: bool = False, *,
                            on_demand_feature_views: Sequence[OnDemandFeatureView] = (),
                            spark: Optional[SparkSession] = None,
                            strategy: str = "bucketed",
                            bucket_width="auto",
                            max_bucket_rows: int = 2_000_000,
                            keep_unmatched: bool = False,
                            prune_by_spine_range: bool = True,
                            event_timestamp_column: Optional[str] = None,
                            checkpoint_every: Optional[int] = None,
                            max_views_per_pass: int = 8,
                            key_filter: str = "auto") -> DataFrame:
    """Training set: the spine plus, per requested feature, the value of the
    latest source row inside the view's TTL at each spine row's event time.

    Options: ``strategy`` ``"bucketed"`` (default; linear, skew-aware) or
    ``"join"`` (used per view only when its pairs are counted as few, else
    bucketed); ``bucket_width`` ``"auto"`` (default: one bucket per TTL) or a
    timedelta (buckets that a pass's statistics find hot are cut into slices at
    quantiles of their times), or ``None`` (one bucket per TTL, no
    statistics); ``max_bucket_rows`` the row budget of one window partition;
    ``key_filter`` ``"auto"`` (default: where the statistics find at most half
    as many keys in the spine as in a source, a Bloom filter of the spine's
    keys is tested in that source's scan), ``"on"`` (in every keyed source,
    also of views without statistics) or ``"off"``; there is no filter above
    4 million keys (:mod:`..operators.keyfilter`); ``keep_unmatched`` keeps spine rows without a
    match in TTL views (NULL features); ``prune_by_spine_range`` bounds every
    TTL view's scan by the spine's event-time range (one small job);
    ``max_views_per_pass`` caps how many views share one pass (each adds a
    column to every source row of the pass);
    ``checkpoint_every=N`` checkpoints (into ``spark.checkpoint.dir``) the
    answers of every N passes, which bounds lineage and plan size for requests
    over very many entities.

    Rules: created time outranks event time; ties break by the features in
    request order (descending, NULL lowest); NULL keys never match; spine
    rows equal on (all join keys of all views + event time) collapse to one;
    a TTL view drops unmatched spine rows unless ``keep_unmatched``; a view
    without TTL keeps them with NULL features.  Output: spine columns, then
    features in request order.
    """
    spine = prepare_entity_df(entity_df, spark)
    spark = spine.sparkSession
    ets = event_timestamp_column or detect_event_timestamp_column(spine, DEFAULT_EVENT_TIMESTAMP_COL)
    if ets not in spine.columns:
        raise ValueError(f"event timestamp column {ets!r} not in entity_df")
    grouped, ods = group_feature_refs(list(feature_refs), list(feature_views), on_demand_feature_views)

    # output names and clashes (checked before any read)
    seen = set(spine.columns)
    plan = []
    for view, feats in grouped:
        outs = [output_feature_name(view, f, full_feature_names) for f in feats]
        for o in outs:
            if o in seen:
                raise ValueError(
                    f"feature column {o!r} clashes with an entity_df column or another feature; "
                    f"use full_feature_names=True or rename it")
            seen.add(o)
        for k in view.join_keys:
            if k not in spine.columns:
                raise ValueError(f"view {view.name_to_use()!r} joins on {k!r}, which entity_df lacks")
        plan.append((view, feats, outs))

    all_keys: List[str] = []
    for view, _, _ in plan:
        for k in view.join_keys:
            if k not in all_keys:
                all_keys.append(k)
    group_key = (all_keys + [ets]) if all_keys else list(spine.columns)

    bounds = None
    ttls = [ttl_micros(v.ttl) for v, _, _ in plan]
    if prune_by_spine_range and any(t is not None for t in ttls):
        bounds = spine_time_bounds(spine, ets)

    bw = bucket_width if bucket_width in (None, "auto") else ttl_micros(bucket_width)
    prepared = []
    for (view, feats, outs), ttl in zip(plan, ttls):
        vb = None
        if bounds is not None and ttl is not None:
            vb = (bounds[0] - ttl, bounds[1])
        src, has_created = prepare_view_source(spark, view, feats, outs, vb)
        # keys in the spine's types before the stats job hashes them, so both sides hash alike
        src = src.select(*[F.col(c).cast(spine.schema[c].dataType).alias(c) if c in view.join_keys else F.col(c)
                           for c in src.columns])
        prepared.append((src, has_created))
    widths = [bw] * len(plan)
    for i, (view, _, _) in enumerate(plan):
        # a Delta / Iceberg source's range-join bin size (seconds) is its bucket width
        rj = getattr(view.source, "range_join", None)
        if rj and bucket_width == "auto" and ttls[i] is not None:
            widths[i] = min(ttl_micros(float(rj)), ttls[i])
    strategies = [strategy] * len(plan)
    for i, (view, _, _) in enumerate(plan):
        if strategy == "join" and ttls[i] is not None:
            pairs, rows = join_pairs(spine, ets, prepared[i][0], view.join_keys, ttls[i])
            if not view.join_keys or pairs > JOIN_PAIRS_PER_ROW * max(rows, 1):
                # the join would form too many pairs (or has no keys):
                # use the linear plan instead, same result
                warnings.warn(f"view {view.name_to_use()!r}: up to {pairs} pairs over {rows} rows; "
                              f"joined by the 'bucketed' strategy instead of 'join'", stacklevel=2)
                strategies[i] = "bucketed"
    # views on the same join keys and bucket width share one as-of pass (one
    # shuffle on (keys, bucket)).  Views with other widths run apart: sharing a narrower bucket
    # would add middle blocks to the wider view, which measured slower than
    # a second pass (equal widths: the shared pass measured ~25% faster).
    groups: dict = {}
    for i, (view, _, _) in enumerate(plan):
        fuse = strategies[i] == "bucketed" and ttls[i] is not None
        if fuse:
            w = min(widths[i], ttls[i]) if isinstance(widths[i], int) else ttls[i]
            gk = (tuple(view.join_keys), "ttl", w)
        else:
            gk = (tuple(view.join_keys), "single", i)
        groups.setdefault(gk, []).append(i)
    # a fused pass gives every source row one ranking column per view (NULL
    # but for its own, 8 bytes each in a row): cap the views per pass
    step = max(1, max_views_per_pass)
    passes = [(gk, idx[c:c + step]) for gk, idx in groups.items() for c in range(0, len(idx), step)]
    if key_filter not in ("auto", "on", "off"):
        raise ValueError(f"key_filter {key_filter!r} is none of 'auto', 'on', 'off'")
    joins, filters = [], {}
    for gk, idx in passes:
        pass_keys, srcs = list(gk[0]), [prepared[i][0] for i in idx]
        stats = None
        if gk[1] == "ttl" and bucket_width is not None:
            # per pass: all its sources and the spine rows share the row budget
            stats = pass_stats(spine, ets, pass_keys, [(s, ttls[i]) for s, i in zip(srcs, idx)], gk[2], max_bucket_rows)
        srcs = _pruned(spine, pass_keys, srcs, key_filter, stats, filters)
        avs = [AsofView(s, list(plan[i][2]), ttls[i], prepared[i][1], gk[2] if gk[1] == "ttl" else None)
               for s, i in zip(srcs, idx)]
        joins.append(AsofPass(pass_keys, avs, strategies[idx[0]], stats,
                              _stored_buckets(spark, spine, [plan[i][0] for i in idx])))
    if checkpoint_every:
        shared_dir(spark)
    # one final aggregate for all passes; nothing to join where no view was asked for
    result = point_in_time_join_passes(spine, ets, group_key, joins, keep_unmatched, max_bucket_rows,
                                       checkpoint_every) if joins else spine
    feature_cols = [o for _, _, outs in plan for o in outs]
    result = result.select(*spine.columns, *feature_cols)
    for od in ods:
        result = apply_on_demand(result, od)
    return result


def retrieval_metadata(entity_df: Any, feature_refs: Iterable, spark: Optional[SparkSession] = None,
                       event_timestamp_column: Optional[str] = None) -> dict:
    """Metadata of a retrieval: the requested feature refs, the entity
    columns (spine columns but the event time) and the spine's min / max
    event time (one global aggregate; one row comes back)."""
    spine = prepare_entity_df(entity_df, spark)
    ets = event_timestamp_column or detect_event_timestamp_column(spine, DEFAULT_EVENT_TIMESTAMP_COL)
    row = spine.agg(F.min(ets).alias("lo"), F.max(ets).alias("hi")).first()
    return {"features": [r if isinstance(r, str) else ":".join(r) for r in feature_refs],
            "keys": [c for c in spine.columns if c != ets],
            "min_event_timestamp": row["lo"], "max_event_timestamp": row["hi"]}
