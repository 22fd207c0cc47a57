"""A feature-store facade over the functions of this package.

Holds feature-view definitions and a snapshot root; offers the calls a
feature-store user makes: historical retrieval by ``view:feature`` refs,
materialization of a time range (merged into the previous snapshot of each
view), and batch lookup of the latest features for entity rows.  All data
work is lazy DataFrames; the only driver-side state is the definitions and
the snapshot paths, which a ledger beside the snapshots keeps for the next
store on the same root.
"""

from __future__ import annotations

import re
import uuid

from datetime import datetime, timedelta
from typing import Any, Dict, Iterable, Optional, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.ondemand import apply_on_demand
from .functions.timecols import python_to_micros
from .model import FeatureView, OnDemandFeatureView, group_feature_refs
from .plans.retrieval import get_historical_features, output_feature_name
from .plans.bucket_snapshot import BucketSnapshot, materialize_buckets
from .plans.snapshot import get_online_features, materialize
from .session import shared_dir
from .sources.readers import normalize_path

#: One row per snapshot a store wrote.
LEDGER = "view string, snapshot string, end_us long, generation long"


class FeatureStore:
    def __init__(self, spark: SparkSession, views: Sequence[FeatureView],
                 on_demand_views: Sequence[OnDemandFeatureView] = (),
                 snapshot_root: Optional[str] = None, snapshot_buckets: Optional[int] = None,
                 table_prefix: str = "chronofeat_snapshot", merge_buckets: Optional[int] = None):
        """``snapshot_buckets=N`` writes snapshots as catalog tables bucketed
        by the entity keys (named ``<table_prefix>_<view>_<generation>_<attempt>``),
        so lookups shuffle only the entity rows.  ``merge_buckets=N`` keeps one
        snapshot a view, split by key hash: a merge rewrites only the buckets
        it touches, and a lookup opens only those of its keys
        (:mod:`.plans.bucket_snapshot`).  Every attempt writes under a name of
        its own, so what a killed call left behind is never in the way."""
        if snapshot_buckets and merge_buckets:
            raise ValueError("give snapshot_buckets or merge_buckets, not both")
        self.snapshot_buckets, self.merge_buckets = snapshot_buckets, merge_buckets
        self.table_prefix = table_prefix
        self.spark = spark
        self.views = list(views)
        self.on_demand_views = list(on_demand_views)
        self.snapshot_root = (snapshot_root or f"{shared_dir(spark)}/chronofeat/store").rstrip("/")
        self._snapshots: Dict[str, str] = {}
        self._last_end: Dict[str, Any] = {}
        self._generation = 0
        self._restore()

    def _restore(self) -> None:
        """Go on from the ledger of an earlier store on the same root: the
        newest entry of each view (one row per view comes back)."""
        try:
            ledger = self.spark.read.schema(LEDGER).parquet(self._ledger)
            rows = ledger.groupBy("view").agg(F.max_by(F.struct("snapshot", "end_us"), "generation").alias("x"),
                                              F.max("generation").alias("generation")).collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        for r in rows:
            self._snapshots[r["view"]] = r["x"]["snapshot"]
            self._last_end[r["view"]] = datetime(1970, 1, 1) + timedelta(microseconds=r["x"]["end_us"])
            self._generation = max(self._generation, r["generation"])

    @property
    def _ledger(self) -> str:
        kind = f"tables-{self.table_prefix}" if self.snapshot_buckets else "buckets" if self.merge_buckets else "folders"
        return normalize_path(f"{self.snapshot_root}/_ledger/{kind}")

    def get_historical_features(self, entity_df: Any, features: Iterable, full_feature_names: bool = False,
                                **options) -> DataFrame:
        return get_historical_features(entity_df, self.views, list(features), full_feature_names,
                                       on_demand_feature_views=self.on_demand_views, spark=self.spark,
                                       **options)

    def materialize(self, start_date, end_date, views: Optional[Sequence[str]] = None) -> Dict[str, str]:
        """Snapshot the latest row per key of each view in ``[start, end)``,
        merged with the view's previous snapshot; returns the new paths."""
        self._generation += 1
        out = {}
        for v in self.views:
            name = v.name_to_use()
            if views is not None and name not in views:
                continue
            attempt = uuid.uuid4().hex[:12]
            if self.merge_buckets:
                out[name] = f"{self.snapshot_root}/{name}/buckets"
                materialize_buckets(v, start_date, end_date, out[name], self.merge_buckets, spark=self.spark)
                continue
            if self.snapshot_buckets:
                table = re.sub(r"\W", "_", f"{self.table_prefix}_{name}_{self._generation}_{attempt}")
                out[name] = materialize(v, start_date, end_date, previous=self._snapshots.get(name),
                                        spark=self.spark, table=table, num_buckets=self.snapshot_buckets)
                continue
            path = f"{self.snapshot_root}/{name}/gen-{self._generation}-{attempt}"
            out[name] = materialize(v, start_date, end_date, path=path,
                                    previous=self._snapshots.get(name), spark=self.spark)
        if out:
            entries = [(n, p, python_to_micros(end_date), self._generation) for n, p in out.items()]
            self.spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("append").parquet(self._ledger)
        self._snapshots.update(out)
        for name in out:
            self._last_end[name] = end_date
        return out

    def materialize_incremental(self, end_date, views: Optional[Sequence[str]] = None) -> Dict[str, str]:
        """Materialize each view from where its last materialization ended
        (first time: ``end - ttl``, or the epoch without TTL) up to ``end``."""
        out = {}
        for v in self.views:
            name = v.name_to_use()
            if views is not None and name not in views:
                continue
            start = self._last_end.get(name)
            if start is None:
                start = (end_date - v.ttl) if v.ttl else datetime(1970, 1, 1)
            out.update(self.materialize(start, end_date, views=[name]))
        return out

    def snapshot(self, view_name: str) -> DataFrame:
        if view_name not in self._snapshots:
            raise ValueError(f"view {view_name!r} has not been materialized")
        if self.merge_buckets:
            return BucketSnapshot(self.spark, self._snapshots[view_name]).read()
        if self.snapshot_buckets:
            return self.spark.table(self._snapshots[view_name])
        return self.spark.read.parquet(self._snapshots[view_name])

    def get_online_features(self, features: Iterable, entity_rows: Any,
                            full_feature_names: bool = False) -> DataFrame:
        """Latest materialized features for every entity row (NULL for
        unknown keys).  ``entity_rows``: a DataFrame, or a list of dicts
        (small user input, turned into a DataFrame)."""
        rows = entity_rows
        if not isinstance(rows, DataFrame):
            rows = self.spark.createDataFrame(list(rows))
        grouped, ods = group_feature_refs(list(features), self.views, self.on_demand_views)
        out = rows
        for view, feats in grouped:
            keys = view.join_keys
            names = [output_feature_name(view, f, full_feature_names) for f in feats]
            if self.merge_buckets and keys:
                out = self._bucket_lookup(view, out, keys, feats, names)
                continue
            snap = self.snapshot(view.name_to_use())
            if not keys:
                # entityless: the snapshot is one row, attached as a scalar subquery
                one = snap.select(F.struct(*[F.col(f).alias(n) for f, n in zip(feats, names)]).alias("x"))
                out = out.withColumn("__cf_x", one.scalar()).select(
                    "*", *[F.col("__cf_x")[n].alias(n) for n in names]).drop("__cf_x")
                continue
            # the snapshot is keyed by the view's entity names; name them as the rows do
            km = view.key_map
            snap = snap.select(*[F.col(e).alias(km.get(e, e)) for e in view.entities],
                               *[F.col(f) for f in feats])
            snap = snap.select(*keys, *[F.col(f).alias(output_feature_name(view, f, full_feature_names))
                                        for f in feats])
            # one row per key in a snapshot: the left join cannot fan out
            out = get_online_features(snap, out, keys, [output_feature_name(view, f, full_feature_names)
                                                         for f in feats])
        for od in ods:
            out = apply_on_demand(out, od)
        return out

    def _bucket_lookup(self, view: FeatureView, rows: DataFrame, keys: Sequence[str], feats: Sequence[str],
                       names: Sequence[str]) -> DataFrame:
        """``rows`` with ``feats`` (as ``names``) from the buckets that their keys fall into."""
        if view.name_to_use() not in self._snapshots:
            raise ValueError(f"view {view.name_to_use()!r} has not been materialized")
        store = BucketSnapshot(self.spark, self._snapshots[view.name_to_use()])
        asked = rows.select(*[F.col(k).alias(e) for k, e in zip(keys, view.entities)]).distinct()
        found = store.lookup(asked, feats).select(*[F.col(e).alias(k) for k, e in zip(keys, view.entities)],
                                                  *[F.col(f).alias(n) for f, n in zip(feats, names)])
        return rows.join(found, list(keys), "left")
