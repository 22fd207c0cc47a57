"""Incremental materialization with Structured Streaming.

New files landing in a Parquet or CSV source folder are picked up as micro-batches.
Each batch is reduced to its latest row per key (partial aggregate) and
written under ``<snapshot>/batch_id=<n>``; the folder of a batch is replaced
when Spark replays the batch, so a restart after a lost executor or driver
writes each batch exactly once.  ``read_snapshot`` returns the newest row per
key across all batches; ``compact`` rewrites them into one snapshot.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..model import FeatureView, FileSource
from ..operators.frame import keep_latest, rename_columns
from ..session import scratch_path
from ..sources.readers import normalize_path, stream_source


def _order(view: FeatureView):
    src = view.source
    return ([src.created_timestamp_column] if src.created_timestamp_column else []) + [src.timestamp_field]


def incremental_materialize(spark: SparkSession, view: FeatureView, snapshot_path: str,
                            checkpoint_location: Optional[str] = None,
                            trigger_once: bool = True) -> StreamingQuery:
    """Start a stream that keeps ``snapshot_path`` up to date for ``view``."""
    src = view.source
    if not isinstance(src, FileSource):
        raise TypeError("incremental materialization reads a file source folder")
    keys = list(view.entities)
    feats = view.feature_names
    cols = keys + [c for c in feats if c not in keys] + _order(view)
    stream = rename_columns(stream_source(spark, src), src.mapping).select(*cols)
    out = normalize_path(snapshot_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        reduced = keep_latest(batch, keys, _order(view)) if keys else batch
        reduced.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option(
        "checkpointLocation", checkpoint_location or scratch_path(spark, f"stream-{view.name}"))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def read_snapshot(spark: SparkSession, view: FeatureView, snapshot_path: str) -> DataFrame:
    df = spark.read.parquet(normalize_path(snapshot_path)).drop("batch_id")
    keys = list(view.entities)
    return keep_latest(df, keys, _order(view)) if keys else df


def compact(spark: SparkSession, view: FeatureView, snapshot_path: str,
            out_path: Optional[str] = None) -> str:
    out = out_path or scratch_path(spark, f"compact-{view.name}")
    read_snapshot(spark, view, snapshot_path).write.mode("errorifexists").parquet(normalize_path(out))
    return out
