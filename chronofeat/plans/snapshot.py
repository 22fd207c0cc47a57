"""Table extraction and materialization.

``pull_latest_from_table_or_query``: latest row per key in ``[start, end)``.
``pull_all_from_table_or_query``: every row in range, one per (keys, ts).
``materialize``: write the latest rows of a view as a Parquet snapshot;
re-materializing merges the previous snapshot with the new range and writes
a new snapshot (inputs are never overwritten while being read).
``get_online_features``: batch lookup of keys in a snapshot (left join;
unknown keys get NULLs).
``persist``: write any result as Parquet and read it back.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timecols import python_to_micros

from ..model import DUMMY_ENTITY_ID, DUMMY_ENTITY_VAL, FULL_NAME_SEPARATOR, DataSource, FeatureView
from ..operators.frame import check_unique_names, filter_time_range, keep_latest, rename_columns
from ..session import scratch_path
from ..sources.readers import check_columns, normalize_path, prune_partitions, read_source


def _session(spark: Optional[SparkSession]) -> SparkSession:
    s = spark or SparkSession.getActiveSession()
    if s is None:
        raise ValueError("no active SparkSession")
    return s


def pull_latest_from_table_or_query(source: DataSource, join_key_columns: Sequence[str],
                                    feature_name_columns: Sequence[str], timestamp_field: str,
                                    created_timestamp_column: Optional[str], start_date, end_date,
                                    spark: Optional[SparkSession] = None) -> DataFrame:
    """Latest row per key in ``[start_date, end_date)``.

    Rank: created, then ts, then the features in order (descending, NULL
    lowest).  Output: keys, features, ts (, created).  Without keys, no
    dedup: every row in range, plus the constant dummy entity column."""
    spark = _session(spark)
    df = read_source(spark, source)
    keys = list(join_key_columns)
    ts_cols = [timestamp_field] + ([created_timestamp_column] if created_timestamp_column else [])
    check_columns(df, keys + ts_cols, source)
    df = filter_time_range(df, timestamp_field, start_date, end_date, source.timestamp_text == "iso")
    df = prune_partitions(df, source, python_to_micros(start_date), python_to_micros(end_date))
    cols = check_unique_names(keys + list(feature_name_columns) + ts_cols)
    df = df.select(*cols)
    if keys:
        order = ([created_timestamp_column] if created_timestamp_column else []) + [timestamp_field]
        return keep_latest(df, keys, order)
    return df.select(F.lit(DUMMY_ENTITY_VAL).alias(DUMMY_ENTITY_ID), *cols)


def pull_all_from_table_or_query(source: DataSource, join_key_columns: Sequence[str],
                                 feature_name_columns: Sequence[str], timestamp_field: str,
                                 start_date, end_date, spark: Optional[SparkSession] = None) -> DataFrame:
    """All rows in range; rows equal on (keys, ts) still collapse to one."""
    return pull_latest_from_table_or_query(
        source, list(join_key_columns) + [timestamp_field], feature_name_columns,
        timestamp_field, None, start_date, end_date, spark=spark)


def view_latest(view: FeatureView, start_date, end_date, spark: Optional[SparkSession] = None,
                features: Optional[Sequence[str]] = None) -> DataFrame:
    """``pull_latest`` for a feature view (field mapping applied first)."""
    from ..model import DataFrameSource
    spark = _session(spark)
    src = view.source
    df = rename_columns(read_source(spark, src), src.mapping)
    feats = list(features or view.feature_names)
    if not feats:
        # no declared schema: every column but keys, times and the partition column
        skip = set(view.entities) | {src.timestamp_field, src.created_timestamp_column,
                                     src.date_partition_column}
        feats = [c for c in df.columns if c not in skip]
    return pull_latest_from_table_or_query(
        DataFrameSource(df=df, timestamp_field=src.timestamp_field,
                        created_timestamp_column=src.created_timestamp_column,
                        date_partition_column=src.date_partition_column,
                        date_partition_grain=src.date_partition_grain, timestamp_text=src.timestamp_text),
        list(view.entities), feats, src.timestamp_field, src.created_timestamp_column,
        start_date, end_date, spark=spark)


def merge_snapshots(old: DataFrame, new: DataFrame, keys: Sequence[str], timestamp_field: str,
                    created_timestamp_column: Optional[str] = None) -> DataFrame:
    """Newest row per key across an old snapshot and newly pulled rows
    (a late correction with a newer created time wins)."""
    u = old.unionByName(new, allowMissingColumns=True)
    order = ([created_timestamp_column] if created_timestamp_column else []) + [timestamp_field]
    if not keys:
        return u
    return keep_latest(u, list(keys), order)


def materialize(view: FeatureView, start_date, end_date, path: Optional[str] = None,
                previous: Optional[str] = None, spark: Optional[SparkSession] = None,
                table: Optional[str] = None, num_buckets: Optional[int] = None) -> str:
    """Write the view's latest rows in ``[start, end)`` as a Parquet snapshot.

    With ``previous`` (the path, or table name, of an earlier snapshot) the
    two are merged so the newest row per key wins.  Returns the new snapshot
    path, by default a fresh folder under ``spark.checkpoint.dir``; reading
    it back cuts the lineage of the whole materialization.

    With ``table`` and ``num_buckets`` the snapshot is written instead as a
    catalog table bucketed and sorted by the entity keys, and the table name
    is returned: later lookups on those keys then shuffle only the entity
    rows, never the snapshot."""
    spark = _session(spark)
    new = view_latest(view, start_date, end_date, spark=spark)
    src = view.source
    order = ([src.created_timestamp_column] if src.created_timestamp_column else []) + [src.timestamp_field]
    keys = list(view.entities) or [DUMMY_ENTITY_ID]
    if not view.entities:
        # a snapshot holds one row per key: for an entityless view, the
        # latest row under the constant dummy key
        new = keep_latest(new, keys, order)
    if previous:
        # a path has a slash or a scheme; anything else names a catalog table
        is_path = "/" in previous or ":" in previous
        old = spark.read.parquet(normalize_path(previous)) if is_path else spark.table(previous)
        new = merge_snapshots(old, new, keys, src.timestamp_field, src.created_timestamp_column)
    if table:
        if not num_buckets:
            raise ValueError("a bucketed snapshot table needs num_buckets")
        new.write.mode("errorifexists").format("parquet").bucketBy(num_buckets, *keys) \
            .sortBy(*keys).saveAsTable(table)
        return table
    out = path or scratch_path(spark, f"snapshot-{view.name}")
    new.write.mode("errorifexists").parquet(normalize_path(out))
    return out


def get_online_features(snapshot: DataFrame, entity_rows: DataFrame, keys: Sequence[str],
                        features: Sequence[str], view_name: Optional[str] = None,
                        full_feature_names: bool = False) -> DataFrame:
    """Batch lookup: every entity row with the snapshot's features for its
    keys (NULL when the key is unknown).  The snapshot is unique per key, so
    the join cannot fan out; Spark broadcasts it only below its size limit."""
    snap = snapshot.select(*keys, *[F.col(f).alias(
        f"{view_name}{FULL_NAME_SEPARATOR}{f}" if (full_feature_names and view_name) else f)
        for f in features])
    return entity_rows.join(snap, list(keys), "left")


def persist(df: DataFrame, path: Optional[str] = None, fmt: str = "parquet") -> DataFrame:
    """Write a result (a directory of part files) and return it read back."""
    spark = df.sparkSession
    out = normalize_path(path or scratch_path(spark, "persist"))
    df.write.mode("errorifexists").format(fmt).save(out)
    return spark.read.format(fmt).load(out)
