"""A snapshot split by key hash, merged and looked up bucket by bucket.

Layout under ``root``::

    data/<attempt>/bucket=<n>/part-*.parquet     rows of bucket n, one file, sorted by key
    manifest/part-*.parquet                      one file a commit: (version, bucket, folder, ...)

A row's bucket is the hash of its keys modulo ``num_buckets``.  A merge reads
and rewrites only the buckets that new rows fall into, under a name of its own
attempt, and then appends one manifest file; the current folder of a bucket is
the one of its greatest version.  The manifest file is the commit: before it is
there nothing has changed, so a merge that is killed anywhere leaves the
snapshot as it was, and the next one goes on.  Files of superseded or
unfinished attempts stay until :meth:`BucketSnapshot.obsolete` names them to
whoever cleans up.  Merges of one snapshot run one after another.

A lookup of few keys opens the buckets of those keys alone.
"""

from __future__ import annotations

import uuid
from typing import Dict, List, Optional, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import DUMMY_ENTITY_ID, FeatureView
from ..operators.frame import keep_latest
from ..session import scratch_path
from ..sources.readers import normalize_path
from .snapshot import get_online_features, view_latest

BUCKET = "__cf_bucket"
MANIFEST = "version long, bucket int, folder string, num_buckets int, keys string, columns string"


def _bucket(df: DataFrame, keys: Sequence[str], num_buckets: int, types: Optional[T.StructType] = None) -> Column:
    """Bucket of a row; ``types`` gives the keys' types in the snapshot."""
    cols = []
    for k in keys:
        kind = (types or df.schema)[k].dataType
        c = F.col(k).cast(kind)
        # the two zeros of a float are one key
        cols.append(c + F.lit(0).cast(kind) if isinstance(kind, T.FractionalType) else c)
    return F.pmod(F.xxhash64(*cols), F.lit(num_buckets)).cast("int")


class BucketSnapshot:
    """The snapshot at ``root``; nothing is read before it is asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, normalize_path(root.rstrip("/"))

    # -- the manifest -----------------------------------------------------
    def _entries(self) -> Optional[DataFrame]:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def manifest(self) -> Dict[int, dict]:
        """The current entry of every bucket that has rows (at most ``num_buckets`` rows come back)."""
        entries = self._entries()
        if entries is None:
            return {}
        now = entries.groupBy("bucket").agg(F.max_by(F.struct(*entries.columns), "version").alias("e")).select("e.*")
        return {r["bucket"]: r.asDict() for r in now.collect()}

    def obsolete(self) -> List[str]:
        """Folders of buckets that a later version replaced."""
        entries = self._entries()
        if entries is None:
            return []
        current = {e["folder"] for e in self.manifest().values()}
        return sorted(r["folder"] for r in entries.select("folder").distinct().collect() if r["folder"] not in current)

    # -- writing ----------------------------------------------------------
    def merge(self, rows: DataFrame, keys: Sequence[str], order: Sequence[str], num_buckets: int) -> List[int]:
        """Merge ``rows`` in: the newest row per key by ``order`` stays.
        Returns the buckets that were rewritten.

        The rows are written once under the shared folder, as their buckets
        are needed before they are merged.  Columns that rows or snapshot lack
        are NULL there."""
        keys = list(keys)
        now = self.manifest()
        if now:
            one = max(now.values(), key=lambda e: e["version"])
            if one["num_buckets"] != num_buckets or one["keys"] != ",".join(keys):
                raise ValueError(f"the snapshot at {self.root} has {one['num_buckets']} buckets by ({one['keys']})")
        types = self._schema(now)
        if types is not None:              # keep the types that the bucket numbers were made with
            rows = rows.select(*[F.col(c).cast(types[c].dataType).alias(c) if c in types.names else F.col(c)
                                 for c in rows.columns])
        staged = scratch_path(self.spark, "bucket-rows")
        marked = rows.withColumn(BUCKET, _bucket(rows, keys, num_buckets))
        marked.write.parquet(staged)
        new = self.spark.read.schema(marked.schema).parquet(staged)
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())       # at most num_buckets
        if not touched:
            return []
        if any(b in now for b in touched):
            old = self._read([now[b]["folder"] for b in touched if b in now], types)
            new = new.unionByName(old.withColumn(BUCKET, _bucket(old, keys, num_buckets)), allowMissingColumns=True)
        # one shuffle: rows of a bucket meet in one task, the groups by key lie inside
        out = keep_latest(new.repartition(len(touched), BUCKET), [BUCKET, *keys], order)
        attempt = f"{self.root}/data/{uuid.uuid4().hex}"
        out.sortWithinPartitions(BUCKET, *keys).withColumnRenamed(BUCKET, "bucket") \
            .write.partitionBy("bucket").parquet(attempt)
        version = 1 + max((e["version"] for e in now.values()), default=0)
        columns = T.StructType([f for f in out.schema.fields if f.name != BUCKET]).json()
        self._commit([(version, b, f"{attempt}/bucket={b}", num_buckets, ",".join(keys), columns) for b in touched])
        return touched

    def _commit(self, entries: List[tuple]) -> None:
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    # -- reading ----------------------------------------------------------
    @staticmethod
    def _schema(now: Dict[int, dict]) -> Optional[T.StructType]:
        if not now:
            return None
        import json
        latest = max(now.values(), key=lambda e: e["version"])
        return T.StructType.fromJson(json.loads(latest["columns"]))

    def _read(self, folders: List[str], schema: T.StructType) -> DataFrame:
        """Rows of some folders; columns a folder lacks are NULL."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        return self.spark.read.schema(nullable).parquet(*folders)

    def read(self, buckets: Optional[Sequence[int]] = None) -> DataFrame:
        """The current rows, of all buckets or of some."""
        now = self.manifest()
        if not now:
            raise ValueError(f"no snapshot at {self.root}")
        wanted = sorted(now) if buckets is None else [b for b in sorted(set(buckets)) if b in now]
        return self._read([now[b]["folder"] for b in wanted], self._schema(now))

    def lookup(self, entity_rows: DataFrame, features: Sequence[str], view_name: Optional[str] = None,
               full_feature_names: bool = False) -> DataFrame:
        """Every entity row with its features (NULL for unknown keys).

        The buckets of the entity rows are found first (at most
        ``num_buckets`` numbers come back); only their files are read."""
        now = self.manifest()
        if not now:
            raise ValueError(f"no snapshot at {self.root}")
        one, schema = next(iter(now.values())), self._schema(now)
        keys = one["keys"].split(",")
        found = entity_rows.select(_bucket(entity_rows, keys, one["num_buckets"], schema).alias(BUCKET)).distinct().collect()
        rows = self._read([now[r[0]]["folder"] for r in found if r[0] in now], schema)
        return get_online_features(rows, entity_rows, keys, features, view_name, full_feature_names)


def materialize_buckets(view: FeatureView, start_date, end_date, root: str, num_buckets: int,
                        spark: Optional[SparkSession] = None) -> BucketSnapshot:
    """Merge the view's latest rows in ``[start, end)`` into the bucketed snapshot at ``root``."""
    spark = spark or SparkSession.getActiveSession()
    new = view_latest(view, start_date, end_date, spark=spark)
    src = view.source
    order = ([src.created_timestamp_column] if src.created_timestamp_column else []) + [src.timestamp_field]
    snapshot = BucketSnapshot(spark, root)
    snapshot.merge(new, list(view.entities) or [DUMMY_ENTITY_ID], order, num_buckets)
    return snapshot
