"""Readers for every source type, plus the source-table writers.

``read_source`` returns a lazy DataFrame.  Callers narrow it with ``select``
and ``where``; Catalyst then prunes columns (``ReadSchema``) and pushes
literal time bounds into the Parquet scan (``PushedFilters``) and partition
pruning.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta
from typing import Iterable, Optional
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import MICROS_PER_DAY, bucket_of, epoch_micros
from ..model import (
    BucketedTableSource,
    CsvSource,
    DataFrameSource,
    DataSource,
    DeltaSource,
    FileSource,
    IcebergSource,
    ParquetSource,
)


def normalize_path(path: str) -> str:
    """``s3://bucket/x`` -> ``s3a://bucket/x`` (scheme prefix only)."""
    if path.startswith("s3://"):
        return "s3a://" + path[len("s3://"):]
    return path


def apply_endpoint_override(spark: SparkSession, source: FileSource) -> Optional[str]:
    """Route reads of this source's bucket to a custom S3 endpoint.

    Uses the per-bucket S3A setting, so other buckets keep their endpoint.
    Session settings are copied into the Hadoop configuration of every
    file scan.  Returns the configuration key that was set."""
    ep = getattr(source, "s3_endpoint_override", None)
    if not ep:
        return None
    path = normalize_path(source.path)
    u = urlparse(path)
    if u.scheme not in ("s3a", "s3n") or not u.netloc:
        return None
    key = f"fs.s3a.bucket.{u.netloc}.endpoint"
    spark.conf.set(key, ep)
    return key


#: Spark's CSV modes for ``bad_rows``.
_CSV_MODES = {"fail": "FAILFAST", "null": "PERMISSIVE", "drop": "PERMISSIVE"}
_BAD = "__cf_bad_row"


def _whole_row(df: DataFrame) -> Column:
    """Always true, and takes in every column: Spark judges a row by the
    columns that a query needs, so without it a fault in another one would
    not count."""
    return F.hash(*[F.col(c) for c in df.columns if c != _BAD]) >= F.lit(-(1 << 31))


def _csv_options(s: CsvSource) -> dict:
    out = {"sep": s.delimiter, "header": str(bool(s.header)).lower(), "escape": s.escape}
    if s.timestamp_format:
        out |= {"timestampNTZFormat": s.timestamp_format, "timestampFormat": s.timestamp_format}
    return out


def _csv(reader, s: CsvSource) -> DataFrame:
    r = reader.options(**_csv_options(s))
    if s.schema:
        r = r.option("mode", _CSV_MODES[s.bad_rows])
        r = r.schema(f"{s.schema}, {_BAD} string").option("columnNameOfCorruptRecord", _BAD) \
            if s.bad_rows == "drop" else r.schema(s.schema)
    elif s.infer_schema:
        r = r.option("inferSchema", "true")
    df = r.csv(normalize_path(s.path))
    if s.schema and s.bad_rows == "drop":
        df = df.where(_whole_row(df) & F.col(_BAD).isNull()).drop(_BAD)
    # time columns must be typed even when the rest stays as strings
    for c in (s.timestamp_field, s.created_timestamp_column):
        if c and c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            if s.bad_rows == "fail":
                parsed = F.to_timestamp_ntz(F.col(c), *_format(s))
            else:
                parsed = _parsed_time(s, F.col(c))
                if s.bad_rows == "drop":
                    df = df.where(F.col(c).isNull() | parsed.isNotNull())
            df = df.withColumn(c, parsed)
    return df


def _format(s: CsvSource) -> tuple:
    return (F.lit(s.timestamp_format),) if s.timestamp_format else ()


def _parsed_time(s: CsvSource, c: Column) -> Column:
    """The naive time of a text, NULL where it is none."""
    if s.timestamp_format:
        return F.from_csv(c, "t timestamp_ntz", {"timestampNTZFormat": s.timestamp_format, "sep": "\u0001"})["t"]
    return c.try_cast("timestamp_ntz")


def read_csv_with_rejects(spark: SparkSession, source: CsvSource) -> tuple:
    """``(good rows, rejected rows)`` of a CSV source with a ``schema``.

    A rejected row has its ``file``, the ``row`` as it stands there and the
    ``reason``: the columns whose text is not of their type, or the number of
    fields.  Both frames are lazy and together hold every row once."""
    if not source.schema:
        raise ValueError("rows can only be rejected against a schema")
    apply_endpoint_override(spark, source)
    options = _csv_options(source)
    raw = spark.read.options(**options).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD) \
        .schema(f"{source.schema}, {_BAD} string").csv(normalize_path(source.path))
    columns = [f for f in raw.schema.fields if f.name != _BAD]
    # the texts of a row's fields, one more than there should be
    texts = F.from_csv(F.col(_BAD), ", ".join(f"c{i} string" for i in range(len(columns) + 1)),
                       {k: v for k, v in options.items() if k in ("sep", "escape")})
    bad = raw.where(_whole_row(raw) & F.col(_BAD).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.col(_BAD).alias("row"),
                                                   *[F.col(f.name).alias(f"v{i}") for i, f in enumerate(columns)],
                                                   texts.alias("c"))
    wrong = F.array_compact(F.array(*[
        F.when(F.col("c")[f"c{i}"].isNotNull() & F.col(f"v{i}").isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
        for i, f in enumerate(columns)]))
    fields = F.when(F.col("c")[f"c{len(columns)}"].isNotNull(), F.lit("too many fields")) \
        .when(F.size(wrong) == 0, F.lit("too few fields"))
    reason = F.coalesce(fields, F.array_join(wrong, ", "))
    return _csv(spark.read, replace(source, bad_rows="drop")), bad.select("file", "row", reason.alias("reason"))


def read_source(spark: SparkSession, source: DataSource) -> DataFrame:
    """Lazy DataFrame over a source (dispatch on the source type)."""
    if isinstance(source, DataFrameSource):
        return source.df
    if isinstance(source, BucketedTableSource):
        return spark.table(source.table)
    if not isinstance(source, FileSource):
        raise TypeError(f"unsupported source type {type(source).__name__}")
    apply_endpoint_override(spark, source)
    path = normalize_path(source.path)
    if isinstance(source, CsvSource):
        return _csv(spark.read, source)
    if isinstance(source, ParquetSource):
        return spark.read.parquet(path)
    if isinstance(source, DeltaSource):
        return spark.read.format("delta").load(path)
    if isinstance(source, IcebergSource):
        # a catalog name reads through the catalog; a location through the format
        if "/" in source.path or ":" in source.path:
            return spark.read.format("iceberg").load(source.path)
        return spark.table(source.path)
    return spark.read.parquet(path)


def stream_source(spark: SparkSession, source: FileSource) -> DataFrame:
    """Streaming read of a folder of Parquet or CSV files, typed as the
    batch read of what lies there now."""
    apply_endpoint_override(spark, source)
    path = normalize_path(source.path)
    if isinstance(source, CsvSource):
        raw = source.schema or spark.read.option("sep", source.delimiter).option(
            "header", str(bool(source.header)).lower()).option(
            "inferSchema", str(bool(source.infer_schema)).lower()).csv(path).schema
        return _csv(spark.readStream.schema(raw), replace(source, schema=None, infer_schema=False))
    if isinstance(source, ParquetSource) or type(source) is FileSource:
        return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    raise TypeError(f"incremental materialization cannot stream a {type(source).__name__}")


#: Values taken as the period of a grain, finer ones included.  Without dashes only years from 1900 to 2199
#: count, so MMyyyy and ddMMyyyy are never read as years.
_PERIODS = {"day": r"\d{4}-\d\d-\d\d|(?:19|20|21)\d{6}"}
_PERIODS["month"] = _PERIODS["day"] + r"|\d{4}-\d\d|(?:19|20|21)\d{4}"
_PERIODS["year"] = _PERIODS["month"] + r"|\d{4}"


def prune_partitions(df: DataFrame, source: DataSource, lo_us: int, hi_us: int) -> DataFrame:
    """Skip partitions that hold no row timed in ``[lo_us, hi_us]``.

    Acts only under a declared ``date_partition_grain``.  Both bounds are
    widened by a day (partitions may be named in any time zone) and cut to
    the grain.  A value is read as yyyy-MM-dd or yyyyMMdd, for the grain month
    also as yyyy-MM or yyyyMM, for year also as yyyy; numbers count as their
    digits.  Partitions with any other value, or with no such date, stay."""
    part, grain = source.date_partition_column, source.date_partition_grain
    if not grain or part not in df.columns:
        return df
    first, last = (date.min - date(1970, 1, 1)).days, (date.max - date(1970, 1, 1)).days

    def period_of(us: int):
        day = date(1970, 1, 1) + timedelta(days=min(max(us // MICROS_PER_DAY, first), last))
        if grain != "day":
            day = day.replace(day=1)
        return F.lit(day.replace(month=1) if grain == "year" else day)

    name = F.col(part).cast("string")
    digits = F.when(name.rlike(rf"\A(?:{_PERIODS[grain]})\z"), F.rpad(F.translate(name, "-", ""), 8, "0101"))
    period = F.regexp_replace(digits, r"(\d{4})(\d\d)(\d\d)", "$1-$2-$3").try_cast("date")
    if grain != "day":
        period = F.trunc(period, grain)
    inside = (period >= period_of(lo_us - MICROS_PER_DAY)) & (period <= period_of(hi_us + MICROS_PER_DAY))
    return df.where(period.isNull() | inside)


def check_columns(df: DataFrame, required: Iterable[str], source: DataSource) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        where = getattr(source, "path", None) or source.name or type(source).__name__
        raise ValueError(
            f"source {where!r} lacks join key / time columns {sorted(set(required))}; "
            f"missing {missing}; it has {df.columns}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                partition_by: Optional[Iterable[str]] = None, **options) -> None:
    """Write a source table (Parquet, CSV, Delta, Iceberg-by-location)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        # Spark's CSV default keeps milliseconds only; keep every microsecond
        options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", **options}
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in options.items():
        w = w.option(k, v)
    w.format(fmt).save(normalize_path(path))


def append_partitioned_by_day(df: DataFrame, path: str, ts_col: str, day_col: str = "day",
                              fmt: str = "parquet") -> None:
    """Append ``df`` partitioned by the UTC day of ``ts_col``.

    No shuffle: rows are only sorted by day inside each task, so a task
    writes one file per day it holds and a hot day is still spread over
    all tasks that hold it."""
    dt = df.schema[ts_col].dataType
    day = F.date_from_unix_date(bucket_of(epoch_micros(ts_col, dt), MICROS_PER_DAY).cast("int"))
    out = df.withColumn(day_col, day).sortWithinPartitions(day_col)
    write_table(out, path, fmt=fmt, mode="append", partition_by=[day_col])


def append_to_catalog_table(df: DataFrame, table: str, partitioned_by: Optional[Iterable[str]] = None,
                            using: Optional[str] = None) -> None:
    """Create-or-append a catalog table (a Parquet table in the session
    catalog, or an Iceberg table in an Iceberg catalog): ``saveAsTable`` in
    append mode creates the table (optionally partitioned) when missing."""
    w = df.write.mode("append")
    if using:
        w = w.format(using)
    if partitioned_by:
        w = w.partitionBy(*partitioned_by)
    w.saveAsTable(table)


def write_bucketed(df: DataFrame, table: str, keys: Iterable[str], ts_col: str, num_buckets: int,
                   path: Optional[str] = None) -> None:
    """Write a source as a catalog table bucketed by ``keys``, one file a
    bucket, sorted by keys and time.  One shuffle here saves one of the source
    in every later as-of join on these keys.  Choose ``num_buckets`` so that a
    bucket fits a task: it is what one task reads.  ``path`` places the files
    (default: the warehouse); an existing table is an error."""
    keys = list(keys)
    w = df.repartition(num_buckets, *keys).sortWithinPartitions(*keys, ts_col).write.mode("errorifexists").format("parquet")
    if path:
        w = w.option("path", normalize_path(path))
    w.bucketBy(num_buckets, *keys).sortBy(*keys, ts_col).saveAsTable(table)


def bucket_spec(spark: SparkSession, table: str) -> tuple:
    """``(number of buckets, [bucket columns])`` of a catalog table; ``(0, [])`` without buckets."""
    told = {r["col_name"].strip(): r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if "Num Buckets" not in told:
        return 0, []
    return int(told["Num Buckets"]), [c.strip(" `") for c in told["Bucket Columns"].strip("[]").split(",")]
