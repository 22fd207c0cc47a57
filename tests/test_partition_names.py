"""Partitions named in several ways lose no rows under a declared grain."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat import FeatureView, ParquetSource, get_historical_features
from chronofeat.plans.snapshot import pull_latest_from_table_or_query
from chronofeat.sources.readers import prune_partitions, read_source

D = datetime(2024, 1, 20)
OLD = D - timedelta(days=400)
US = 1_000_000


def source(spark, path, fmt, grain, integer):
    rows = spark.createDataFrame([(1, D, 7.0), (1, OLD, 1.0)], "k long, ts timestamp_ntz, f double")
    rows.withColumn("part", F.date_format("ts", fmt)).write.partitionBy("part").parquet(path)
    src = ParquetSource(path=path, timestamp_field="ts", date_partition_column="part", date_partition_grain=grain)
    assert (read_source(spark, src).schema["part"].dataType.typeName() == "integer") == integer
    return src


@pytest.mark.parametrize("fmt, grain, integer, left", [
    ("yyyyMM", "month", True, 1), ("yyyyMMdd", "day", True, 1), ("yyyyMMdd", "month", True, 1), ("yyyyMMdd", "year", True, 1),
    ("yyyyMM", "year", True, 1), ("yyyy", "year", True, 1), ("yyyy-MM", "month", False, 1), ("yyyy-MM-dd", "day", False, 1),
    # coarser than the grain, or no form that is known: nothing is skipped
    ("yyyy", "month", True, 2), ("yyyy", "day", True, 2), ("yyyyMM", "day", True, 2), ("yyyy-MM", "day", False, 2),
    ("MMyyyy", "month", True, 2), ("ddMMyyyy", "day", True, 2), ("yyyy_MM", "month", False, 2), ("'m'MM", "month", False, 2)])
def test_partition_names(spark, tmp_path_str, fmt, grain, integer, left):
    src = source(spark, tmp_path_str + "/p", fmt, grain, integer)
    lo, hi = (int((D + timedelta(days=d) - datetime(1970, 1, 1)).total_seconds()) * US for d in (-2, 2))
    got = prune_partitions(read_source(spark, src), src, lo, hi)
    assert got.where("f = 7.0").count() == 1 and got.count() == left
    v = FeatureView(name="v", entities=["k"], ttl=timedelta(days=2), schema=["f"], source=src)
    sp = spark.createDataFrame([(1, D + timedelta(days=1))], "k long, event_timestamp timestamp_ntz")
    assert [r["f"] for r in get_historical_features(sp, [v], ["v:f"]).collect()] == [7.0]
    out = pull_latest_from_table_or_query(src, ["k"], ["f"], "ts", None, datetime(2024, 1, 15), datetime(2024, 1, 31), spark=spark)
    assert [r["f"] for r in out.collect()] == [7.0]
