"""Frame operators: rename, dedup, latest row, filters, sort position."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat.operators import frame as ops
from helpers import plan_text, rows

T0 = datetime(2024, 1, 1)


def test_rename_swap_is_simultaneous(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a long, b long, c long")
    out = ops.rename_columns(df, {"a": "b", "b": "a", "zz": "q"})
    assert out.columns == ["b", "a", "c"]
    assert rows(out, "c") == [(1, 2, 3)]


def test_select_drop_static_columns_list(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a long, b string, c double")
    assert ops.select_columns(df, ["c", "a"]).columns == ["c", "a"]
    assert ops.drop_columns(df, ["b"]).columns == ["a", "c"]
    assert rows(ops.add_static_column(df, "k", "v")) == [(1, "x", 2.0, "v")]
    assert ops.columns_list(df) == ["a", "b", "c"]


def test_select_dtypes_and_detection(spark):
    df = spark.createDataFrame([(1, T0, T0)], "a long, t timestamp, u timestamp_ntz")
    assert ops.select_dtypes_columns(df, ["datetime"]) == ["t", "u"]
    assert ops.select_dtypes_columns(df, ["datetimetz"]) == ["t"]
    with pytest.raises(ValueError):
        ops.detect_event_timestamp_column(df)
    assert ops.detect_event_timestamp_column(df.drop("u")) == "t"


def test_filter_ttl_inclusive_and_no_ttl(spark):
    e = datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, e, e - timedelta(days=1)), (2, e, e - timedelta(days=1, microseconds=1)),
                                (3, e, e), (4, e, e + timedelta(microseconds=1)), (5, e, None)],
                               "id long, et timestamp_ntz, ts timestamp_ntz")
    assert [r[0] for r in rows(ops.filter_ttl(df, "et", "ts", timedelta(days=1)))] == [1, 3]
    assert ops.filter_ttl(df, "et", "ts", None).count() == 5
    assert ops.filter_ttl(df, "et", "ts", 0).count() == 5
    assert [r[0] for r in rows(ops.filter_ttl(df, "et", "ts", 86400.0))] == [1, 3]


def test_filter_time_range_half_open_pushed_down(spark, tmp_path_str):
    end = datetime(2024, 1, 10)
    df = spark.createDataFrame([(1, datetime(2024, 1, 5)), (2, end - timedelta(microseconds=1)), (3, end)],
                               "id long, ts timestamp_ntz")
    df.write.parquet(tmp_path_str + "/t")
    r = spark.read.parquet(tmp_path_str + "/t")
    out = ops.filter_time_range(r, "ts", datetime(2024, 1, 5), end)
    assert [x[0] for x in rows(out)] == [1, 2]
    plan = plan_text(out)
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_latest_per_key_created_then_ts_null_lowest(spark):
    df = spark.createDataFrame([
        (1, T0, T0 + timedelta(days=5), 1.0), (1, T0 + timedelta(days=1), T0, 2.0),
        (2, T0, None, 3.0), (2, T0 - timedelta(days=1), T0, 4.0), (3, None, None, 5.0)],
        "k long, ts timestamp_ntz, created timestamp_ntz, f double")
    out = ops.drop_df_duplicates(df, ["k"], "ts", "created")
    assert [(r[0], r[3]) for r in rows(out)] == [(1, 1.0), (2, 4.0), (3, 5.0)]
    out = ops.drop_df_duplicates(df, ["k"], "ts")
    assert [(r[0], r[3]) for r in rows(out)] == [(1, 2.0), (2, 3.0), (3, 5.0)]


def test_keep_latest_with_map_column_falls_back_to_max_by(spark):
    df = spark.createDataFrame([(1, T0, {"a": 1}), (1, T0 + timedelta(1), {"b": 2})],
                               "k long, ts timestamp_ntz, m map<string,int>")
    out = ops.drop_df_duplicates(df, ["k"], "ts").collect()
    assert out[0]["m"] == {"b": 2}


def test_drop_duplicates_keep_last(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 3), (1, "b", 2)], "u long, t string, id long")
    out = ops.drop_duplicates_keep_last(df, ["u", "t"], ["id"])
    assert rows(out) == [(1, "a", 3), (1, "b", 2)]


def test_sort_values_and_global_position(spark):
    data = [(i, None if i % 17 == 0 else float((i * 37) % 11)) for i in range(500)]
    df = spark.createDataFrame(data, "id long, v double").repartition(7)
    order = ops.sort_columns(["v", "id"], [True, True], na_position="first")
    out = ops.with_sort_position(df, order, "pos", num_partitions=5)
    got = sorted((r["pos"], r["id"]) for r in out.collect())
    exp = sorted(data, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[0]))
    assert got == [(i + 1, r[0]) for i, r in enumerate(exp)]
    s = ops.sort_values(df, ["v", "id"], ascending=[False, True], na_position="last").collect()
    assert s[0]["v"] == 10.0 and s[-1]["v"] is None


def test_event_time_range(spark):
    df = spark.createDataFrame([(T0,), (T0 + timedelta(days=2),), (None,)], "ts timestamp_ntz")
    r = ops.event_timestamp_range(df, "ts").collect()[0]
    assert (r["min_ts"], r["max_ts"]) == (T0, T0 + timedelta(days=2))


def test_join_left_and_clash(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
    b = spark.createDataFrame([(1, 5.0), (1, 6.0)], "k long, b double")
    assert rows(ops.join_left(a, b, ["k"])) == [(1, "x", 5.0), (1, "x", 6.0), (2, "y", None)]
    with pytest.raises(ValueError, match="both sides"):
        ops.join_left(a, b.withColumn("a", F.lit(1)), ["k"])


def test_join_left_salts_hot_right_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (None, "n")], "k long, a string")
    b = spark.createDataFrame([(1, float(i)) for i in range(50)] + [(2, 7.0), (None, 1.0)], "k long, b double")
    plain = sorted(map(tuple, ops.join_left(a, b, ["k"]).collect()), key=str)
    salted = ops.join_left(a, b, ["k"], max_rows_per_key=8)
    assert salted.columns == ["k", "a", "b"]
    assert sorted(map(tuple, salted.collect()), key=str) == plain
    assert len(plain) == 50 + 1 + 1 + 1


def test_join_left_salting_spreads_exact_copies(spark):
    a = spark.createDataFrame([(1, "x")], "k long, a string")
    b = spark.createDataFrame([(1, 5.0)] * 40, "k long, b double").repartition(3)
    out = ops.join_left(a, b, ["k"], max_rows_per_key=10)
    assert out.count() == 40 and out.where("b = 5.0").count() == 40


def test_filter_time_range_on_iso_strings(spark):
    df = spark.createDataFrame([(1, "2024-01-05T10:00:00"), (2, "2024-01-04T23:59:59"), (3, "2024-01-10T00:00:00")],
                               "id long, ts string")
    out = ops.filter_time_range(df, "ts", datetime(2024, 1, 5), datetime(2024, 1, 10))
    assert [r[0] for r in rows(out)] == [1]


def test_join_left_salting_empty_salt_adds_no_rows(spark):
    """All right rows of a hot key can land in one salt (one row per task):
    the other replicas of its left row must not become unmatched rows."""
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
    # five rows, one per task: every row id is even, so with 2 salts all go to salt 0
    b = spark.createDataFrame(spark.sparkContext.parallelize([(1, float(i)) for i in range(5)], 5),
                              "k long, b double")
    out = ops.join_left(a, b, ["k"], max_rows_per_key=4)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([(1, "x", float(i)) for i in range(5)] + [(2, "y", None)], key=str)


def test_sort_position_with_payload_is_exact(spark):
    """A million rows with a payload column: positions are exactly 1..N."""
    from pyspark.sql import functions as F

    n = 1_000_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"), F.concat(F.lit("payload-"), F.col("id").cast("string")).alias("s"))
    out = ops.with_sort_position(df, [F.col("k")], "pos", num_partitions=8)
    got = out.agg(F.countDistinct("pos"), F.min("pos"), F.max("pos")).first()
    assert tuple(got) == (n, 1, n)
