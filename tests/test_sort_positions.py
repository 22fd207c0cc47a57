"""Global positions without storing the rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chronofeat.operators import frame as ops
from helpers import plan_text


def expected(data, asc, first):
    """Positions by Python's sort, one column after the other from the last (a stable sort)."""
    rows = list(range(len(data)))
    for i in reversed(range(len(asc))):
        def key(r, i=i):
            v = data[r][i]
            return (1, 0) if isinstance(v, float) and math.isnan(v) else (0, v)
        nulls = [r for r in rows if data[r][i] is None]
        rest = sorted((r for r in rows if data[r][i] is not None), key=key, reverse=not asc[i])
        rows = nulls + rest if first else rest + nulls
    return {r: n for n, r in enumerate(rows, start=1)}


@pytest.mark.parametrize("aqe", ["true", "false"])
@pytest.mark.parametrize("asc, na", [([True, True, True], "last"), ([False, True, False], "first"), ([False, False, True], "last")])
@pytest.mark.parametrize("parts", [1, 3, 8])
def test_positions_equal_a_plain_sort(spark, aqe, asc, na, parts):
    rng = random.Random(parts)
    data = [(rng.choice([None, float("nan"), 0.5, -1.0, 2.5, 7.0]), rng.choice([None, "a", "é", "zz", ""]), n) for n in range(300)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        df = spark.createDataFrame(data, "a double, b string, c long").repartition(5)
        got = {r.c: r.pos for r in ops.sort_positions(df, ["a", "b", "c"], asc, na, num_partitions=parts, sampled=3).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert got == expected(data, asc, na == "first")


def test_ties_hot_values_and_empty_tables(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("v"), "id")
    rows = ops.sort_positions(df, "v", num_partitions=6).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 2001)) and [r.v for r in rows] == sorted(r.v for r in rows)
    assert ops.sort_positions(df.where("id < 0"), "v").collect() == []
    assert [r.pos for r in ops.sort_positions(df.where("id = 5"), ["v"], False).collect()] == [1]


def test_payload_is_not_written(spark, tmp_path, monkeypatch):
    """What is written are the cuts: the same for a payload of one byte and of a thousand a row."""
    sizes = []
    for width in (1, 1000):
        folder = tmp_path / str(width)
        monkeypatch.setattr(ops, "scratch_path", lambda spark, name: f"{folder}/{name}")
        df = spark.range(5000).select(F.xxhash64("id").alias("v"), F.repeat(F.lit("x"), width).alias("p"))
        out = ops.sort_positions(df, "v", num_partitions=4)
        assert out.agg(F.countDistinct("pos")).first()[0] == 5000
        sizes.append(sum(f.stat().st_size for f in folder.rglob("*.parquet")))
        assert [f.name for f in folder.iterdir()] == ["sort-cuts"]
    assert sizes[0] < 5000 and abs(sizes[0] - sizes[1]) < 200


def test_ranges_are_balanced(spark):
    df = spark.range(40_000).select(F.xxhash64("id").alias("v"))
    out = ops.sort_positions(df, "v", num_partitions=8, sampled=64)
    assert "Exchange" in plan_text(out)
    n = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(n) < 3 * 40_000 / 8


def test_planning_does_not_grow_with_the_search_steps(spark):
    """The planner follows a joined column down through projections, and writes out what each step names:
    with 8 steps that filled the driver.  A generator between the join and the steps ends that."""
    df = spark.range(3000).select((F.xxhash64("id") % 50).alias("v"), "id")
    out = ops.sort_positions(df, ["v", "id"], num_partitions=40)
    tree = out._jdf.queryExecution().analyzed().toString().split("\n")
    join, fence = (next(i for i, x in enumerate(tree) if word in x) for word in ("Join Inner", "Generate explode"))
    step = next(i for i, x in enumerate(tree) if "Project" in x and "get(scalar-subquery" in x)
    assert join < fence < step
    # 10 steps: planned and run
    rows = ops.sort_positions(df, ["v", "id"], num_partitions=1000).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, 3001))
    assert [(r.v, r.id) for r in rows] == sorted((r.v, r.id) for r in rows)
