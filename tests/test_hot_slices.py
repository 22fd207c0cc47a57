"""Statistics of an as-of pass, quantile slices and the key filter."""

import random
import warnings
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat import DataFrameSource, FeatureView, ParquetSource, get_historical_features
from chronofeat.operators import asof_stats
from chronofeat.operators.asof_stats import T_COL, pass_stats, with_slice
from chronofeat.operators.keyfilter import MAX_KEYS, KeyFilter, can_filter
from helpers import brute_asof, plan_text, rows, us

BASE = datetime(2024, 1, 1)
HOUR = 3_600_000_000


def sources(spark, data):
    return spark.createDataFrame([(k, us(t)) for k, t in data], f"id long, {T_COL} long")


def spine_of(spark, data):
    return spark.createDataFrame(data, "id long, event_timestamp timestamp_ntz")


def slice_sizes(spark, st, src):
    cut = with_slice(src, ["id"], F.col(T_COL), HOUR, st.slices.frame(spark), st.slices.factor, "b")
    return [r["count"] for r in cut.groupBy("id", "b").count().collect()]


def test_burst_inside_a_millisecond_is_split(spark):
    src = sources(spark, [(1, BASE + timedelta(microseconds=i)) for i in range(1000)]
                  + [(k, BASE + timedelta(seconds=k)) for k in range(2, 60)])
    st = pass_stats(spine_of(spark, [(1, BASE + timedelta(minutes=1))]), "event_timestamp", ["id"], [(src, HOUR)], HOUR, 100)
    assert len(st.slices.cuts) == 1 and max(slice_sizes(spark, st, src)) <= 100
    assert list(st.counts.values()) == [1001] and not st.source_copies[0] and not st.spine_copies


def test_statistics_are_bounded(spark, monkeypatch):
    """With every group above the budget, no more groups come back than HOT_GROUPS."""
    monkeypatch.setattr(asof_stats, "HOT_GROUPS", 16)
    src = sources(spark, [(k, BASE + timedelta(seconds=i)) for k in range(300) for i in range(10)])
    st = pass_stats(spine_of(spark, [(1, BASE)]), "event_timestamp", ["id"], [(src, HOUR)], HOUR, 1)
    assert len(st.counts) <= 16 and st.rows == 3002
    assert abs(st.source_keys[0] - 300) < 30 and st.spine_keys == 1


def test_empty_inputs(spark):
    st = pass_stats(spine_of(spark, []), "event_timestamp", ["id"], [(sources(spark, []), HOUR)], HOUR, 1)
    assert (st.rows, st.slices.cuts, st.slices.factor, st.spine_keys) == (0, {}, 1, 0)


def test_copies_share_a_slice_and_are_told(spark):
    src = sources(spark, [(1, BASE)] * 200 + [(1, BASE + timedelta(seconds=i)) for i in range(50)])
    st = pass_stats(spine_of(spark, [(1, BASE + timedelta(seconds=9))]), "event_timestamp", ["id"], [(src, HOUR)], HOUR, 20)
    assert st.source_copies == [True] and not st.spine_copies
    assert max(slice_sizes(spark, st, src)) < 230


@pytest.mark.parametrize("seed", [1, 2])
def test_uneven_slices_equal_brute_force(spark, seed):
    """Bursts, copies and quiet stretches, two TTLs, explicit widths; any budget gives the same rows."""
    rng = random.Random(seed)

    def t():
        return BASE + rng.choice([timedelta(microseconds=rng.randrange(300)), timedelta(minutes=rng.randrange(300)),
                                  timedelta(hours=2, microseconds=rng.randrange(40))])
    spine = [(rng.randrange(3), t()) for _ in range(60)]
    src = [(rng.randrange(3), t(), None, float(rng.randrange(5))) for _ in range(250)]
    sp = spine_of(spark, spine)
    df = spark.createDataFrame([(k, x, f) for k, x, _, f in src], "id long, ts timestamp_ntz, f double")
    for ttl, options in ((timedelta(hours=1), {}), (timedelta(microseconds=60), {}),
                         (timedelta(hours=3), {"bucket_width": timedelta(minutes=40)})):
        want = brute_asof([(k, us(x)) for k, x in spine], [(k, us(x), c, f) for k, x, c, f in src],
                          ttl // timedelta(microseconds=1), False)
        v = FeatureView(name="v", entities=["id"], ttl=ttl, schema=["f"], source=DataFrameSource(df=df, timestamp_field="ts"))
        for budget in (2, 25):
            got = {(r[0], us(r[1])): r[2] for r in get_historical_features(
                sp, [v], ["v:f"], max_bucket_rows=budget, **options).collect()}
            assert got == want, (ttl, budget)


def test_range_join_views_keep_their_hot_slices(spark):
    """A source with its own bucket width is cut like any other (plan: the hot table is joined)."""
    from chronofeat.operators.asof import AsofView, point_in_time_join_many
    src = sources(spark, [(1, BASE + timedelta(microseconds=i)) for i in range(200)]).withColumn("f", F.col(T_COL))
    sp = spine_of(spark, [(1, BASE + timedelta(seconds=1)), (1, BASE + timedelta(minutes=50))])
    st = pass_stats(sp, "event_timestamp", ["id"], [(src, HOUR)], HOUR // 10, 20)
    out = point_in_time_join_many(sp, "event_timestamp", ["id", "event_timestamp"], ["id"],
                                  [AsofView(src, ["f"], HOUR, False, HOUR // 10)], stats=st)
    assert "__cf_cuts" in plan_text(out)
    assert {r.f for r in out.collect()} == {us(BASE) + 199}


# -- key filter -------------------------------------------------------------

@pytest.fixture(scope="module")
def many_keys(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keys") / "src")
    spark.range(20_000).select((F.col("id") % 2000).alias("id"),
                               F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("ts"),
                               F.col("id").cast("double").alias("f")).write.parquet(path)
    return FeatureView(name="v", entities=["id"], ttl=timedelta(days=2), schema=["f"],
                       source=ParquetSource(path=path, timestamp_field="ts"))


def test_source_rows_of_other_keys_are_not_shuffled(spark, many_keys):
    sp = spine_of(spark, [(k, datetime(2024, 1, 2)) for k in range(0, 2000, 100)])     # 1 % of the keys
    kept = KeyFilter(sp, ["id"], 20).prune(spark.read.parquet(many_keys.source.path))
    assert 200 <= kept.count() <= 300      # 1 % of 20,000 rows, and few of other keys
    on = get_historical_features(sp, [many_keys], ["v:f"])
    text = plan_text(on)
    assert "getbit" in text and text.index("getbit") < text.index(") Exchange\nInput")   # details are in order of work
    off = get_historical_features(sp, [many_keys], ["v:f"], key_filter="off")
    assert "getbit" not in plan_text(off)
    assert rows(on) == rows(off) and on.count() == 20


def test_filter_only_where_it_pays(spark, many_keys):
    every = spine_of(spark, [(k, datetime(2024, 1, 2)) for k in range(2000)])
    assert "getbit" not in plan_text(get_historical_features(every, [many_keys], ["v:f"]))
    assert "getbit" in plan_text(get_historical_features(every, [many_keys], ["v:f"], key_filter="on"))
    with pytest.raises(ValueError):
        get_historical_features(every, [many_keys], ["v:f"], key_filter="sometimes")


@pytest.mark.parametrize("options", [dict(strategy="join"), dict(bucket_width=None), dict(keep_unmatched=True)])
@pytest.mark.parametrize("ttl", [None, timedelta(days=2)])
def test_filtered_results_are_the_same(spark, many_keys, options, ttl):
    from dataclasses import replace
    v = replace(many_keys, ttl=ttl)
    sp = spine_of(spark, [(5, datetime(2024, 1, 1, 3)), (5, datetime(2023, 1, 1)), (None, datetime(2024, 1, 2)),
                          (99999, datetime(2024, 1, 2)), (1999, datetime(2024, 1, 2))])
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        on = get_historical_features(sp, [v], ["v:f"], key_filter="on", **options)
        off = get_historical_features(sp, [v], ["v:f"], key_filter="off", **options)
        assert rows(on) == rows(off)


def test_size_and_types_are_checked(spark):
    sp = spark.createDataFrame([(1.0, "a")], "x double, s string")
    assert not can_filter(sp, ["x"]) and can_filter(sp, ["s"]) and not can_filter(sp, [])
    with pytest.raises(ValueError):
        KeyFilter(sp, ["s"], MAX_KEYS + 1)
    many = sp.select(F.lit("k").alias("s"))
    assert KeyFilter(many, ["s"], 0).prune(spark.createDataFrame([("k",), ("l",), (None,)], "s string")).count() == 1


def test_a_filter_keeps_all_of_its_keys(spark):
    keys = spark.range(5000).select((F.col("id") * 7919).alias("id"), F.concat(F.lit("u"), "id").alias("s"))
    for cols in (["id"], ["s"], ["id", "s"]):
        f = KeyFilter(keys, cols, 5000)
        assert f.prune(keys).count() == 5000
        assert f.prune(keys.select((F.col("id") + 1).alias("id"), F.concat("s", F.lit("x")).alias("s"))).count() < 200
