"""Point-in-time join: TTL edges, ranking, ties, nulls, keys, strategies."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofeat import DataFrameSource, FeatureView, get_historical_features
from helpers import plan_text, brute_asof, rows, us

T0 = datetime(2021, 10, 1, 23, 59, 42)
STRATS = [dict(strategy="bucketed"), dict(strategy="join"),
          dict(strategy="bucketed", bucket_width=timedelta(minutes=7))]


def view(df, ttl=timedelta(days=1), created=None, entities=("id",), feats=("f",), name="v"):
    return FeatureView(name=name, entities=list(entities), ttl=ttl, schema=list(feats),
                       source=DataFrameSource(df=df, timestamp_field="ts", created_timestamp_column=created))


def spine_at(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, event_timestamp timestamp_ntz")


@pytest.mark.parametrize("kw", STRATS)
def test_ttl_both_ends_inclusive(spark, kw):
    ttl = timedelta(hours=1)
    sp = spine_at(spark, (1, T0), (2, T0), (3, T0), (4, T0))
    us1 = timedelta(microseconds=1)
    src = spark.createDataFrame([
        (1, T0 - ttl - us1, 1.0),      # just outside
        (2, T0 - ttl, 2.0),            # lower edge: in
        (3, T0, 3.0),                  # upper edge: in
        (4, T0 + us1, 4.0),            # future: out
    ], "id long, ts timestamp_ntz, f double")
    out = get_historical_features(sp, [view(src, ttl)], ["v:f"], **kw)
    assert rows(out) == [(2, T0, 2.0), (3, T0, 3.0)]


@pytest.mark.parametrize("kw", STRATS)
def test_latest_wins_generator_scenario(spark, kw):
    """Ten entities; entity 1 also has copies back-dated by 1 day / 1 hour /
    1 minute / 1 second with f0 + 1..4: the un-shifted row wins."""
    spine_t = datetime(2021, 10, 1, 23, 59, 42)
    row_t = datetime(2021, 10, 1, 23, 59, 41)
    ids = list(range(10))
    random.Random(0).shuffle(ids)
    data = [(i, row_t, float(i) / 10) for i in ids]
    for n, off in enumerate([timedelta(days=1), timedelta(hours=1), timedelta(minutes=1),
                             timedelta(seconds=1)], start=1):
        data.append((1, row_t - off, 0.1 + n))
    src = spark.createDataFrame(data, "id long, ts timestamp_ntz, f double")
    sp = spark.createDataFrame([(i, spine_t) for i in ids], "id long, event_timestamp timestamp_ntz")
    out = get_historical_features(sp, [view(src, timedelta(days=20))], ["v:f"], **kw)
    got = dict((r[0], r[2]) for r in rows(out))
    assert got[1] == pytest.approx(0.1)
    assert len(got) == 10


@pytest.mark.parametrize("kw", STRATS)
def test_created_outranks_ts_and_null_created_lowest(spark, kw):
    sp = spine_at(spark, (1, T0), (2, T0))
    src = spark.createDataFrame([
        (1, T0 - timedelta(minutes=30), T0 + timedelta(days=3), 1.0),   # older ts, newer created
        (1, T0 - timedelta(minutes=1), T0, 2.0),
        (2, T0 - timedelta(minutes=30), T0, 3.0),
        (2, T0 - timedelta(minutes=1), None, 4.0),                      # null created: lowest
    ], "id long, ts timestamp_ntz, created timestamp_ntz, f double")
    out = get_historical_features(sp, [view(src, created="created")], ["v:f"], **kw)
    assert rows(out) == [(1, T0, 1.0), (2, T0, 3.0)]


@pytest.mark.parametrize("kw", STRATS)
def test_ties_broken_by_features(spark, kw):
    sp = spine_at(spark, (1, T0))
    t = T0 - timedelta(minutes=5)
    src = spark.createDataFrame([(1, t, 1.0, "a"), (1, t, 5.0, "b"), (1, t, None, "z")],
                                "id long, ts timestamp_ntz, f double, g string")
    out = get_historical_features(sp, [view(src, feats=("f", "g"))], ["v:f", "v:g"], **kw)
    assert rows(out) == [(1, T0, 5.0, "b")]


@pytest.mark.parametrize("kw", STRATS)
def test_unmatched_and_null_keys(spark, kw):
    sp = spark.createDataFrame([(1, T0), (99, T0), (None, T0)], "id long, event_timestamp timestamp_ntz")
    src = spark.createDataFrame([(1, T0, 1.0), (None, T0, 7.0)], "id long, ts timestamp_ntz, f double")
    v = view(src)
    assert rows(get_historical_features(sp, [v], ["v:f"], **kw)) == [(1, T0, 1.0)]
    kept = get_historical_features(sp, [v], ["v:f"], keep_unmatched=True, **kw)
    assert sorted(rows(kept), key=str) == sorted([(1, T0, 1.0), (99, T0, None), (None, T0, None)], key=str)


def test_no_ttl_future_rows_win_and_unmatched_kept(spark):
    sp = spine_at(spark, (1, T0), (2, T0))
    src = spark.createDataFrame([(1, T0 - timedelta(days=400), 1.0), (1, T0 + timedelta(days=3), 2.0)],
                                "id long, ts timestamp_ntz, f double")
    out = get_historical_features(sp, [view(src, ttl=None)], ["v:f"])
    assert rows(out) == [(1, T0, 2.0), (2, T0, None)]


def test_entityless_view(spark):
    sp = spine_at(spark, (1, T0), (2, T0 - timedelta(hours=5)))
    src = spark.createDataFrame([(T0 - timedelta(minutes=1), 1.0), (T0 - timedelta(hours=5, minutes=1), 2.0),
                                 (T0 - timedelta(days=3), 3.0)], "ts timestamp_ntz, f double")
    out = get_historical_features(sp, [view(src, timedelta(hours=1), entities=())], ["v:f"])
    assert rows(out) == [(1, T0, 1.0), (2, T0 - timedelta(hours=5), 2.0)]
    out = get_historical_features(sp, [view(src, None, entities=())], ["v:f"])
    assert rows(out) == [(1, T0, 1.0), (2, T0 - timedelta(hours=5), 1.0)]


def test_two_keys_dedup_key_is_all_keys(spark):
    """Spine rows differing only in the second view's key both survive."""
    sp = spark.createDataFrame([(1, 10, T0), (1, 11, T0), (1, 11, T0)],
                               "driver long, customer long, event_timestamp timestamp_ntz")
    d = spark.createDataFrame([(1, T0, 0.5)], "driver long, ts timestamp_ntz, fd double")
    c = spark.createDataFrame([(10, T0, 1.0), (11, T0, 2.0)], "customer long, ts timestamp_ntz, fc double")
    vd = view(d, entities=("driver",), feats=("fd",), name="vd")
    vc = view(c, entities=("customer",), feats=("fc",), name="vc")
    out = get_historical_features(sp, [vd, vc], ["vd:fd", "vc:fc"])
    assert rows(out) == [(1, 10, T0, 0.5, 1.0), (1, 11, T0, 0.5, 2.0)]


def test_one_view_two_roles(spark):
    sp = spark.createDataFrame([(1, 2, T0)], "origin long, destination long, event_timestamp timestamp_ntz")
    loc = spark.createDataFrame([(1, T0, 10.0), (2, T0, 20.0)], "location long, ts timestamp_ntz, f double")
    v = view(loc, entities=("location",), name="loc")
    o = v.with_name("o").with_join_key_map({"location": "origin"})
    d = v.with_name("d").with_join_key_map({"location": "destination"})
    out = get_historical_features(sp, [o, d], ["o:f", "d:f"], full_feature_names=True)
    assert out.columns == ["origin", "destination", "event_timestamp", "o__f", "d__f"]
    assert rows(out) == [(1, 2, T0, 10.0, 20.0)]


def test_same_ts_name_on_both_sides(spark):
    sp = spark.createDataFrame([(1, T0)], "id long, ts timestamp_ntz")
    src = spark.createDataFrame([(1, T0 - timedelta(hours=2), 1.0)], "id long, ts timestamp_ntz, f double")
    out = get_historical_features(sp, [view(src)], ["v:f"])
    assert out.columns == ["id", "ts", "f"]
    assert rows(out) == [(1, T0, 1.0)]


def test_name_clash_raises_unless_full_names(spark):
    sp = spark.createDataFrame([(1, T0, 0.0)], "id long, event_timestamp timestamp_ntz, f double")
    src = spark.createDataFrame([(1, T0, 1.0)], "id long, ts timestamp_ntz, f double")
    with pytest.raises(ValueError, match="clashes"):
        get_historical_features(sp, [view(src)], ["v:f"])
    out = get_historical_features(sp, [view(src)], ["v:f"], full_feature_names=True)
    assert rows(out) == [(1, T0, 0.0, 1.0)]


def test_missing_join_key_raises(spark):
    sp = spine_at(spark, (1, T0))
    src = spark.createDataFrame([(1, T0, 1.0)], "other long, ts timestamp_ntz, f double")
    with pytest.raises(ValueError):
        get_historical_features(sp, [view(src)], ["v:f"]).collect()


def test_feature_equal_to_key_with_full_names(spark):
    sp = spine_at(spark, (1, T0))
    src = spark.createDataFrame([(1, T0, 1.0)], "id long, ts timestamp_ntz, f double")
    v = FeatureView(name="v", entities=["id"], ttl=timedelta(days=1), schema=["id", "f"],
                    source=DataFrameSource(df=src, timestamp_field="ts"))
    out = get_historical_features(sp, [v], ["v:id", "v:f"], full_feature_names=True)
    assert out.columns == ["id", "event_timestamp", "v__id", "v__f"]
    assert rows(out) == [(1, T0, 1, 1.0)]


def test_detects_single_timestamp_column_and_rejects_ambiguity(spark):
    src = spark.createDataFrame([(1, T0, 1.0)], "id long, ts timestamp_ntz, f double")
    sp = spark.createDataFrame([(1, T0)], "id long, when_ts timestamp_ntz")
    assert rows(get_historical_features(sp, [view(src)], ["v:f"])) == [(1, T0, 1.0)]
    sp2 = spark.createDataFrame([(1, T0, T0)], "id long, a timestamp_ntz, b timestamp_ntz")
    with pytest.raises(ValueError, match="event_timestamp"):
        get_historical_features(sp2, [view(src)], ["v:f"])


def test_pandas_spine_naive_means_utc(spark):
    import pandas as pd
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        pdf = pd.DataFrame({"id": [1], "event_timestamp": [pd.Timestamp("2024-03-10 02:30:00")]})
        src = spark.createDataFrame([(1, datetime(2024, 3, 10, 2, 0), 1.0)], "id long, ts timestamp_ntz, f double")
        out = get_historical_features(pdf, [view(src, timedelta(hours=1))], ["v:f"])
        assert out.collect()[0]["f"] == 1.0
        with pytest.raises(ValueError):
            get_historical_features("select 1", [view(src)], ["v:f"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_ntz_and_instant_sides_agree_under_other_session_zone(spark):
    """Naive source times mean UTC even when the session zone is New York
    (a wall time inside the DST gap included)."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = datetime(2024, 3, 10, 2, 30)          # does not exist in New York
        sp = spark.createDataFrame([(1, us(t))], "id long, m long") \
            .select("id", F.timestamp_micros("m").alias("event_timestamp"))   # instant
        src = spark.createDataFrame([(1, t - timedelta(minutes=59), 1.0), (1, t - timedelta(minutes=61), 2.0)],
                                    "id long, ts timestamp_ntz, f double")
        out = get_historical_features(sp, [view(src, timedelta(hours=1))], ["v:f"])
        assert [r["f"] for r in out.collect()] == [1.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_multi_view_drops_carry_over(spark):
    sp = spine_at(spark, (1, T0), (2, T0))
    a = spark.createDataFrame([(1, T0, 1.0), (2, T0, 2.0)], "id long, ts timestamp_ntz, f double")
    b = spark.createDataFrame([(1, T0, 9.0)], "id long, ts timestamp_ntz, g double")
    out = get_historical_features(sp, [view(a, name="a"), view(b, feats=("g",), name="b")], ["a:f", "b:g"])
    assert rows(out) == [(1, T0, 1.0, 9.0)]


def test_auto_width_splits_hot_key(spark):
    """A key holding most rows gets narrower buckets; results unchanged."""
    from chronofeat.operators.asof import auto_bucket_width, T_COL
    base = datetime(2024, 1, 1)
    src_rows = [(1, base + timedelta(seconds=7 * i), float(i)) for i in range(400)] + \
        [(2, base + timedelta(hours=1), 5.0)]
    src = spark.createDataFrame(src_rows, "id long, ts timestamp_ntz, f double")
    sp = spark.createDataFrame([(1, base + timedelta(minutes=m)) for m in range(0, 50, 3)] + [(2, base + timedelta(hours=2))],
                               "id long, event_timestamp timestamp_ntz")
    ttl = timedelta(hours=1)
    prepared = src.select("id", (F.unix_micros(F.col("ts").cast("timestamp"))).alias(T_COL))
    w = auto_bucket_width(sp, "event_timestamp", prepared, ["id"], 3_600_000_000, 50)
    assert w < 3_600_000_000 and 3_600_000_000 // w >= 8
    base_rows = rows(get_historical_features(sp, [view(src, ttl)], ["v:f"], strategy="join"))
    for mbr in (50, 7, 1):
        assert rows(get_historical_features(sp, [view(src, ttl)], ["v:f"], max_bucket_rows=mbr)) == base_rows


def test_unknown_strategy_and_bad_width(spark):
    sp = spine_at(spark, (1, T0))
    src = spark.createDataFrame([(1, T0, 1.0)], "id long, ts timestamp_ntz, f double")
    with pytest.raises(ValueError):
        get_historical_features(sp, [view(src)], ["v:f"], strategy="nope")


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("created", [False, True])
def test_strategies_equal_brute_force(spark, seed, created):
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)

    def t():
        return None if rnd.random() < 0.03 else base + timedelta(minutes=rnd.randrange(0, 600))

    def k():
        return None if rnd.random() < 0.05 else rnd.randrange(0, 6)

    spine = [(k(), t()) for _ in range(60)] + [(2, base + timedelta(minutes=100))] * 2
    src = []
    for _ in range(300):
        ts = t()
        cr = None if (not created or rnd.random() < 0.2) else base + timedelta(minutes=rnd.randrange(0, 900))
        f = None if rnd.random() < 0.05 else float(rnd.randrange(0, 5))
        src.append((k(), ts, cr, f))
    src.append((2, base + timedelta(minutes=90), None, 1.0))
    src.append((2, base + timedelta(minutes=90), None, 3.0))          # tie on ts: larger f wins
    ttl = timedelta(minutes=rnd.choice([10, 45, 120]))
    sp_df = spark.createDataFrame(spine, "id long, event_timestamp timestamp_ntz")
    src_df = spark.createDataFrame(src, "id long, ts timestamp_ntz, created timestamp_ntz, f double")
    v = view(src_df, ttl, created="created" if created else None)
    m = lambda x: None if x is None else us(x)
    exp = brute_asof([(a, m(b)) for a, b in spine], [(a, m(b), m(c), f) for a, b, c, f in src],
                     ttl.total_seconds() * 1e6, created)
    exp_rows = sorted(((a, b, f) for (a, b), f in exp.items()), key=str)
    widths = [None, "auto", timedelta(minutes=3), ttl / 3, timedelta(seconds=7)]
    kws = [dict(strategy="join"), dict(max_bucket_rows=4)] + [dict(bucket_width=w) for w in widths]
    for kw in kws:
        got = get_historical_features(sp_df, [v], ["v:f"], **kw)
        got_rows = sorted(((r[0], us(r[1]), r[2]) for r in got.collect()), key=str)
        assert got_rows == exp_rows, kw


@pytest.mark.parametrize("kw", STRATS + [dict(bucket_width=timedelta(minutes=1))])
def test_unorderable_feature_uses_max_by(spark, kw):
    sp = spine_at(spark, (1, T0), (2, T0))
    src = spark.createDataFrame([(1, T0 - timedelta(minutes=30), {"a": 1}, 1.0),
                                 (1, T0 - timedelta(minutes=2), {"b": 2}, 2.0),
                                 (2, T0 - timedelta(minutes=90), {"c": 3}, 3.0)],
                                "id long, ts timestamp_ntz, m map<string,int>, f double")
    out = get_historical_features(sp, [view(src, timedelta(hours=2), feats=("m", "f"))], ["v:m", "v:f"], **kw)
    got = {r["id"]: (r["m"], r["f"]) for r in out.collect()}
    assert got == {1: ({"b": 2}, 2.0), 2: ({"c": 3}, 3.0)}


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("keep", [False, True])
def test_fused_views_equal_brute_force(spark, seed, keep):
    """Two views on the same key with different TTLs (one ranked by created)
    share one pass; the result equals per-view brute force, intersected."""
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)

    def t():
        return base + timedelta(minutes=rnd.randrange(0, 400))

    spine = [(rnd.randrange(0, 5), t()) for _ in range(50)]
    a = [(rnd.randrange(0, 5), t(), None, float(rnd.randrange(0, 9))) for _ in range(150)]
    b = [(rnd.randrange(0, 5), t(), t(), float(rnd.randrange(0, 9))) for _ in range(150)]
    ttl_a, ttl_b = timedelta(minutes=25), timedelta(minutes=70)
    sp_df = spark.createDataFrame(spine, "id long, event_timestamp timestamp_ntz")
    a_df = spark.createDataFrame([(k, ts, f) for k, ts, _, f in a], "id long, ts timestamp_ntz, fa double")
    b_df = spark.createDataFrame(b, "id long, ts timestamp_ntz, created timestamp_ntz, fb double")
    va = view(a_df, ttl_a, feats=("fa",), name="a")
    vb = view(b_df, ttl_b, created="created", feats=("fb",), name="b")
    m = lambda x: None if x is None else us(x)
    sp_us = [(k, m(x)) for k, x in spine]
    ea = brute_asof(sp_us, [(k, m(x), None, f) for k, x, _, f in a], ttl_a.total_seconds() * 1e6, False, keep)
    eb = brute_asof(sp_us, [(k, m(x), m(c), f) for k, x, c, f in b], ttl_b.total_seconds() * 1e6, True, keep)
    exp = sorted(((k, tt, ea[(k, tt)], eb[(k, tt)]) for (k, tt) in set(sp_us) if (k, tt) in ea and (k, tt) in eb),
                 key=str)
    for kw in [dict(), dict(bucket_width=timedelta(minutes=4)), dict(max_bucket_rows=3), dict(strategy="join")]:
        got = get_historical_features(sp_df, [va, vb], ["a:fa", "b:fb"], keep_unmatched=keep, **kw)
        assert got.columns == ["id", "event_timestamp", "fa", "fb"]
        got_rows = sorted(((r[0], us(r[1]), r[2], r[3]) for r in got.collect()), key=str)
        assert got_rows == exp, kw


def test_checkpoint_every_cuts_lineage(spark):
    sp = spark.createDataFrame([(1, 2, T0)], "a long, b long, event_timestamp timestamp_ntz")
    va = view(spark.createDataFrame([(1, T0, 1.0)], "a long, ts timestamp_ntz, fa double"),
              entities=("a",), feats=("fa",), name="va")
    vb = view(spark.createDataFrame([(2, T0, 2.0)], "b long, ts timestamp_ntz, fb double"),
              entities=("b",), feats=("fb",), name="vb")
    out = get_historical_features(sp, [va, vb], ["va:fa", "vb:fb"], checkpoint_every=1)
    assert rows(out) == [(1, 2, T0, 1.0, 2.0)]


def test_heavy_copies_are_detected_and_collapsed(spark):
    """Copies on (key, time) cannot be split by time slicing: the stats job
    flags them, the plan collapses them first, results are unchanged."""
    from chronofeat.operators.asof import asof_plan_stats, T_COL
    t = datetime(2024, 1, 1, 12)
    src = spark.createDataFrame([(1, t, float(i % 5)) for i in range(60)] + [(2, t, 9.0)],
                                "id long, ts timestamp_ntz, f double")
    sp = spark.createDataFrame([(1, t + timedelta(minutes=5))] * 40 + [(2, t)],
                               "id long, event_timestamp timestamp_ntz")
    prepared = src.select("id", F.unix_micros(F.col("ts").cast("timestamp")).alias(T_COL))
    st = asof_plan_stats(sp, "event_timestamp", [(prepared, ["id"], 3_600_000_000)], 10)[0]
    assert st.source_copies and st.spine_copies
    exp = [(1, t + timedelta(minutes=5), 4.0), (2, t, 9.0)]
    assert rows(get_historical_features(sp, [view(src, timedelta(hours=1))], ["v:f"], max_bucket_rows=10)) == exp
    assert rows(get_historical_features(sp, [view(src, timedelta(hours=1))], ["v:f"])) == exp


def test_join_strategy_falls_back_when_pairs_unbounded(spark):
    base = datetime(2024, 1, 1)
    dense_src = spark.createDataFrame([(1, base + timedelta(seconds=i), float(i)) for i in range(60)],
                                      "id long, ts timestamp_ntz, f double")
    dense_sp = spark.createDataFrame([(1, base + timedelta(seconds=60 + i)) for i in range(60)],
                                     "id long, event_timestamp timestamp_ntz")
    out = get_historical_features(dense_sp, [view(dense_src, timedelta(hours=1))], ["v:f"], strategy="join")
    plan = plan_text(out)
    assert "Window" in plan
    assert {r["f"] for r in out.collect()} == {59.0}
    sparse_sp = spark.createDataFrame([(1, base + timedelta(seconds=30))], "id long, event_timestamp timestamp_ntz")
    out = get_historical_features(sparse_sp, [view(dense_src, timedelta(seconds=5))], ["v:f"], strategy="join")
    plan = plan_text(out)
    assert "Window" not in plan
    assert [r["f"] for r in out.collect()] == [30.0]


def test_low_level_fused_pass_with_different_ttls(spark):
    """point_in_time_join_many fuses views of different TTLs (middle blocks
    for the wider one); same rows as two separate passes."""
    from chronofeat.operators.asof import AsofView, point_in_time_join_many, T_COL
    rnd = random.Random(5)
    base = datetime(2024, 1, 1)
    sp = spark.createDataFrame([(rnd.randrange(4), base + timedelta(minutes=rnd.randrange(500))) for _ in range(40)],
                               "id long, event_timestamp timestamp_ntz")

    def src(name):
        df = spark.createDataFrame([(rnd.randrange(4), base + timedelta(minutes=rnd.randrange(500)), float(i))
                                    for i in range(120)], f"id long, ts timestamp_ntz, {name} double")
        return df.select("id", F.unix_micros(F.col("ts").cast("timestamp")).alias(T_COL), name)

    a, b = src("fa"), src("fb")
    m = 60 * 10**6
    A = AsofView(a, ["fa"], 20 * m, False, 20 * m)
    B = AsofView(b, ["fb"], 75 * m, False, 75 * m)
    gk = ["id", "event_timestamp"]
    fused = point_in_time_join_many(sp, "event_timestamp", gk, ["id"], [A, B])
    sep = point_in_time_join_many(point_in_time_join_many(sp, "event_timestamp", gk, ["id"], [A]),
                                  "event_timestamp", gk, ["id"], [B])
    assert rows(fused) == rows(sep)


def test_only_hot_keys_get_narrow_buckets(spark):
    from chronofeat.operators.asof import asof_plan_stats, T_COL
    base = datetime(2024, 1, 1)
    rows_ = [(1, base + timedelta(seconds=5 * i), 1.0) for i in range(300)] + \
        [(k, base + timedelta(minutes=k), 2.0) for k in range(2, 40)]
    src = spark.createDataFrame(rows_, "id long, ts timestamp_ntz, f double") \
        .select("id", F.unix_micros(F.col("ts").cast("timestamp")).alias(T_COL))
    sp = spark.createDataFrame([(k, base + timedelta(hours=1)) for k in range(1, 40)],
                               "id long, event_timestamp timestamp_ntz")
    st = asof_plan_stats(sp, "event_timestamp", [(src, ["id"], 3_600_000_000)], 40)[0]
    h1 = spark.range(1).select(F.xxhash64(F.lit(1).cast("long")).alias("h")).first()["h"]
    assert list(st.hot_keys) == [h1] and st.hot_keys[h1] >= 3


@pytest.mark.parametrize("kw", [dict(), dict(strategy="join"), dict(keep_unmatched=True)])
def test_spine_copies_with_other_key_columns(spark, kw):
    """Spine copies on (view key, time) that differ in another view's key are
    answered once per point and joined back; results unchanged."""
    from chronofeat.operators.asof import AsofView, point_in_time_join_many, T_COL
    t = datetime(2024, 1, 1, 12)
    sp = spark.createDataFrame([(1, c, t) for c in range(30)] + [(2, 0, t), (None, 1, t)],
                               "a long, b long, event_timestamp timestamp_ntz")
    src = spark.createDataFrame([(1, t - timedelta(minutes=m), float(m)) for m in range(5)] + [(2, t, 9.0)],
                                "a long, ts timestamp_ntz, f double") \
        .select("a", F.unix_micros(F.col("ts").cast("timestamp")).alias(T_COL), "f")
    gk = ["a", "b", "event_timestamp"]
    strategy = kw.get("strategy", "bucketed")
    keep = kw.get("keep_unmatched", False)
    v = AsofView(src, ["f"], 3_600_000_000, False, 3_600_000_000)
    plain = point_in_time_join_many(sp, "event_timestamp", gk, ["a"], [v], strategy, keep)
    dedup = point_in_time_join_many(sp, "event_timestamp", gk, ["a"], [v], strategy, keep, dedup_spine=True)
    assert sorted(map(tuple, dedup.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert dedup.count() == (32 if keep else 31)


def test_string_time_column_source(spark):
    sp = spine_at(spark, (1, T0))
    src = spark.createDataFrame([(1, (T0 - timedelta(minutes=5)).isoformat(), 1.0),
                                 (1, (T0 - timedelta(days=3)).isoformat(), 2.0)], "id long, ts string, f double")
    assert rows(get_historical_features(sp, [view(src)], ["v:f"])) == [(1, T0, 1.0)]


@pytest.mark.parametrize("seed,keep", [(21, False), (22, True), (23, False)])
def test_mixed_views_fold_equals_brute_force(spark, seed, keep):
    """Two TTL views on `id` (fused), one no-TTL view on `id2`; spine rows
    equal on (id, id2, t) collapse; TTL views drop unmatched rows unless
    keep_unmatched; the no-TTL view keeps them."""
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)

    def t():
        return base + timedelta(minutes=rnd.randrange(0, 300))

    spine = [(rnd.randrange(0, 4), rnd.randrange(0, 3), t()) for _ in range(40)]
    spine += spine[:5]                                   # duplicates
    a = [(rnd.randrange(0, 4), t(), float(rnd.randrange(9))) for _ in range(80)]
    c = [(rnd.randrange(0, 4), t(), float(rnd.randrange(9))) for _ in range(80)]
    b = [(rnd.randrange(0, 3), t(), float(rnd.randrange(9))) for _ in range(30)]
    ttl = timedelta(minutes=40)
    sp = spark.createDataFrame(spine, "id long, id2 long, event_timestamp timestamp_ntz")
    va = view(spark.createDataFrame(a, "id long, ts timestamp_ntz, fa double"), ttl, feats=("fa",), name="va")
    vc = view(spark.createDataFrame(c, "id long, ts timestamp_ntz, fc double"), ttl, feats=("fc",), name="vc")
    vb = view(spark.createDataFrame(b, "id2 long, ts timestamp_ntz, fb double"), None, entities=("id2",),
              feats=("fb",), name="vb")
    m = lambda x: us(x)
    pts = [(i, m(x)) for i, _, x in spine]
    ea = brute_asof(pts, [(k, m(x), None, f) for k, x, f in a], ttl.total_seconds() * 1e6, False, keep)
    ec = brute_asof(pts, [(k, m(x), None, f) for k, x, f in c], ttl.total_seconds() * 1e6, False, keep)
    eb = brute_asof([(j, m(x)) for _, j, x in spine], [(k, m(x), None, f) for k, x, f in b], None, False)
    exp = set()
    for i, j, x in set(spine):
        key = (i, m(x))
        if key not in ea or key not in ec:
            continue
        exp.add((i, j, m(x), ea[key], eb[(j, m(x))], ec[key]))
    for kw in [dict(), dict(max_bucket_rows=3)]:
        got = get_historical_features(sp, [va, vb, vc], ["va:fa", "vb:fb", "vc:fc"], keep_unmatched=keep, **kw)
        assert got.columns == ["id", "id2", "event_timestamp", "fa", "fb", "fc"]
        got_rows = [(r[0], r[1], us(r[2]), r[3], r[4], r[5]) for r in got.collect()]
        assert len(got_rows) == len(set(got_rows))
        assert sorted(got_rows, key=str) == sorted(exp, key=str), kw


@pytest.mark.parametrize("kw", STRATS + [dict(keep_unmatched=True)])
def test_empty_and_null_inputs(spark, kw):
    empty_sp = spark.createDataFrame([], "id long, event_timestamp timestamp_ntz")
    src = spark.createDataFrame([(1, T0, 1.0)], "id long, ts timestamp_ntz, f double")
    empty_src = spark.createDataFrame([], "id long, ts timestamp_ntz, f double")
    assert get_historical_features(empty_sp, [view(src)], ["v:f"], **kw).count() == 0
    sp = spine_at(spark, (1, T0))
    got = rows(get_historical_features(sp, [view(empty_src)], ["v:f"], **kw))
    assert got == ([(1, T0, None)] if kw.get("keep_unmatched") else [])
    nulls = spark.createDataFrame([(None, T0), (None, None)], "id long, event_timestamp timestamp_ntz")
    got = get_historical_features(nulls, [view(src)], ["v:f"], **kw).count()
    assert got == (2 if kw.get("keep_unmatched") else 0)
    assert rows(get_historical_features(sp, [view(empty_src, ttl=None)], ["v:f"])) == [(1, T0, None)]


def test_date_typed_timestamp_field_and_narrower_key_type(spark):
    """Source time column of DATE type and INT entity key, spine with a long
    key and a timestamp: dates count as UTC midnight."""
    from datetime import date
    sp = spark.createDataFrame([(1, datetime(2021, 10, 1, 23, 59, 42))], "entity_id long, event_timestamp timestamp_ntz")
    src = spark.createDataFrame([(1, date(2021, 10, 1), 1.0), (1, date(2021, 10, 2), 2.0), (1, date(2021, 9, 1), 3.0)],
                                "entity_id int, datetime date, f0 float")
    v = FeatureView(name="fv", entities=["entity_id"], ttl=timedelta(days=20), schema=["f0"],
                    source=DataFrameSource(df=src, timestamp_field="datetime"))
    for kw in STRATS:
        assert [r["f0"] for r in get_historical_features(sp, [v], ["fv:f0"], **kw).collect()] == [1.0]


def test_max_views_per_pass_splits_passes_same_result(spark):
    base = datetime(2024, 1, 1)
    rnd = random.Random(9)
    sp = spark.createDataFrame([(rnd.randrange(3), base + timedelta(minutes=rnd.randrange(200))) for _ in range(30)],
                               "id long, event_timestamp timestamp_ntz")
    views = []
    for name in ("x", "y", "z"):
        df = spark.createDataFrame([(rnd.randrange(3), base + timedelta(minutes=rnd.randrange(200)),
                                     float(rnd.randrange(9))) for _ in range(60)], f"id long, ts timestamp_ntz, {name} double")
        views.append(view(df, timedelta(minutes=45), feats=(name,), name=name))
    refs = ["x:x", "y:y", "z:z"]
    one = get_historical_features(sp, views, refs, keep_unmatched=True)
    split = get_historical_features(sp, views, refs, keep_unmatched=True, max_views_per_pass=2)
    assert split.columns == one.columns == ["id", "event_timestamp", "x", "y", "z"]
    assert rows(split) == rows(one)


def test_without_spine_range_pruning_same_result(spark):
    base = datetime(2024, 1, 1)
    rnd = random.Random(4)
    sp = spark.createDataFrame([(rnd.randrange(3), base + timedelta(minutes=rnd.randrange(300))) for _ in range(30)],
                               "id long, event_timestamp timestamp_ntz")
    src = spark.createDataFrame([(rnd.randrange(3), base + timedelta(minutes=rnd.randrange(-200, 500)),
                                  float(rnd.randrange(9))) for _ in range(120)], "id long, ts timestamp_ntz, f double")
    v = view(src, timedelta(minutes=50))
    a = get_historical_features(sp, [v], ["v:f"])
    b = get_historical_features(sp, [v], ["v:f"], prune_by_spine_range=False, bucket_width=None)
    assert rows(a) == rows(b)


def test_retrieval_metadata(spark):
    from chronofeat.plans import retrieval_metadata
    sp = spine_at(spark, (1, T0), (2, T0 + timedelta(days=1)))
    md = retrieval_metadata(sp, ["v:f", ("w", "g")])
    assert md == {"features": ["v:f", "w:g"], "keys": ["id"], "min_event_timestamp": T0,
                  "max_event_timestamp": T0 + timedelta(days=1)}
