"""Property test: every as-of plan equals a brute-force loop."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronofeat import DataFrameSource, FeatureView, get_historical_features
from helpers import brute_asof, us

BASE = datetime(2024, 1, 1)
maybe_key = st.one_of(st.none(), st.integers(0, 3))
minute = st.integers(0, 300)
maybe_minute = st.one_of(st.none(), minute)
value = st.one_of(st.none(), st.integers(0, 4).map(float))

spine_rows = st.lists(st.tuples(maybe_key, maybe_minute), min_size=1, max_size=25)
source_rows = st.lists(st.tuples(maybe_key, maybe_minute, maybe_minute, value), min_size=0, max_size=60)
plans = st.sampled_from([dict(), dict(strategy="join"), dict(bucket_width=timedelta(minutes=7)),
                         dict(max_bucket_rows=2), dict(bucket_width=timedelta(minutes=1))])


def _t(m):
    return None if m is None else BASE + timedelta(minutes=m)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spine=spine_rows, source=source_rows, ttl_min=st.sampled_from([5, 30, 90]),
       created=st.booleans(), keep=st.booleans(), plan=plans)
def test_asof_equals_brute_force(spark, spine, source, ttl_min, created, keep, plan):
    sp = spark.createDataFrame([(k, _t(m)) for k, m in spine], "id long, event_timestamp timestamp_ntz")
    src = spark.createDataFrame([(k, _t(m), _t(c) if created else None, f) for k, m, c, f in source],
                                "id long, ts timestamp_ntz, created timestamp_ntz, f double")
    v = FeatureView(name="v", entities=["id"], ttl=timedelta(minutes=ttl_min), schema=["f"],
                    source=DataFrameSource(df=src, timestamp_field="ts",
                                           created_timestamp_column="created" if created else None))
    m = lambda x: None if x is None else us(x)
    exp = brute_asof([(k, m(_t(t))) for k, t in spine],
                     [(k, m(_t(t)), m(_t(c)) if created else None, f) for k, t, c, f in source],
                     ttl_min * 60 * 1e6, created, keep)
    if keep:   # rows with a NULL key or time are kept too, unmatched
        for k, t in set(spine):
            exp.setdefault((k, m(_t(t))), None)
    got = get_historical_features(sp, [v], ["v:f"], keep_unmatched=keep, **plan)
    got_rows = sorted(((r[0], None if r[1] is None else us(r[1]), r[2]) for r in got.collect()), key=str)
    assert got_rows == sorted(((k, t, f) for (k, t), f in exp.items()), key=str)
