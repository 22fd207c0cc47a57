"""Definitions: sources, views, projections, refs."""

from datetime import timedelta

import pytest

from chronofeat import CsvSource, FeatureView, OnDemandFeatureView, ParquetSource, parse_feature_ref
from chronofeat.functions.ondemand import apply_on_demand
from chronofeat.functions.timecols import python_to_micros, ttl_micros
from chronofeat.model import group_feature_refs


def test_numeric_ttl_and_zero_ttl():
    src = ParquetSource(path="/x", timestamp_field="ts")
    assert FeatureView(name="v", source=src, ttl=3600).ttl == timedelta(hours=1)
    assert FeatureView(name="v", source=src, ttl=timedelta(0)).ttl_seconds is None
    assert ttl_micros(1.5) == 1_500_000 and ttl_micros(0) is None and ttl_micros(None) is None


def test_projection_and_names():
    src = ParquetSource(path="/x", timestamp_field="ts", field_mapping={"a": "b"})
    v = FeatureView(name="loc", source=src, entities=["location"], schema=["location", "f"])
    p = v.with_name("origin").with_join_key_map({"location": "origin_id"})
    assert p.name_to_use() == "origin" and p.join_keys == ["origin_id"] and v.join_keys == ["location"]
    assert v.feature_names == ["f"] and src.mapping == {"a": "b"}
    assert CsvSource(path="/c", timestamp_field="ts").delimiter == ","


def test_feature_refs():
    src = ParquetSource(path="/x", timestamp_field="ts")
    a = FeatureView(name="a", source=src, entities=["id"], schema=["f", "g"])
    b = FeatureView(name="b", source=src, entities=["id"], schema=["h"])
    od = OnDemandFeatureView(name="od", transform=lambda df: df)
    grouped, ods = group_feature_refs(["b:h", "a:g", ("a", "f"), "od:x", "a:g"], [a, b], [od])
    assert [(v.name, fs) for v, fs in grouped] == [("b", ["h"]), ("a", ["g", "f"])] and ods == [od]
    assert parse_feature_ref("v:f:x") == ("v", "f:x")
    with pytest.raises(ValueError):
        parse_feature_ref("nocolon")
    with pytest.raises(ValueError):
        group_feature_refs(["zz:f"], [a, b])
    with pytest.raises(ValueError):
        group_feature_refs(["a:nope"], [a, b])


def test_time_bounds_naive_is_utc():
    from datetime import datetime, timezone
    assert python_to_micros(datetime(1970, 1, 2)) == 86_400_000_000
    assert python_to_micros(datetime(1970, 1, 2, tzinfo=timezone(timedelta(hours=1)))) == 82_800_000_000
    assert python_to_micros("1970-01-01T00:00:01") == 1_000_000


def test_pandas_on_demand_needs_schema(spark):
    df = spark.createDataFrame([(1.0,)], "f double")
    with pytest.raises(ValueError):
        apply_on_demand(df, OnDemandFeatureView(name="x", transform=lambda p: p, pandas=True))
