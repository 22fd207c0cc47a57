"""Every registered query against its SQL oracle (DuckDB) on driver data."""

import math

import duckdb
import pytest

from helpers import plan_text

from __spark_entry__ import entry, oracle_sql, queries
from chronofeat.queries import QUERIES

TABLES = ["customer", "orders", "lineitem", "events", "nation"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, round(v, 9))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, str(v))


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["user_id", "event_timestamp", "f"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(ocols)
    assert _canon(cols, rows) == _canon(ocols, res.fetchall())
