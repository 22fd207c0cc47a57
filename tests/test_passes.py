"""Requests over several key sets: one final aggregate, plans linear in the passes."""

import random
import re
from datetime import datetime, timedelta

import pytest

from chronofeat import DataFrameSource, FeatureView, get_historical_features
from chronofeat.operators import asof
from helpers import brute_asof, plan_text, rows, us

BASE = datetime(2024, 1, 1)
KEYS = ["k0", "k1", "k2", "k3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(9)

    def t():
        return BASE + timedelta(minutes=rng.randrange(600))
    spine = [(*[rng.choice([None, 0, 1, 2, 3]) if rng.random() < 0.2 else rng.randrange(4) for _ in KEYS], t(), f"p{i}")
             for i in range(60)]
    sources = [[(rng.randrange(4), t(), float(rng.randrange(9))) for _ in range(60)] for _ in KEYS]
    sp = spark.createDataFrame(spine, ", ".join(f"{k} long" for k in KEYS) + ", event_timestamp timestamp_ntz, note string")
    return spine, sources, sp


def views(spark, sources, ttls):
    return [FeatureView(name=f"v{i}", entities=[KEYS[i]], ttl=ttl, schema=[f"f{i}"], source=DataFrameSource(
        df=spark.createDataFrame(src, f"{KEYS[i]} long, ts timestamp_ntz, f{i} double"), timestamp_field="ts"))
        for i, (src, ttl) in enumerate(zip(sources, ttls))]


@pytest.mark.parametrize("options", [dict(), dict(keep_unmatched=True), dict(bucket_width=timedelta(minutes=11)),
                                     dict(max_bucket_rows=6), dict(checkpoint_every=1, bucket_width=None),
                                     dict(strategy="join")])
@pytest.mark.filterwarnings("ignore")
def test_four_key_sets_equal_brute_force(spark, data, options):
    spine, sources, sp = data
    ttls = [timedelta(minutes=90), None, timedelta(hours=4), timedelta(minutes=200)]
    got = get_historical_features(sp, views(spark, sources, ttls), [f"v{i}:f{i}" for i in range(4)], **options)
    keep = options.get("keep_unmatched", False)
    answers = [brute_asof([(r[i], us(r[4])) for r in spine], [(k, us(t), None, f) for k, t, f in src],
                          None if ttl is None else ttl // timedelta(microseconds=1), False, keep)
               for i, (src, ttl) in enumerate(zip(sources, ttls))]
    want = {}
    for r in spine:
        found = [a.get((r[i], us(r[4])), "none") for i, a in enumerate(answers)]
        if "none" not in found:
            want[r[:5]] = max(want.get(r[:5], ("",)), (r[5], *found), key=lambda x: x[0])
    assert got.columns == [*KEYS, "event_timestamp", "note", "f0", "f1", "f2", "f3"]
    assert {tuple(r)[:5]: tuple(r)[5:] for r in got.collect()} == want


def test_plans_grow_with_the_passes_only(spark, data):
    _, sources, sp = data
    all_views = views(spark, sources, [timedelta(hours=2)] * 4)
    nodes, scans = [], []
    for n in range(1, 5):
        out = get_historical_features(sp, all_views[:n], [f"v{i}:f{i}" for i in range(n)], bucket_width=timedelta(minutes=30))
        tree = plan_text(out).split("\n\n\n")[0].split("\n")
        nodes.append(len(tree))
        scans.append(sum("Scan" in x for x in tree))
    steps = [b - a for a, b in zip(nodes, nodes[1:])]
    assert max(steps) <= nodes[0] + 5 and max(steps) - min(steps) <= 6, nodes
    assert scans == [scans[0] * n for n in range(1, 5)], scans


def test_payload_is_carried_once(spark, data):
    _, sources, sp = data
    out = get_historical_features(sp, views(spark, sources, [timedelta(hours=2)] * 4), [f"v{i}:f{i}" for i in range(4)],
                                  bucket_width=None)
    scans = [x for x in plan_text(out).split("\n") if x.startswith("Output") and "note#" in x and "k0#" in x]
    assert len(scans) >= 1
    assert rows(out) == rows(get_historical_features(sp, views(spark, sources, [timedelta(hours=2)] * 4),
                                                     [f"v{i}:f{i}" for i in range(4)]))


@pytest.mark.parametrize("options", [dict(bucket_width=timedelta(minutes=11)), dict(max_bucket_rows=6),
                                     dict(bucket_width=timedelta(minutes=11), keep_unmatched=True)])
def test_a_task_sorts_rows_by_their_number(spark, data, options, monkeypatch):
    """Windows, block joins and the final aggregate get a task per so many rows: adaptive execution,
    which would merge them by compressed bytes, leaves a number that is asked for."""
    _, sources, sp = data
    want = [f"v{i}:f{i}" for i in range(3)]

    def run():
        return get_historical_features(sp, views(spark, sources, [timedelta(hours=2)] * 3), want, **options)
    plain = rows(run())
    seen = []
    for most in (40, 20):
        monkeypatch.setattr(asof, "ROWS_A_TASK", most)
        out = run()
        asked = re.findall(r"hashpartitioning\((.*), (\d+)\), REPARTITION_BY_NUM", plan_text(out))
        seen.append({what: [int(n) for cols, n in asked if what in cols] for what in (asof.BUCKET + "#", "__cf_lvl", asof.GKEY + "#")})
        assert rows(out) == plain
    few, many = seen
    assert all(len(few[x]) == len(many[x]) > 0 for x in few), seen
    # twice as many tasks, rounded up
    assert all(2 * a - 1 <= b <= 2 * a for x in few for a, b in zip(few[x], many[x])), seen
    assert min(many[asof.BUCKET + "#"]) >= 6 and many[asof.GKEY + "#"][0] >= 20
