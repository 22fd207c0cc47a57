"""Clashing column names, ids that are no numbers, hot and rare hosts."""

import pytest
from pyspark.sql import functions as F

from chronofeat.llm import quality_rules as rules
from chronofeat.llm.exact_dedup import drop_exact_duplicates
from chronofeat.llm.ngram_join import drop_near_duplicates, ngram_jaccard_join
from chronofeat.llm.quality_rules import drop_low_quality, quality_rules
from chronofeat.llm.secrets import redact_secrets

DOCS = "doc_id long, text string, source string"
LONG = " ".join(f"word{k}" for k in range(80))
ROWS = [(1, LONG, "a"), (2, LONG, "a"), (3, LONG + " more", "b"), (4, "password = hunter2hunter2 " + LONG[::-1], None),
        (5, None, "b"), (6, "", "a")]


@pytest.mark.parametrize("op", [drop_exact_duplicates, drop_low_quality, drop_near_duplicates, redact_secrets])
def test_odd_names_come_out_as_they_were(spark, op):
    plain = spark.createDataFrame(ROWS, DOCS)
    odd = plain.selectExpr("*", "doc_id * 2 AS __cf_id", "'x' AS `__CF_digest`", "1 AS __cf_hot", "2 AS __cf_salt", "3 AS __cf_gone",
                           "4 AS __cf_key", "5 AS `a.b`", "6 AS `c``d`", "7 AS aside_0", "8 AS __cf_doc_salt")
    got = op(odd)
    assert got.columns == odd.columns
    rows = [tuple(r) for r in got.collect()]
    assert sorted(map(str, (r[:3] for r in rows))) == sorted(str(tuple(r)) for r in op(plain).collect())
    assert all(r[3:] == (2 * r[0], "x", 1, 2, 3, 4, 5, 6, 7, 8) for r in rows) and rows
    assert op(odd.limit(0)).count() == 0


def test_the_id_and_text_may_have_such_names(spark):
    df = spark.createDataFrame(ROWS, "__cf_id long, `te.xt` string, source string")
    assert sorted(r[0] for r in drop_exact_duplicates(df, "__cf_id", text_col="te.xt").collect()) == [2, 3, 4, 6]


def test_ids_that_are_no_integers_are_refused(spark):
    with pytest.raises(TypeError, match="integers"):
        ngram_jaccard_join(spark.createDataFrame([("x", LONG)], "doc_id string, text string"))


def test_hot_and_rare_hosts_get_their_verdicts(spark):
    """Two hot hosts and 600 rare ones: rates by a loop, whatever the number of salts; only hot hosts have salts."""
    rows = [(k, LONG if k % 3 else "short", "hot") for k in range(900)] + [(k, "short", "bad") for k in range(900, 1300)]
    rows += [(k, LONG if k % 5 else "short", f"rare {k // 2}") for k in range(1300, 2500)] + [(2500, LONG, None)]
    df = spark.createDataFrame(rows, DOCS)
    tally = {}
    for _, text, host in rows:
        n, f = tally.get(host, (0, 0))
        tally[host] = (n + 1, f + (text == "short"))
    tally.pop(None)
    docs, bad = sum(n for n, _ in tally.values()), sum(f for _, f in tally.values())
    mean = bad / docs
    spread = max(sum(f * f / n for n, f in tally.values()) / docs - mean * mean, 1e-6)
    weight = max(mean * (1 - mean) / spread - 1, 1)
    rate = {h: (f + mean * weight) / (n + weight) for h, (n, f) in tally.items()}
    for salts in (1, 7, 64):
        got = {r.doc_id: r for r in quality_rules(df, salts=salts).collect()}
        assert len(got) == len(rows)
        for k, text, host in rows:
            assert got[k].host_rate == (None if host is None else pytest.approx(rate[host]))
            assert got[k].kept == (text == LONG and rate.get(host, 0) <= 0.5)
        kept = {r.doc_id for r in drop_low_quality(df, salts=salts).collect()}
        assert kept == {k for k, r in got.items() if r.kept}
    hosts = rules.host_verdicts(df, "source", F.col("text") == "short", 0.5)
    salted = rules._with_salts(hosts, rules.hot_hosts(hosts), 64).groupBy("__cf_host").count().collect()
    assert {r[0]: r[1] for r in salted if r[1] > 1} == {"hot": 64, "bad": 64} and len(salted) == len(tally)
