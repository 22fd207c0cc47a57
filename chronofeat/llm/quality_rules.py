"""Quality rules on documents and on their hosts.

Every text is measured in its own row with built-in functions.  The rule
failures are then counted by host, each host's failure rate is shrunk towards
all hosts by an empirical beta prior, and the host's verdict is joined back to
its documents.  The documents of hot hosts are spread over salts for that join,
so a hot host is not one task; the counts are partial on every task.
"""

from __future__ import annotations

from typing import Dict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, SPACE, let, materialise, own_names_aside

SYMBOLS = r"[#*$%&|<>]"


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in ``words``.

    Windows are compared by a 64-bit hash of their three words.  Sorting
    (hash, place) pairs finds the repeated ones; walking their places in order
    counts every covered word once.  All steps are ``n log n`` in the words of
    the text; a text without a repeated window is settled by a hash set."""
    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))) \
            .otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        twice = let(pairs, lambda s: F.filter(
            s, lambda e, i: F.coalesce(e["h"] == F.get(s, i - 1)["h"], F.lit(False))
            | F.coalesce(e["h"] == F.get(s, i + 1)["h"], F.lit(False))))
        places = F.sort_array(F.transform(twice, lambda e: e["p"]))
        return F.aggregate(
            places, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    return let(words, lambda w: let(windows(w), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h))))


def base_metrics(text: Column) -> Dict[str, Column]:
    """Measures of one text as columns; a null text has no words."""
    t = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(t, SPACE + "+"), lambda x: x != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE))
    return {
        "word_chars": F.length(t).cast("bigint") - F.regexp_count(t, F.lit(SPACE)),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")),
        "words": let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"),
                                               repeat_words(w).alias("n_repeat_words"))),
    }


def with_base_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``__cf_m``: the measures and ``base_failed``."""
    m = base_metrics(F.col(text_col))
    cols = docs.columns
    out = docs.select(*cols, F.struct(*[c.alias(k) for k, c in m.items()]).alias("__cf_raw"))
    w = F.col("__cf_raw.words")
    return out.select(*cols, F.struct(
        w["n_words"].alias("n_words"), F.col("__cf_raw.word_chars").alias("word_chars"),
        F.col("__cf_raw.n_symbols").alias("n_symbols"), F.col("__cf_raw.n_dup_lines").alias("n_dup_lines"),
        w["n_repeat_words"].alias("n_repeat_words"),
        ((w["n_words"] < 50) | (F.lit(100) * w["n_repeat_words"] > F.lit(50) * w["n_words"])).alias("base_failed"),
    ).alias("__cf_m"))


def host_verdicts(rows: DataFrame, host_col: str, failed: Column, max_rate: float) -> DataFrame:
    """``(__cf_host, host_docs, host_failed, host_rate, host_rejected)`` by host.

    The prior is a beta distribution fitted to the hosts' failure rates by
    moments (mean and spread of the rates, each host weighing by its
    documents); a host's rate is the posterior mean, so a host with few
    documents stays close to the corpus.  A host is rejected when that rate is
    above ``max_rate``.  Documents without a host form none."""
    hosts = rows.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("__cf_host")).agg(
        F.count(F.lit(1)).alias("host_docs"),
        F.sum(F.when(failed, F.lit(1)).otherwise(F.lit(0))).alias("host_failed"))
    n, f = F.col("host_docs").cast("double"), F.col("host_failed").cast("double")
    prior = hosts.agg(F.sum(n).alias("docs"), F.sum(f).alias("bad"), F.sum(f * f / n).alias("sq"),
                      F.count(F.lit(1)).alias("hosts"))
    mean = F.col("bad") / F.col("docs")
    spread = F.greatest(F.col("sq") / F.col("docs") - mean * mean, F.lit(1e-6))
    prior = prior.select(mean.alias("__cf_mean"),
                         F.greatest(mean * (F.lit(1.0) - mean) / spread - F.lit(1.0), F.lit(1.0)).alias("__cf_weight"))
    # one row: the prior
    return hosts.join(F.broadcast(prior)).select(
        "__cf_host", "host_docs", "host_failed",
        ((f + F.col("__cf_mean") * F.col("__cf_weight")) / (n + F.col("__cf_weight"))).alias("host_rate")) \
        .withColumn("host_rejected", F.col("host_rate") > F.lit(max_rate))


#: A host is hot with more than one in so many of all documents: there are fewer such hosts than that.
HOT_SHARE = 256


def hot_hosts(hosts: DataFrame) -> DataFrame:
    """``__cf_hot``: hosts with more than 1 / :data:`HOT_SHARE` of all documents."""
    total = hosts.agg(F.sum("host_docs").alias("__cf_total"))
    return hosts.join(F.broadcast(total), F.col("host_docs") * HOT_SHARE > F.col("__cf_total")) \
        .select(F.col("__cf_host").alias("__cf_hot"))


def _with_salts(hosts: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """``hosts`` with ``__cf_salt``: one row a host, and ``salts`` rows a hot one."""
    # fewer than HOT_SHARE rows, whatever the input: a proven bound for the broadcast
    last = F.when(F.col("__cf_hot").isNotNull(), F.lit(salts - 1)).otherwise(F.lit(0)).cast("bigint")
    return hosts.join(F.broadcast(hot), F.col("__cf_host") == F.col("__cf_hot"), "left") \
        .withColumn("__cf_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("__cf_hot")


def _salted(rows: DataFrame, hot: DataFrame, host_col: str, salts: int, *spread: str) -> DataFrame:
    """Documents with ``__cf_doc_salt``; ``spread`` columns choose it for those of hot hosts, all others have 0."""
    salt = F.when(F.col("__cf_hot").isNotNull(), F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(F.lit(0))
    return rows.join(F.broadcast(hot), F.col(host_col) == F.col("__cf_hot"), "left") \
        .withColumn("__cf_doc_salt", salt.cast("bigint"))


def _meets(host_col: str) -> Column:
    return (F.col(host_col) == F.col("__cf_host")) & (F.col("__cf_doc_salt") == F.col("__cf_salt"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  max_rate: float = 0.5, salts: int = 64) -> DataFrame:
    """One row per input row: the id as ``doc_id``, the measures, ``base_failed``,
    ``kept``, ``host_rate`` and ``host_rejected``.

    Defined cases: a null text has no words and fails; a row without a host is
    judged by its text alone (``host_rate`` null); rows that repeat are judged
    each; an empty table gives an empty result; other columns are not looked at."""
    rows = with_base_rules(docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                                       F.col(text_col).alias("text")))
    rows = materialise(rows.select("doc_id", "host", "__cf_m.*"), "quality-measures")
    hosts = materialise(host_verdicts(rows, "host", F.col("base_failed"), max_rate), "hosts")
    hot = hot_hosts(hosts)
    rows = _salted(rows, hot, "host", salts, "doc_id", "n_words", "word_chars")
    salted = materialise(_with_salts(hosts, hot, salts), "salted-hosts")
    return rows.join(salted, _meets("host"), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce("host_rejected", F.lit(False))).alias("kept"),
        "host_rate", F.coalesce("host_rejected", F.lit(False)).alias("host_rejected"))


@own_names_aside
def drop_low_quality(docs: DataFrame, text_col: str = "text", host_col: str = "source",
                     max_rate: float = 0.5, salts: int = 64) -> DataFrame:
    """The rows of ``docs`` that pass their own rules and their host's, all
    columns as they were.  Cases as in :func:`quality_rules`."""
    rows = with_base_rules(docs, text_col)
    rows = materialise(rows.select(*docs.columns, F.col("__cf_m.base_failed").alias("__cf_failed")), "quality-rows")
    hosts = materialise(host_verdicts(rows, host_col, F.col("__cf_failed"), max_rate), "hosts")
    hot = hot_hosts(hosts)
    # written first: its size is known to the join, so documents need no shuffle where it is small
    rejected = materialise(_with_salts(hosts.where("host_rejected").select("__cf_host"), hot, salts), "rejected-hosts")
    return _salted(rows.where(~F.col("__cf_failed")), hot, host_col, salts, text_col) \
        .join(rejected, _meets(host_col), "left_anti").select(*docs.columns)
