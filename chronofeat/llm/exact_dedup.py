"""Exact dedup with a heavy-hitter split.

A frequent-items sketch (``approx_top_k``: the Misra-Gries family, partial on
every task) names the digests that may be frequent.  Their groups are counted
exactly; the at most ``heavy`` verified winners are broadcast, and rows of
those groups are settled on the map side.  All other digests go through an
ordinary shuffle, in which no group can hold more than about
``rows / tracked`` rows.  The sketch only decides the way a group takes, never
the result.
"""

from __future__ import annotations

from typing import Tuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialise, own_names_aside, text_or_empty


def text_digest(text_col: str):
    """SHA-256 (lowercase hex) of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(ascii_lower(text_or_empty(text_col)).cast("binary"), 256)


def frequent_digests(digests: DataFrame, heavy: int, tracked: int) -> DataFrame:
    """The verified winners: ``(text_sha256, keep_id, group_size)`` of at most
    ``heavy`` digests, with exact sizes; digests that occur once are left out."""
    named = digests.agg(F.expr(f"approx_top_k(text_sha256, {int(heavy)}, {int(tracked)})").alias("__cf_top")) \
        .select(F.explode("__cf_top").alias("__cf_top")) \
        .select(F.col("__cf_top.item").alias("text_sha256"))
    # at most `heavy` rows, whatever the input: a proven bound for the broadcast
    return digests.join(F.broadcast(named), "text_sha256") \
        .groupBy("text_sha256") \
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")) \
        .where("group_size > 1")


def split_groups(docs: DataFrame, id_col: str, text_col: str, heavy: int,
                 tracked: int) -> Tuple[DataFrame, DataFrame, DataFrame]:
    """(digest of every row, winners, groups of the remaining digests)."""
    digests = materialise(docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256")),
                          "digests")
    winners = materialise(frequent_digests(digests, heavy, tracked), "heavy-digests")
    rest = digests.join(F.broadcast(winners), "text_sha256", "left_anti") \
        .groupBy("text_sha256") \
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return digests, winners, rest


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                heavy: int = 256, tracked: int = 4096) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z only.  Of equal
    texts the one with the largest id stays.

    Defined cases: null text counts as empty; a null id ranks below every id
    (a group of null ids only has ``keep_id`` null and all its rows kept);
    rows that repeat an id and its text count in ``group_size`` and are marked
    alike (:func:`drop_exact_duplicates` leaves one of them); an empty table
    gives an empty result; other columns are not looked at."""
    digests, winners, rest = split_groups(docs, id_col, text_col, heavy, tracked)
    settled = digests.join(F.broadcast(winners), "text_sha256")
    shuffled = digests.join(F.broadcast(winners), "text_sha256", "left_anti").join(rest, "text_sha256")
    return settled.unionByName(shuffled).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


@own_names_aside
def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          heavy: int = 256, tracked: int = 4096) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were: one per group.

    Copies of a winner go before any shuffle; only then do rows meet by
    digest.  Cases as in :func:`exact_dedup`; of rows that repeat the kept id
    and its text one stays."""
    digests, winners, rest = split_groups(docs, id_col, text_col, heavy, tracked)
    keepers = rest.select("text_sha256", "keep_id").unionByName(winners.select("text_sha256", "keep_id"))
    keepers = keepers.select(F.col("text_sha256").alias("__cf_digest"), F.col("keep_id").alias("__cf_keep"))
    heavy_keep = winners.select(F.col("text_sha256").alias("__cf_digest"), F.col("keep_id").alias("__cf_heavy"),
                                F.lit(True).alias("__cf_won"))
    rows = docs.withColumn("__cf_digest", text_digest(text_col)) \
        .join(F.broadcast(heavy_keep), "__cf_digest", "left") \
        .where(F.col("__cf_won").isNull() | F.col(id_col).eqNullSafe(F.col("__cf_heavy")))
    return rows.join(keepers, "__cf_digest") \
        .where(F.col(id_col).eqNullSafe(F.col("__cf_keep"))) \
        .dropDuplicates(["__cf_digest"]).select(*docs.columns)
