"""Connected components of an edge table, by joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (columns ``a, b``, long):
    the smallest node id that links reach.

    Alternates large-star steps (a node's larger neighbours move to its
    smallest one) and small-star steps (its smaller neighbours do) until the
    edges stay as they are; the number of rounds follows the logarithm of
    the longest path.  Each round is written to the shared folder; only two
    numbers reach the driver.  A hub's smallest neighbour is a partial
    aggregate, and it meets the hub's edges in a join Spark can split."""
    # a > b throughout
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "links")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")) \
            .select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        moved = large.join(least, large["a"] == least["u"]).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = materialise(moved.where("a <> b").distinct(), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    # every component is now a star around its smallest node
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
