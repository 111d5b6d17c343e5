"""Connected components of a link table by min-label propagation with pointer jumping, all as
joins; only a changed-row count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(``node``, ``label``): the smallest node reachable over ``links`` (``a``, ``b``). Nodes
    without a link do not appear.

    Each round turns the links into a star per neighbourhood (large-star, small-star), so the
    number of rounds is logarithmic in the size of a component. A hot node's links are reduced to
    one minimum map-side and met again by a join that Spark can split.
    """
    edges = staged(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "cc")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("_low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("_low").alias("b")).distinct()
        large = staged(spark, large, "cc")
        down = large.groupBy("a").agg(F.min("b").alias("_low"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("_low").alias("b"))
                 .unionByName(down.select("a", F.col("_low").alias("b")))
                 .filter("a <> b").distinct())
        small = staged(spark, small, "cc")
        moved = small.join(edges, ["a", "b"], "left_anti").limit(1).count() or \
            edges.join(small, ["a", "b"], "left_anti").limit(1).count()
        edges = small
        if not moved:
            break
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))
