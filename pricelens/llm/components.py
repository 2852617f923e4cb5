"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import stored


def _star(edges: DataFrame) -> DataFrame:
    """Both directions of the edges with the smallest of the source's closed neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node of each connected part of ``edges`` (a, b long).

    Large-star and small-star steps alternate until the edges are stars; every
    round is written to spark.checkpoint.dir, and only a count and a hash reach
    the driver.  The number of rounds grows with the log of the longest path.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if seen == mark or not mark.n:
            break
        seen = mark
        large = _star(edges).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: a node's smaller neighbours and itself go to the smallest of them
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        edges = stored(small, name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
