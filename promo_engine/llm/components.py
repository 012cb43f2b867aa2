"""Connected components of an edge table, by alternating large-star and
small-star steps.  Every step is a grouped minimum and a join; the edges are
written to the shared checkpoint folder between steps, and only a count
reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promo_engine.llm import common as C


def _star(pairs: DataFrame) -> DataFrame:
    """Each directed pair (a, b) with the least of a and all its b, as m."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return pairs.join(C.cut_lineage(least, "least"), "a")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b: bigint); the root is the component's least node."""
    now = C.cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_star(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = C.cut_lineage(large.where("a <> b"), "large-star")
        star = _star(large)
        small = (star.select("a", F.col("m").alias("b")).unionByName(star.select(F.col("b").alias("a"), F.col("m").alias("b")))
                 .where("a <> b").distinct())
        small = C.cut_lineage(small, "small-star")
        # done when every node points at a root that points nowhere, and each node has one root
        n, nodes = small.agg(F.count(F.lit(1)), F.countDistinct("a")).first()
        hanging = small.select("b").distinct().join(small.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if n == nodes and hanging.isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                small.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = small
