"""Connected components of links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of all nodes of ``links(a, b)``.

    Large-star and small-star steps in turn: each node links its larger neighbours, then its smaller ones, to the
    smallest it sees. Both are aggregations with map-side combine, so a node with a great many links is no
    single task's burden, and the number of rounds grows with the logarithm of a component's size.
    """
    edges = cut(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.filter("b > a").join(nearest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a != b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")), "low")
        after = cut(small.toDF("a", "b").filter("a != b").distinct())
        # a star forest: no node is both a leaf and a root, and each leaf has one root
        moved = after.join(after.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        several = after.groupBy("a").count().filter("count > 1").limit(1).count()
        edges = after
        if not moved and not several:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b"), F.col("b")).distinct()
            )
