"""Connected components of a graph of long ids, by alternating large and small stars over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesframe.llm.work import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of `edges` (a, b); loops and repeats do no harm.

    Each round halves the distance to the roots, and the number of edges never grows. The neighbours of a node are
    never gathered: minima are partial aggregates, and come back from written tables, so that adaptive execution may split
    the join at the hub of a star.
    """
    current = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while (now := _state(current)) != before:
        before = now
        both = current.union(current.select("b", "a"))
        least = stage(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stage(large.filter("a <> b"), "edges")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = stage(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = stage(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
    roots = current.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
