"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.common import written


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` that is not the smallest of its component.

    Each round hangs the larger neighbours of a node under the smallest, then the smaller ones
    (Kiveris et al.); the number of rounds grows with the logarithm of the longest path. Every
    round is written to the shared folder, and hub nodes are split by the adaptive skew join.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    current = written(edges.where("a != b").select(high.alias("a"), low.alias("b")).distinct(), "edges")
    seen = _print(current)
    while seen[0]:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        met = down.join(lowest, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(met.select("a", F.col("m").alias("b")))
        current = written(small.where("a != b").distinct(), "edges")
        now = _print(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
