"""Connected components by alternating star contraction, as Spark joins with a written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openbell.session import materialize


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b of one orderable type); root is the smallest node.

    Every round points neighbours at the smallest node seen (large star, then small star), so the number of rows
    never grows and long chains halve. It ends when a round changes nothing. A hub is one row on the side of the
    minima, so Spark may split its other side.
    """
    now = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), purpose
    )
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, purpose)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(moved.unionByName(least.withColumnRenamed("m", "v")).distinct(), purpose)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
