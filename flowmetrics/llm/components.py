"""Connected components of a graph as DataFrame operations, cut by written tables.

Alternating stars: in one half of a round every node hands its larger neighbours to its smallest
one, in the other its smaller neighbours (and itself). Both keep components whole and flatten them
until every node hangs on the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmetrics.sources.scratch import discard, scratch_path, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Edges go from the larger node ``u`` to the smaller ``v``."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # The smallest of a node's neighbours and itself; only larger neighbours move.
    found = both.where("v > u").join(least, "u")
    down = found.select(F.col("v").alias("u"), F.least("m", F.col("u")).alias("v"))
    return down


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component``, the smallest node of its component, for every node of ``edges``.

    ``edges`` has columns ``u`` and ``v`` of one type that can be ordered; direction, loops,
    repeats and NULL ends do not matter, and nodes with loops alone are left out. Each half round
    sums before it shuffles and joins on a key one side of which is unique, so a node with most of
    the edges is split by Spark's skew handling. Rounds grow with the logarithm of the size.
    """
    spark = edges.sparkSession
    ordered = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    path = scratch_path(spark, "components")
    now = written(ordered.distinct(), path, tidy=True)
    before = None
    for _ in range(most_rounds):
        # The sum tells two edge lists apart; a list that did not change is a forest of stars.
        state = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if not state[0] or tuple(state) == before:
            break
        before = tuple(state)
        last, path = path, scratch_path(spark, "components")
        now = written(_small_star(_large_star(now)), path, tidy=True)
        discard(spark, last)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
