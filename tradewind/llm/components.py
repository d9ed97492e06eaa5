"""Connected components of a graph given as edges, by alternating stars.

Kiveris, Lattanzi, Mirrokni, Rastogi and Vassilvitskii, "Connected components in MapReduce and
beyond", 2014.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.operators.lineage import written


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` can reach.

    A round ties the larger neighbours of every node to its smallest neighbour, then the smaller
    ones, which at least halves long paths, until each component is a star. Edges never become
    more. Minima are aggregated before the shuffle, and meet the edges in equi-joins with frames
    read from checkpoints, which adaptive execution can split where a node has many edges.

    Edges with a NULL end and loops are ignored; an edge may be repeated or given both ways. A
    node without an edge is not in the result.
    """
    ends = edges.select(F.col(left).alias("x"), F.col(right).alias("y")).where("x != y")
    state = written(ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
                    .distinct())
    before, now = None, _digest(state)
    while now != before:
        state = _small_star(_large_star(state))
        before, now = now, _digest(state)
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _digest(state: DataFrame) -> tuple:
    return tuple(state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.bit_xor(F.xxhash64("b", "a"))).first())


def _large_star(state: DataFrame) -> DataFrame:
    both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("least")))
    # Larger neighbours of b are the ends a of its edges.
    return written(state.join(least, F.col("b") == F.col("node"))
                   .select("a", F.col("least").alias("b")).distinct())


def _small_star(state: DataFrame) -> DataFrame:
    least = written(state.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")))
    others = (state.join(least, F.col("a") == F.col("node")).where("b != least")
              .select(F.col("b").alias("a"), F.col("least").alias("b")))
    return written(others.unionByName(
        least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct())
