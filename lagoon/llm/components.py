"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagoon.llm.tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest of the node's neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(lowest, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("m"))
    pairs = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return pairs.union(lowest.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def drawn_in(edges: DataFrame) -> DataFrame:
    """Edges (a, b), ``a > b``, of the same components after one round: most nodes of a shallow one hang on its smallest."""
    edges = stored(edges.where("a <> b").distinct())
    return stored(_small_star(_large_star(edges)))


def lowest_known(edges: DataFrame) -> DataFrame:
    """(a, b): per node its smallest neighbour, a name that only nodes of its component can have."""
    return edges.groupBy("a").agg(F.min("b").alias("b"))


def connect(edges: DataFrame) -> DataFrame:
    """(a, b) per linked node ``a`` that is not its component's smallest node ``b``.

    ``edges`` has columns ``a`` and ``b`` of one ordered type, without nulls.
    Every round is stored in the shared folder; the driver sees a count and a
    checksum per round.  Rounds grow with the logarithm of the longest chain.
    """
    edges = stored(edges.where("a <> b").distinct())
    mark = _mark(edges)
    while mark[0]:
        after = stored(_small_star(_large_star(edges)))
        new = _mark(after)
        if new == mark:
            return after
        edges, mark = after, new
    return edges
