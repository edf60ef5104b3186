"""Connected components of a graph given as pairs of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.sources.tables import materialized

MAX_ROUNDS = 100


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of its neighbourhood."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("least")
    )
    return (
        both.join(least, F.col("a") == F.col("node"))
        .filter("b > a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    moved = (
        down.join(least, F.col("a") == F.col("node"))
        .filter("b != least")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    return moved.unionByName(
        least.select(F.col("node").alias("a"), F.col("least").alias("b"))
    ).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link to another; root is the least node.

    ``pairs`` has two columns of one integer type. Alternates two grouped steps, each
    linking to a group's minimum, until nothing changes: a number of rounds that grows
    with the logarithm of the nodes. Only minima are grouped, no neighbour lists, so a
    node with very many links is no large row; each round is stored in the shared folder.
    """
    a, b = pairs.columns
    current = materialized(
        pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct(), "pairs"
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == seen or not state[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        current = materialized(_small_star(_large_star(current)), "pairs")
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
