"""Connected components by alternating large and small stars, each round settled by a reliable checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the lowest of its neighbours and itself."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every lower neighbour of a node, and the node, to the lowest of them; ``a`` > ``b`` throughout."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(lowest, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lowest.select("a", F.col("m").alias("b")).union(others)


def components(edges: DataFrame) -> DataFrame:
    """node, root: each node of ``edges`` (a, b; bigint) but the lowest of its component, with that lowest.

    NULL ends and loops are no links. Work per round is bounded by the edges, of
    which there are at most as many as before; a hub's rows meet one row of its
    minimum, a join that adaptive execution splits.
    """
    current = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    state = None
    while True:
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == now or not now["n"]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
        current = staged(_small_star(_large_star(current).distinct()).distinct(), "edges")
