"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import staged


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(node, root)`` for every node of the edges ``(a, b)``.

    Each round points a node at the least node among itself and its neighbours and
    contracts the edges along these pointers; node keys are digests, so a round leaves a
    fraction of the edges. The pointers of all rounds, followed in turn, give the root.
    Every round is cut off through the shared folder; nothing is collected.
    """
    edges = staged(_ordered(edges), "edges")
    rounds = []
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        rounds.append(staged(least.select("node", F.least("node", "least").alias("root")), "pointers"))
        left = rounds[-1].select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        right = rounds[-1].select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        moved = edges.join(left, "a").join(right, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        edges = staged(_ordered(moved), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0]
    for pointers in rounds[1:]:
        then = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(then, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found


def _ordered(edges: DataFrame) -> DataFrame:
    pair = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair.distinct()
