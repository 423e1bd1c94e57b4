"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its smallest node.

    Each round lets every node point at its smallest neighbour, follows the pointers two steps further, and contracts the
    edges to the nodes pointed at; a chain shrinks to a quarter, a star to a point. Hot nodes are met by aggregates that
    combine before their exchange and by joins that Spark may split. Rows with a null end, loops and repeats change nothing.
    """
    left = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    steps: list[DataFrame] = []
    while left.take(1):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        step = near
        for _ in range(2):
            ahead = near.select(F.col("node").alias("to"), F.col("to").alias("next"))
            step = step.join(ahead, "to").select("node", F.col("next").alias("to"))
        steps.append(step := stored(step, "pointers"))
        ends = left.join(step.select(F.col("node").alias("a"), F.col("to").alias("c")), "a")
        ends = ends.join(step.select(F.col("node").alias("b"), F.col("to").alias("d")), "b").where("c <> d")
        left = stored(ends.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct(), "edges")
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = steps[0].select("node", F.col("to").alias("component"))
    for step in steps[1:]:
        moved = step.select(F.col("node").alias("component"), F.col("to").alias("next"))
        labels = labels.join(moved, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
    return labels
