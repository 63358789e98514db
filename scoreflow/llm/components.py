"""Connected components of an edge table by hooking and pointer jumping. No
link or label reaches the driver; each round is written to the scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreflow.llm.common import discard, stored

# Rows of one file of the tables between rounds.
FILE_ROWS = 1_000_000


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, comp) for every node of the edges (a, b), which are at most
    `rows` if given: comp is the smallest node that a path reaches. Each round
    every component hooks to its smallest neighbour, pointers are followed to
    their end, and the edges shrink to those between components; a round at
    least halves the components that still have an edge. A round's tables go
    when the next one has its own."""
    left = edges.where("a <> b").select("a", "b").distinct()
    left = stored(left if rows is None else left.coalesce(1 + rows // FILE_ROWS), "edges")
    n = left.count()

    def kept(df: DataFrame, name: str) -> DataFrame:
        """As many files as the edges left ask for."""
        return stored(df.coalesce(1 + 2 * n // FILE_ROWS), name)

    labels = kept(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("comp", F.col("node")), "labels")
    nodes = n
    while n:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        step = kept(hook.select("node", F.least("node", "m").alias("parent")), "parents")
        while True:
            parents = step.select("node", "parent")
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            jumped = kept(
                parents.join(up, "parent").select("node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")),
                "parents",
            )
            discard(step)
            step = jumped
            if jumped.where("moved").isEmpty():
                break
        parents = step.select("node", "parent")
        moved = parents.select(F.col("node").alias("comp"), "parent")
        relabelled = labels.join(moved, "comp", "left").select("node", F.coalesce("parent", "comp").alias("comp"))
        next_labels = stored(relabelled.coalesce(1 + 2 * nodes // FILE_ROWS), "labels")
        to = {side: parents.select(F.col("node").alias(side), F.col("parent").alias(f"p{side}")) for side in "ab"}
        next_left = kept(
            left.join(to["a"], "a").join(to["b"], "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(),
            "edges",
        )
        discard(labels, left, step)
        labels, left = next_labels, next_left
        n = left.count()
    discard(left)
    return labels
