"""Connected components of a link table, by repeated contraction.

In every round each node moves to the least node next to it; edges follow, and those inside one
node vanish. Rounds end when no edge is left, after about the logarithm of the longest path. All
of it is joins and counts of distributed tables; nothing is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgrid.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); equal labels mean connected."""
    edges = stored(edges.select("a", "b").filter("a != b").distinct(), "edges")
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        moves = stored(least.select("node", F.least("node", "b").alias("label")), "moves")
        steps.append(moves)
        at_a = edges.join(moves.select(F.col("node").alias("a"), F.col("label").alias("to_a")), "a")
        at_b = at_a.join(moves.select(F.col("node").alias("b"), F.col("label").alias("to_b")), "b")
        moved = at_b.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).filter("a != b").distinct()
        edges = stored(moved, "edges")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = steps[0]
    for moves in steps[1:]:
        onward = moves.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = labels.join(onward, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return stored(labels, "labels")
