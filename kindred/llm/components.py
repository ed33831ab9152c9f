"""Connected components by smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.tables import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Columns node, root: the smallest node of the component of each node that has an edge (a, b).

    Each round hooks every node to its smallest neighbour below it, follows hooks to hooks twice, and
    contracts the edges to what they then connect. Edges within a tree vanish, so few rounds remain large.
    The tables of a round are written and the previous ones dropped. Groupings have a partial step; the
    joins are split by adaptive execution at nodes of high degree.
    """

    def downward(edges: DataFrame) -> DataFrame:
        ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        return scratch.keep(ordered.distinct())

    below = downward(edges)
    nodes = below.select(F.col("a").alias("node")).unionByName(below.select(F.col("b").alias("node"))).distinct()
    roots = scratch.keep(nodes.select("node", F.col("node").alias("root")))
    while below.limit(1).count():
        hooks = below.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        for _ in range(2):
            hooks = scratch.keep(hooks)
            above = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
            hooks = hooks.join(above, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        hooks = scratch.keep(hooks)
        at = {c: hooks.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in ("a", "b", "root")}
        moved = below.join(at["a"], "a").join(at["b"], "b", "left")
        after = downward(moved.select(F.col("a_to").alias("a"), F.coalesce("b_to", "b").alias("b")))
        placed = roots.join(at["root"], "root", "left").select("node", F.coalesce("root_to", "root").alias("root"))
        placed = scratch.keep(placed)
        scratch.drop(below, roots, hooks)
        below, roots = after, placed
    return roots
