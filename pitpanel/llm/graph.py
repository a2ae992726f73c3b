"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.text import stored


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of the edges ``a, b`` (longs); root: the smallest vertex of a contracted tree, one per component.

    Each round points every vertex to the smallest of itself and its neighbours (an aggregate that combines before the
    shuffle, so a vertex with many edges is no hot task), contracts the edges and goes on with what is left; random
    vertex numbers shrink the graph by a constant factor a round.  An empty edge table gives no rows.
    """
    left = stored(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    roots = None
    while not left.isEmpty():
        step = stored(left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("v")).agg(F.min("b").alias("n")).select("v", F.least("v", "n").alias("to")), "pointers")
        if roots is None:
            roots = step.select("v", F.col("to").alias("root"))
        else:
            roots = stored(roots.join(step, roots.root == step.v, "left").select(roots.v, F.coalesce("to", "root").alias("root")), "roots")
        ends = left.join(step.select(F.col("v").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("v").alias("b"), F.col("to").alias("y")), "b")
        left = stored(ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    return roots if roots is not None else left.select(F.col("a").alias("v"), F.col("b").alias("root"))
