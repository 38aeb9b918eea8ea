"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickward.llm.common import gathered, spent, stored


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """Edges (u > v) with neighbours moved to the smallest one: of all neighbours of a node, or of the smaller ones."""
    both = edges.select("u", "v")
    if large:
        both = both.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # A column of its own keeps the join from reusing the aggregate's partitioning, so that a hub can be split.
    least = both.groupBy(F.struct("u").alias("_k")).agg(F.min("v").alias("m")).select(F.col("_k.u").alias("_u"), F.least("m", "_k.u").alias("m"))
    least = gathered(least, rows)
    joined = gathered(both.join(least, both["u"] == least["_u"]), rows)
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return gathered(moved.where("u <> v").distinct(), rows)


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of ``edges`` (two columns of longs, any direction).

    Large and small stars alternate until nothing moves; every round is a few joins of the edges, and a star of any
    size takes one round.
    """
    a, b = edges.columns[:2]
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (state["n"], state["x"]) == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before, old = (state["n"], state["x"]), edges
        edges = stored(_star(_star(edges, True, state["n"]), False, state["n"]), "edges")
        spent(old)
