"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges by edges to smaller nodes; the number of rounds grows with the logarithm of the
longest chain.  Every step is a grouped minimum, combined before its shuffle, and an equi-join that adaptive execution may split
where one node has many edges.  An edge is turned round in its own row, so a round reads its table no more often than it needs: every scan and stage costs the
driver memory until it is collected.  The driver sees one boolean a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import dropped, written


def _toward(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Edges with m: the smallest of the node and its neighbours."""
    least = edges.groupBy(F.col(node).alias("n")).agg(F.min(other).alias("m"))
    return edges.join(least.select("n", F.least("n", "m").alias("m")), F.col(node) == F.col("n")).drop("n")


def _ways(edges: DataFrame) -> DataFrame:
    """Every edge from both its ends."""
    return edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.  Null ends are ignored."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    e = written(e.distinct())
    while True:
        ends = e.select(F.inline(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up")), F.struct(F.col("v").alias("n"), F.lit(0).alias("up")))))
        state = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
        if state.where("ups > 1 or (ups = 1 and low = 0)").isEmpty():
            break
        large = _toward(_ways(e), "u", "v").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _toward(large, "u", "v").select(F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        before, e = e, written(small.where("u != v").distinct())
        dropped(before)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
