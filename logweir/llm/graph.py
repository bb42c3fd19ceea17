"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import written


def _flipped(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(
        edges.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest neighbour (itself included)."""
    both = _flipped(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge that isn't itself a root; root is the component's smallest node.

    ``edges`` has two columns of one type.  Self edges and edges with a null end are ignored.  Each round is two
    aggregates merged on the map side and two joins; a hub's many edges meet only its minimum, so a large
    component is never gathered in one task.  The rounds grow with the logarithm of the component size.
    """
    left, right = edges.columns
    current = written(
        edges.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo"))
        .distinct()
    )
    seen = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = state
        current = written(_small_star(_large_star(current)))
