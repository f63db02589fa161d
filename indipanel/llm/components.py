"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_table


def _smallest_neighbour(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Per node the smallest of itself and its neighbours, as a written table: the joins
    that follow then read plain tables, and a node with very many edges can be split."""
    return kept_table(edges.groupBy(F.col(node).alias("_node")).agg(F.min(other).alias("_least"))
                      .select("_node", F.least("_node", "_least").alias("_least")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _smallest_neighbour(both, "a", "b")
    return (both.filter("b > a").join(least, F.col("a") == F.col("_node"))
            .select(F.col("b").alias("a"), F.col("_least").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = _smallest_neighbour(down, "a", "b")
    smaller = (down.join(least, F.col("a") == F.col("_node"))
               .select(F.col("b").alias("a"), F.col("_least").alias("b")))
    own = least.select(F.col("_node").alias("a"), F.col("_least").alias("b"))
    return smaller.unionByName(own).filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    edges  columns a and b of one ordered type, without nulls; any direction, repeats allowed

    Large and small stars in turn, until nothing changes: the rounds grow with the logarithm
    of the graph, and no component meets in one task. Each round is a written table.
    """
    edges = kept_table(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    seen = _state(edges)
    while seen[0]:
        edges = kept_table(_small_star(kept_table(_large_star(edges), "edges")), "edges")
        state = _state(edges)
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
