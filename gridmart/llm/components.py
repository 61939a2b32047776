"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import settled


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Rounds of two steps until nothing changes: every node's larger neighbours are tied to its
    smallest one, then every node and its smaller neighbours are. The number of rounds grows with the logarithm
    of the longest path. Each round is written to the shared folder, so that a lost executor
    costs one round at most.
    """
    edges = settled(_oriented(edges), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = _oriented(larger)
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a")
        smaller = smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.withColumnRenamed("m", "b"))
        edges = settled(_oriented(smaller), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    inner = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return inner.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first())
