"""Connected components over links held as a table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm.common import stored


def _attach_minimum(edges: DataFrame) -> DataFrame:
    """(u, v) with m, the least of u and its neighbours; partial minima before the shuffle, and a join that
    AQE splits where one u has a large part of the rows."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _attach_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge points to the lesser node already, so u's neighbours here are all below u."""
    starred = _attach_minimum(edges)
    return (
        starred.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        .where("u != v")
        .distinct()
    )


def connected_components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the least node that can be reached, for every node of an edge (a, b).

    Edges with a null end or from a node to itself say nothing and are left out. Each round is written to the
    shared folder; the driver sees a count and a checksum. Rounds grow with the logarithm of the longest chain.
    """
    current = stored(
        spark,
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
        .distinct(),
    )
    seen = None
    for _ in range(rounds):
        mark = current.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if mark == seen or not mark.n:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        current = stored(spark, _small_star(_large_star(current)))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def spanning_forest(hits: np.ndarray) -> list[tuple[int, int]]:
    """Row and column numbers of enough of the set cells to connect what all of them connect.

    Rows and columns are the two sides of a bipartite graph. At most rows + columns cells are returned, so a
    dense block of near copies costs its length and not its area.
    """
    label = np.arange(hits.shape[1])
    out = []
    for row in np.flatnonzero(hits.any(axis=1)):
        columns = np.flatnonzero(hits[row])
        roots, first = np.unique(label[columns], return_index=True)
        out += [(int(row), int(c)) for c in columns[first]]
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    return out
