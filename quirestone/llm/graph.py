"""Connected components by alternating large-star and small-star steps, all in DataFrames.

Each round is written to the shared folder; only a count of changed edges comes to the driver. The
number of rounds grows with the logarithm of the longest path. A vertex with very many neighbours is
harmless: the minimum per vertex is a partial aggregate, joined back, never a collected list.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a > b). Large star links larger neighbours of each vertex to its least one; small star the rest."""
    if large:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    # written out, so that both sides of the join are plain exchanges and a crowded vertex can be split
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "least")
    linked = both.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs, any direction; gives (node, component) for nodes that are on an edge."""
    spark = edges.sparkSession
    start = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(start, "edges")
    if not now.head(1):
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(most_rounds):
        after = materialize(_star(_star(now, True), False), "edges")
        n = after.count()
        same = n == now.count() and not after.join(now, ["a", "b"], "left_anti").head(1)
        forget(spark, now)
        now = after
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def forest(links: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what a boolean matrix of links connects."""
    rows, cols = np.flatnonzero(links.any(1)), np.flatnonzero(links.any(0))
    if not len(rows):
        return []
    m = links[np.ix_(rows, cols)]
    la, lb, big = a[rows].copy(), b[cols].copy(), np.iinfo(np.int64).max
    while True:
        to_b = np.minimum(lb, np.where(m, la[:, None], big).min(0))
        to_a = np.minimum(la, np.where(m, to_b[None], big).min(1))
        if (to_b == lb).all() and (to_a == la).all():
            break
        la, lb = to_a, to_b
    return [(x, y) for x, y in zip(a[rows], la) if x != y] + [(x, y) for x, y in zip(b[cols], lb) if x != y]
