"""Connected components of a table of links: of a few at once, of more by alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Links that the driver may hold (16 bytes each, and about 200 while it joins them).
FEW = 100_000


def _joined(links: pa.Table) -> pa.Table:
    """(id, component) of links (u, v)."""
    first: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := first.setdefault(x, x)) != x:
            first[x] = first[up]
            x = up
        return x

    for u, v in zip(*(links.column(k).to_pylist() for k in range(2)), strict=True):
        u, v = find(u), find(v)
        first[max(u, v)] = min(u, v)
    return pa.table({"id": pa.array(first, pa.int64()), "component": pa.array([find(x) for x in first], pa.int64())})


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the least node of the neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of every node of the links (a, b); a component is named by its least node. Up to FEW links are
    joined by the driver, which spares it some hundred small stages. Beyond, each round is written, so a lost executor
    costs one round."""
    edges = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct(), "links")
    if 0 < edges.count() <= FEW:
        return links.sparkSession.createDataFrame(_joined(edges.toArrow()), "id long, component long")
    before = None
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
