"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._common import saved


#: A node with more than 1/HOT of all edges is hot; as each edge has two ends there are at most 2 * HOT of them.
HOT = 1000


def components(edges: DataFrame) -> DataFrame:
    """id, component (its smallest id) of every id in edges (a long, b long).

    Each round writes the edges to the shared folder, so lineage stays short; rounds grow with the logarithm of the
    longest chain. A node with many neighbours is aggregated to one smallest neighbour before the join, and the smallest
    neighbours of hot nodes are broadcast, so the rows of a large star stay where they are."""
    e = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    old = _print(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count("*").alias("c"))
        large = _with_least(both.where("b > a"), low, old[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("c"))
        joined = _with_least(large, low, old[0])
        small = saved(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "small")
        new = _print(small)
        if new == old:
            break
        e, old = small, new
    star = e.groupBy("a").agg(F.min("b").alias("component"))
    return star.select(F.col("a").alias("id"), "component").unionByName(star.select(F.col("component").alias("id"), "component").distinct())


def _with_least(rows: DataFrame, low: DataFrame, n_edges: int) -> DataFrame:
    """rows (a, b) with m of low (a, m, c); c: how many neighbours a has, of 2 * n_edges in all."""
    hot = F.broadcast(low.where(F.col("c") > n_edges / HOT).select("a", "m"))
    rest = rows.join(hot, "a", "left_anti").join(low.select("a", "m"), "a")
    return rows.join(hot, "a").unionByName(rest)


def _print(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their count and two sums of hashes."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a", F.lit(1)).cast("decimal(38,0)"))).first()
    return tuple(row)
