"""Digests of whole tables: the same for any order and partitioning, made on the executors."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..sources.jsonl import canonical_json
from ..sources.store import stored

#: Rows that a leaf of the tree holds on average, at most.
LEAF = 256


def table_digest(df: DataFrame, *columns: str) -> DataFrame:
    """rows, digest: one row.

    A row's digest is the SHA-256 of its canonical JSON. Equal rows are counted, then rows are dealt to leaves by the first
    hex digits of their digests, so many that a leaf holds LEAF of them or fewer on average: the number of digits follows from
    the count alone. A leaf's digest is that of its sorted `digest:count`, a parent's that of its sorted children, up to
    the root. A node has 16 children at most, so no task holds more than a leaf, and the driver gets one row."""
    names = columns or tuple(df.columns)
    own = df.select(F.sha2(canonical_json(F.struct(*names), df.select(*names).schema), 256).alias("d"))
    leaves = stored(own.groupBy("d").agg(F.count("*").alias("n")), "row-digests")
    size = leaves.agg(F.count("*").alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    depth = max(0, math.ceil(math.log(max(1, size.distinct / LEAF), 16) - 1e-9))
    level = leaves.select(F.left("d", F.lit(depth)).alias("at"), F.concat("d", F.lit(":"), F.col("n").cast("string")).alias("x"))
    merged = lambda: F.sha2(F.array_join(F.array_sort(F.collect_list("x")), ","), 256)
    level = level.groupBy("at").agg(merged().alias("d"))
    for d in range(depth - 1, -1, -1):
        level = level.select(F.left("at", F.lit(d)).alias("up"), F.concat("at", F.lit(":"), "d").alias("x")).groupBy("up").agg(merged().alias("d")).withColumnRenamed("up", "at")
    root = level.agg(F.coalesce(F.max("d"), F.sha2(F.lit(""), 256)).alias("digest"))
    return root.select(F.lit(size.rows).cast("long").alias("rows"), "digest")
