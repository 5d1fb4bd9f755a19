"""Row-order operators. A table has no order of its own: each takes the column that gives it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


#: Bytes of a table for each task of text work, at most.
PIECE = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """A table dealt over all cores, in pieces whose size does not grow with the table: a row group of a file is one task.

    For text work that costs far more than the exchange. The size is the optimizer's estimate; results do not depend on it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(4 * cores, -(-size // PIECE)))


def first_of(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The first row of each key (dedup where the first wins)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def last_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key (an index where the last wins)."""
    return first_of(df, keys, F.col(order).desc())


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count; an aggregate, so a hot key is summed before the shuffle."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys of expected that found lacks."""
    return expected.select(key).join(found.select(key), key, "left_anti")


def clean(chapters: DataFrame, text: str, chars: str, order: str, shortest: int = 500, longest: int = 5000) -> DataFrame:
    """Rows of allowed length, the first of each text. Texts are grouped by digest, so none is shuffled for comparison."""
    kept = chapters.where(F.col(chars).between(shortest, longest)).withColumn("_digest", F.sha2(text, 256))
    firsts = kept.groupBy("_digest").agg(F.min(order).alias(order)).drop("_digest")
    return kept.drop("_digest").join(firsts, order, "left_semi")


def tail(df: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows."""
    return df.orderBy(F.col(order).desc()).limit(n)


def worst(metrics: DataFrame, order: str, n: int = 10) -> DataFrame:
    return metrics.orderBy(F.coalesce("hard_gate_pass", F.lit(False)), F.coalesce("char_count", F.lit(0)), order).limit(n)


def preference_top(metrics: DataFrame, order: str, n: int = 20) -> DataFrame:
    failed = metrics.where(F.size("failure_types") > 0)
    return failed.orderBy(F.coalesce("hard_gate_pass", F.lit(True)), F.size("failure_types").desc(), order).limit(n)


def quality_subset(cards: DataFrame, metrics: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """Cards with an outline leak first, then those with any failure, then the rest; stable; none for n <= 0."""
    rows = cards.join(metrics.select(key, "failure_types"), key, "left")
    leak = F.coalesce(F.array_contains("failure_types", "outline_leak"), F.lit(False))
    priority = F.when(leak, 0).when(F.coalesce(F.size("failure_types"), F.lit(0)) > 0, 1).otherwise(2)
    return rows.withColumn("priority", priority).orderBy("priority", order).limit(max(0, n))
