"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, benchmark decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Rows are known by doc_id and a hash
of their text, so a verdict on one row that repeats a doc_id leaves the others alone. Rows with a null doc_id pass the
filters, as no verdict can name them, and are mixed like all others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loomtext.llm._common import saved, without
from loomtext.llm.op4_decontamination import decontaminate
from loomtext.llm.op5_quality_rules import quality_rules
from loomtext.llm.op7_mixing import mix_sources
from loomtext.llm.op8_ngram_join import ngram_join
from loomtext.llm.op9_line_dedup import line_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


KEYS = ("doc_id", "text_key")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64("text").alias("text_key"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    rules = quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rejected = saved(rules.where("not kept and doc_id is not null").select(*KEYS).distinct(), "rejected")
    return without(keyed(docs), rejected, KEYS).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document holds are deleted; a document with no word left goes."""
    left = line_dedup(docs, others=("lang", "source"))
    left = left.where("n_removed = 0 or kept rlike '[^ \\\\t\\\\n\\\\r\\\\x0B\\\\f]'")
    return left.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the smallest doc_id; of equal rows one."""
    later = saved(ngram_join(docs).where("not is_first").select(*KEYS).distinct(), "near")
    left = without(keyed(docs), later, KEYS)
    again = saved(left.where("doc_id is not null").select(*KEYS).groupBy(*KEYS).count().where("count > 1").select(*KEYS), "again")
    once = left.join(again, list(KEYS), "left_semi").dropDuplicates(list(KEYS))
    return (without(left, again, KEYS).unionByName(once) if not again.isEmpty() else left).select(COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    leaks = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(keyed(docs), saved(leaks.select(*KEYS).distinct(), "leaking"), KEYS).select(COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their whole copies and words taken."""
    # equal rows, and rows with a null doc_id, are matched one to one
    match = lambda df: df.withColumn("_none", F.col("doc_id").isNull()).withColumn("_id", F.coalesce("doc_id", F.lit(0)))
    run = Window.partitionBy("_id", "_none", "text_key")
    mix = match(mix_sources(docs).select(*KEYS, "copies", "taken")).withColumn("_nth", F.row_number().over(run.orderBy(F.desc("taken")))).where("taken > 0")
    rows = match(keyed(docs)).withColumn("_nth", F.row_number().over(run.orderBy("source", "lang")))
    return rows.join(mix.drop("doc_id"), ["_id", "_none", "text_key", "_nth"]).select(*COLUMNS, "copies", "taken")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mixing", mixing)]
#: SQL cannot state the alignment, the forest and the fingerprints; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}", "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
