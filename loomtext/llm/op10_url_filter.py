"""URL filters: rules, and logistic regression on hashed character n-grams of host and path. DataFrame functions only.

A rule is (verdict, host, path); it fits its host and all subdomains if the path starts with the rule's, and the
longest that fits decides. Other URLs get the verdict of a logistic regression trained on a small labelled URL table
(url, verdict) of at most TRAIN_ROWS rows, a documented bound; by default these are the pages with the smallest
hashes of page_id among those that a rule decides. Features are the distinct 3- and 4-grams of "^host$" and "path$",
hashed into BUCKETS. Each of ROUNDS steps is one aggregate over the table (a gradient and a diagonal curvature a
bucket); the model is BUCKETS + 1 numbers, a literal in the scoring expression, so scoring is one map over all pages
with no join or shuffle.

Defined cases: a null url or one without "://" has empty host and path, fits no rule, and gets the model's bias
verdict (block above 0.5); with no labelled URLs every other URL is allowed; repeated pages are judged each.
"""

from __future__ import annotations

import json
import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._common import saved

#: Fixed values of the contract: verdict, host, path.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
TRAIN_ROWS, BUCKETS, ROUNDS, RIDGE = 2000, 4096, 20, 1.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), "^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(F.coalesce(rest, F.lit("")), F.length(host) + 1, F.length(url)), "^([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.coalesce(path, F.lit(""))


def by_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):  # longer rules are laid over shorter ones
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def features(host: Column, path: Column) -> Column:
    """Distinct buckets of the n-grams of host and path."""
    of = lambda kind, text, n: F.transform(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)), lambda g: F.pmod(F.xxhash64(F.lit(kind), g), F.lit(BUCKETS)).cast("int"))
    ends = F.concat(F.lit("^"), host, F.lit("$")), F.concat(path, F.lit("$"))
    return F.array_distinct(F.concat(*[of(kind, text, n) for kind, text in zip("hp", ends) for n in (3, 4)]))


def _literal(weights: list[float]) -> Column:
    return F.from_json(F.lit(json.dumps(weights)), "array<double>")


def chance(buckets: Column, weights: list[float]) -> Column:
    """The model's probability of block; weights: one a bucket, then the bias."""
    w = _literal(weights)
    z = F.aggregate(buckets, F.lit(float(weights[-1])), lambda total, b: total + F.element_at(w, b + 1))
    return 1 / (1 + F.exp(-z))


def train(labelled: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """Weights from (url, verdict); labelled has TRAIN_ROWS rows at most."""
    host, path = split_url(F.col("url"))
    table = saved(labelled.select(F.when(F.col("verdict") == "block", 1.0).otherwise(0.0).alias("y"), features(host, path).alias("f")), "labelled")
    weights = [0.0] * (BUCKETS + 1)
    for _ in range(rounds):
        p = chance(F.col("f"), weights)
        each = table.select((F.col("y") - p).alias("slope"), (p * (1 - p)).alias("bend"), F.size("f").alias("n"), F.explode(F.concat("f", F.array(F.lit(BUCKETS)))).alias("b"))
        # a step along each axis alone would overshoot by the number of features that share a row
        for row in each.groupBy("b").agg(F.sum("slope").alias("slope"), F.sum(F.col("bend") * F.sqrt("n")).alias("bend")).collect():
            weights[row.b] += (row.slope - RIDGE * 0.01 * weights[row.b]) / (row.bend + RIDGE)
    return [w if math.isfinite(w) else 0.0 for w in weights]


def url_filter(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block."""
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.withColumn("host", host).withColumn("path", path).withColumn("by_rule", by_rule(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = rows.where("by_rule is not null").select("url", "by_rule.verdict").orderBy(F.xxhash64("page_id", F.lit(11)), "url")
    weights = train(labelled.limit(TRAIN_ROWS))
    scored = rows.withColumn("p_block", chance(features(F.col("host"), F.col("path")), weights))
    by_model = F.when(F.col("p_block") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "by_rule.rule", F.coalesce("by_rule.verdict", by_model).alias("verdict"), "p_block")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
