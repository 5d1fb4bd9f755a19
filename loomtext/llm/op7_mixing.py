"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words; a target stops at
MOST times its source's words and the excess is reshared by weight until none is above. Inside a source a document's
expected copies are its source's ratio target / words, tilted by `spread` towards longer documents so that they still
add up to the target: copies = ratio * (1 + tilt), tilt in [-spread, spread] and 0 on average over words. The whole
part of these is certain; the rest is an inclusion probability p, and documents are ranked by Pareto order,
(u / (1 - u)) / (p / (1 - p)), u a hash of seed and doc_id. The sample has a fixed size in words: documents are
taken in rank order until the words that the whole copies leave of the target are reached, and the last one is cut
to fit, so a source's taken words equal its rounded target.

The ranks are never sorted in one task: words are summed in BINS intervals of the rank, the interval that holds the
boundary is parted again, and only its documents are put in order.

Defined cases: null or blank texts have size 0 and take 0; rows that repeat a doc_id are ranked apart by their
texts' hashes, and of wholly equal rows any may be the one that is cut; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ._common import saved

WEIGHTS, MOST, SPREAD_PER_MILLE, BINS, SEED = (1, 2, 3), 3, 250, 4096, "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of each source.

    Water-filling: a source's share of the free words is w * (T - capped) / (free weight); sources fill up in the
    order of MOST * size / w, so the capped ones are a prefix of that order. One row a source is sorted, no more."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    per = per.withColumn("weight", F.element_at(weights, ((rank - 1) % len(WEIGHTS) + 1).cast("int")))
    fill = Window.orderBy((F.lit(MOST) * F.col("source_size")) / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(every))
        .withColumn("filled", F.coalesce(F.sum(F.lit(MOST) * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("free", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("filled")) / F.col("free"))
        .withColumn("place", F.row_number().over(fill))
    )
    fits = F.col("level") * F.col("weight") <= F.lit(MOST) * F.col("source_size")
    per = per.withColumn("first", F.min(F.when(fits, F.struct("place", "level"))).over(every))
    capped = F.coalesce(F.col("place") < F.col("first.place"), F.lit(True))
    return per.select("source", "source_size", F.when(capped, (F.lit(MOST) * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.col("first.level")).alias("target"))


def mix_sources(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, text_key, source, size, source_size, target, copies (whole), taken (words, repeats counted)."""
    sizes = saved(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text").cast("string")).alias("size"), F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("draw"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
        .withColumn("tilt_size", F.expr("1000 * size div (size + 500)")),
        "sizes",
    )
    goal = targets(sizes)
    # the tilt's mean over words and its largest distance from it, exact in integers until the division
    tilt = sizes.groupBy("source").agg((F.sum(F.col("tilt_size") * F.col("size")) / F.greatest(F.sum("size"), F.lit(1))).alias("mean"), F.min("tilt_size").alias("lo"), F.max("tilt_size").alias("hi"))
    same = F.col("s").eqNullSafe(F.col("source"))
    per = goal.join(tilt.withColumnRenamed("source", "s"), same).drop("s")
    per = per.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    per = per.withColumn("span", F.greatest(F.col("hi") - F.col("mean"), F.col("mean") - F.col("lo"), F.lit(1.0)))
    room = F.when(F.col("ratio") > 0, F.greatest(F.lit(0.0), F.lit(float(MOST)) / F.col("ratio") - 1)).otherwise(0.0)
    per = per.withColumn("tilt", F.least(F.lit(SPREAD_PER_MILLE / 1000), room) / F.col("span")).withColumnRenamed("source", "s")
    expected = sizes.join(per, same, "left").drop("s").withColumn("expected", F.col("ratio") * (1 + F.col("tilt") * (F.col("tilt_size") - F.col("mean"))))
    copies = F.least(F.lit(MOST), F.floor("expected")).cast("long")
    p = F.col("expected") - F.col("copies")
    u = (F.conv(F.substring("draw", 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    odds = u / (1 - u) / (p / (1 - p))
    ranked = saved(
        expected.withColumn("copies", copies).withColumn("rank", F.when((p > 0) & (F.col("copies") < MOST) & (F.col("size") > 0), odds / (1 + odds)))
        .select("doc_id", "source", "size", "source_size", "target", "copies", "rank", "text_key"),
        "ranked",
    )
    left = ranked.groupBy("source").agg((F.round(F.max("target")).cast("long") - F.sum(F.col("copies") * F.col("size"))).alias("need"))
    edge = _boundary(ranked, left)
    out = ranked.join(edge.withColumnRenamed("source", "s"), same, "left").drop("s")
    inside = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    last = out.where(inside)
    run = Window.partitionBy("source").orderBy("rank", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("need") - F.coalesce(F.sum("size").over(run), F.lit(0)))))
    rest = out.where(~F.coalesce(inside, F.lit(False))).withColumn("extra", F.when(F.col("rank") < F.col("low"), F.col("size")).otherwise(0))
    both = rest.unionByName(last)
    return both.select("doc_id", "text_key", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size") + F.col("extra")).cast("long").alias("taken"))


def _boundary(ranked: DataFrame, left: DataFrame) -> DataFrame:
    """source, low, high, need: the interval of ranks in which each source's sample ends, and the words to take from it.

    Two rounds of BINS intervals; a source's sums are BINS rows at most."""
    edge = left.select("source", F.lit(0.0).alias("low"), F.lit(1.0).alias("width"), F.greatest("need", F.lit(0)).alias("need"))
    for _ in range(2):
        e = edge.withColumnRenamed("source", "s")
        bins = ranked.where("rank is not null").join(e, F.col("s").eqNullSafe(F.col("source"))).drop("s")
        bins = bins.withColumn("bin", F.floor((F.col("rank") - F.col("low")) / F.col("width") * BINS)).where(f"bin >= 0 and bin < {BINS}")
        sums = bins.groupBy("source", "low", "width", "need", "bin").agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("upto", F.sum("words").over(run)).withColumn("last", F.max("upto").over(Window.partitionBy("source")))
        hit = sums.where("upto >= need or upto = last").groupBy("source").agg(F.min_by(F.struct("low", "width", "need", "bin", "words", "upto"), "bin").alias("x"))
        edge = saved(hit.select("source", (F.col("x.low") + F.col("x.bin") * F.col("x.width") / BINS).alias("low"), (F.col("x.width") / BINS).alias("width"), (F.col("x.need") - F.col("x.upto") + F.col("x.words")).alias("need")), "edge")
    return edge.select("source", "low", (F.col("low") + F.col("width")).alias("high"), "need")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
