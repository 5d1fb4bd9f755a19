"""Style profile of a corpus, in one scan and a handful of aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..profile import ZH, TextProfile


def _spread(value: str):
    """struct(min, max, avg, p50, p90) rounded to 4 places; zeros without values. Percentiles interpolate exactly."""
    zero = lambda c: F.coalesce(F.round(c.cast("double"), 4), F.lit(0.0))
    return F.struct(
        zero(F.min(value)).alias("min"), zero(F.max(value)).alias("max"), zero(F.avg(value)).alias("avg"),
        zero(F.percentile(value, F.lit(0.5))).alias("p50"), zero(F.percentile(value, F.lit(0.9))).alias("p90"),
    )


def profile(rows: DataFrame, text: str, p: TextProfile = ZH) -> DataFrame:
    """One row: counts, spreads of chapter, paragraph, dialogue and sentence sizes, punctuation density, phrase hits."""
    t = F.col(text)
    own = rows.where(T.filled(t)).select(
        T.counted_chars(t, p).alias("chars"), T.dialogue_ratio(t, p).alias("dialogue"), T.paragraph_lengths(t, p).alias("paragraphs"), T.sentence_lengths(t, p).alias("sentences"),
        *[T.count_of(t, m).alias(f"m{i}") for i, m in enumerate(p.punctuation)], *[T.count_of(t, x).alias(f"h{i}") for i, x in enumerate(p.trace_phrases)],
    ).persist()
    chars = F.sum("chars")
    per = lambda hits, k, n: F.coalesce(F.round(F.try_divide(hits * k, chars), n), F.lit(0.0))
    hits = F.map_from_arrays(T.texts(p.trace_phrases), F.array(*[F.coalesce(F.sum(f"h{i}"), F.lit(0)) for i in range(len(p.trace_phrases))]))
    total = sum((F.coalesce(F.sum(f"h{i}"), F.lit(0)) for i in range(len(p.trace_phrases))), F.lit(0))
    base = own.agg(
        F.count("*").alias("chapter_count"), F.coalesce(F.round(F.avg("chars"), 2), F.lit(0.0)).alias("avg_chars"), F.coalesce(F.round(F.avg("dialogue"), 4), F.lit(0.0)).alias("avg_dialogue_ratio"),
        _spread("chars").alias("chars"), _spread("dialogue").alias("dialogue_ratio"),
        F.map_from_arrays(T.texts(p.punctuation), F.array(*[per(F.sum(f"m{i}"), 1, 6) for i in range(len(p.punctuation))])).alias("punctuation_density"),
        F.struct(hits.alias("phrase_hits"), total.alias("total_hits"), per(total, 10000, 4).alias("hits_per_10k_chars")).alias("ai_taste"), F.lit(1).alias("one"),
    )
    paragraphs = own.select(F.explode("paragraphs").alias("n")).agg(F.coalesce(F.round(F.avg("n"), 2), F.lit(0.0)).alias("avg_paragraph_chars"), _spread("n").alias("paragraph_chars"), F.lit(1).alias("one"))
    sentences = own.select(F.explode("sentences").alias("n")).agg(_spread("n").alias("sentence_chars"), F.lit(1).alias("one"))
    counts = rows.agg(F.count("*").alias("total_rows"), F.count_if(T.filled(t)).alias("selected_rows"), F.lit(1).alias("one"))
    counts = counts.select(F.struct("total_rows", "selected_rows", (F.col("total_rows") - F.col("selected_rows")).alias("skipped_rows")).alias("source_filter"), "one")
    return base.join(paragraphs, "one").join(sentences, "one").join(counts, "one").drop("one")  # one row each


def density(rows: DataFrame, key: str, phrases, text: str, p: TextProfile = ZH) -> DataFrame:
    """key, phrase, hits, per_10k: of each key's texts."""
    t = F.col(text)
    sums = rows.groupBy(key).agg(F.sum(T.counted_chars(t, p)).alias("chars"), *[F.sum(T.count_of(t, x)).alias(f"h{i}") for i, x in enumerate(phrases)])
    each = sums.select(key, "chars", F.explode(F.array(*[F.struct(F.lit(x).alias("phrase"), F.col(f"h{i}").alias("hits")) for i, x in enumerate(phrases)])).alias("x"))
    return each.select(key, "x.phrase", "x.hits", F.coalesce(F.round(F.try_divide(F.col("x.hits") * 10000, "chars"), 4), F.lit(0.0)).alias("per_10k"))
