"""Quality rules with risk-controlled cutoffs.

Each text gets counts, a base verdict and a badness: the largest, in thousandths of its words, of its symbols and
exclamation marks, its words in repeated 8-word windows, its capital words, its words equal to the word before and its
repeated lines. The labelled
documents of quality 1 are a holdout for each stratum (language): badness is not fitted, so all of them serve. From
the mildest cutoff down, the hypothesis "rejecting above this cutoff rejects more than `risk` of the good documents"
is tested with the exact binomial tail P(Bin(n, risk) <= rejected); the first that stands ends the walk (fixed-sequence
testing) and the level is divided by the number of strata (Bonferroni). So with probability 1 - `level` no certified
cutoff loses more than `risk` of its stratum's good documents, whichever is chosen: the mildest that still rejects
`worth` of the bad labelled documents that the strictest certified one does, so the allowance is not spent on good
documents for nothing. A stratum with too few labels certifies no cutoff and rejects by the base rule only.

Defined cases: null text has no words and fails the base rule; null lang is a stratum of its own; a doc_id labelled
more than once counts once, as good only if all its labels say so; rows that repeat a doc_id are judged each, and are
one document of the holdout, with the worst badness among them. The promise is about the cutoffs: good documents that
the base rule rejects are outside of it, and those of them are not in the holdout.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._common import as_batch, documents, saved
from ._words import U, grams, hashes, mix, pieces, words

#: Most share of good documents that a stratum may lose, and the chance that any stratum loses more.
RISK, LEVEL, WORTH = 0.02, 0.05, 0.99
#: Cutoffs tried are multiples of STEP thousandths.
STEP, TOP = 25, 1000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouts", "n_capital_words", "n_stutters"]
SCHEMA = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("stratum", pa.string()), *((c, pa.int64()) for c in COUNTS)])
_SYMBOL, _SHOUT, _LETTER, _CAPITAL = (np.zeros(256, bool) for _ in range(4))
_SYMBOL[list(b"#*$%&|<>")] = True
_SHOUT[ord("!")] = True
_CAPITAL[65:91] = True
BLANK = b" \t\r\x0b\x0c"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ids, keys, strata = (batch.column(c) for c in ("text", "doc_id", "text_key", "stratum"))
        for p in pieces(texts):
            w = words(p)
            h = hashes(p, w)
            n = p.hi - p.lo

            def summed(per_byte: np.ndarray) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(per_byte)])
                return total[p.at[1:]] - total[p.at[:-1]]

            points = np.concatenate([[0], np.cumsum((p.data & 0xC0) != 0x80)])
            of_word = np.concatenate([[0], np.cumsum(points[w.end] - points[w.start])])
            capitals = np.concatenate([[0], np.cumsum(_CAPITAL[p.data])])
            capital = np.concatenate([[0], np.cumsum(capitals[w.end] - capitals[w.start] >= 2)])
            stutter = np.zeros(len(h) + 1, np.int64)
            stutter[2:] = np.cumsum((h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])) if len(h) > 1 else 0
            repeat = np.zeros(len(h) + 1, np.int32)
            g = grams(h, 8)
            if len(g):
                at = np.flatnonzero(w.doc[: len(g)] == w.doc[7:])
                with np.errstate(over="ignore"):
                    key = mix(g[at] + w.doc[at].astype(U) * U(0x9E3779B97F4A7C15))
                order = np.argsort(key)
                same = key[order][1:] == key[order][:-1]
                hit = np.zeros(len(at), bool)
                hit[order[1:][same]] = hit[order[:-1][same]] = True
                np.add.at(repeat, at[hit], 1)
                np.add.at(repeat, at[hit] + 8, -1)
            repeat = np.concatenate([[0], np.cumsum(np.cumsum(repeat[:-1]) > 0)])
            lines = []
            for text in texts.slice(p.lo, n):
                seen, twice = set(), 0
                for line in (text.as_py() or "").split("\n"):
                    if line in seen:
                        twice += 1
                    elif line.encode().strip(BLANK):
                        seen.add(line)
                lines.append(twice)
            a, b = w.first[:-1], w.first[1:]
            yield as_batch(SCHEMA, ids.slice(p.lo, n), keys.slice(p.lo, n), strata.slice(p.lo, n), b - a, of_word[b] - of_word[a], summed(_SYMBOL[p.data]), lines, repeat[b] - repeat[a], summed(_SHOUT[p.data]), capital[b] - capital[a], stutter[b] - stutter[a])


def counts(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, text_key, stratum, the counts, base_failed and badness of each text."""
    rows = documents(docs, F.col(stratum).cast("string").alias("stratum"))
    share = lambda c: F.floor(F.lit(TOP) * F.col(c) / F.greatest(F.col("n_words"), F.lit(1)))
    return (
        rows.mapInArrow(_counts, "doc_id long, text_key long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS))
        .withColumn("base_failed", F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words"))
        .withColumn("badness", F.least(F.lit(TOP), F.greatest(F.floor(F.lit(TOP) * (F.col("n_symbols") + F.col("n_shouts")) / F.greatest(F.col("n_words"), F.lit(1))), share("n_repeat_words"), share("n_capital_words"), share("n_stutters"), share("n_dup_lines"))))
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k)."""
    return min(1.0, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p)) for i in range(k + 1))) if n else 1.0


def cutoffs(rated: DataFrame, labels: DataFrame, risk: float = RISK, level: float = LEVEL, worth: float = WORTH) -> DataFrame:
    """stratum, cutoff: documents whose badness is above the cutoff may go."""
    own = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")).where("quality is not null")
    first = rated.where("not base_failed").groupBy("doc_id").agg(F.max("badness").alias("badness"), F.min("stratum").alias("stratum"))
    bins = first.join(own, "doc_id").groupBy("stratum", "quality", F.floor(F.col("badness") / STEP).cast("int").alias("bin")).count()
    n_strata = rated.select("stratum").distinct().count()

    def walk(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        good, bad = ({int(b): int(n) for b, n in zip(t["bin"], t["count"])} for t in (table[table["quality"] == 1], table[table["quality"] != 1]))
        n, lost, caught, certified = sum(good.values()), 0, 0, []
        for b in range(TOP // STEP, 0, -1):  # reject badness >= b * STEP
            lost, caught = lost + good.get(b, 0), caught + bad.get(b, 0)
            if binomial_tail(lost, n, risk) > level / max(1, n_strata):
                break
            certified.append((b * STEP - 1, caught))
        best = next((c for c, k in certified if k >= worth * certified[-1][1]), None)
        return pd.DataFrame({"stratum": [key[0]], "cutoff": pd.array([best], "Int64")})

    return bins.groupBy("stratum").applyInPandas(walk, "stratum string, cutoff long")


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, level: float = LEVEL) -> DataFrame:
    """The counts of each document, base_failed, badness, its stratum's cutoff and kept."""
    rated = saved(counts(docs, stratum), "quality").withColumn("stratum", F.coalesce("stratum", F.lit("\0null")))
    cuts = cutoffs(rated, labels, risk, level)
    return rated.join(cuts, "stratum", "left").withColumn("kept", F.expr("not base_failed and badness <= coalesce(cutoff, 1000)"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "badness")
