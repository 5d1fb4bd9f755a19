"""Substring dedup: a count-min prefilter, then exact grouping of the windows estimated repeated.

Every window of 50 words has an anchor: the least hash of its 26 runs of 25 words. Equal windows have equal
anchors, so the count-min estimate of an anchor's documents is never below that of its windows. Partition sketches
of the anchors (a thirteenth of the windows) are merged by ranges of cells; the second pass emits only windows whose
anchor is estimated to be in two documents or more, and groups those by their hash. No repeated window is lost:
a full sketch passes more windows, never fewer. Exact copies of a text are set aside first, as all their windows
start in the first copy.

Defined cases: null text has no words; a text under 50 words has no window; rows that repeat a doc_id are judged each
on its own text, and neither removes from the other (the same text gets the same result); a null doc_id neither
removes nor is removed from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import _sketch
from ._common import as_batch, copies_of, documents, saved, text_bytes, without
from ._words import U, grams, hashes, mix, pieces, slide_min, words

WINDOW, GRAM = 50, 25
OCCURRENCE = pa.schema([("window", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("pos", pa.int32())])
RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string, kept_sha256 string"


def _anchored(batch: pa.RecordBatch, n: int, gram: int):
    """For each piece of the batch: the words' hashes, the words, each window's anchor and whether it lies in one text."""
    for p in pieces(batch.column("text")):
        w = words(p)
        h = hashes(p, w)
        if len(h) >= n:
            anchor = slide_min(grams(h, gram), n - gram + 1)
            yield p, h, w, anchor, w.doc[: len(anchor)] == w.doc[n - 1 :]


def _distinct(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The keys of each text once."""
    with np.errstate(over="ignore"):
        return key[np.unique(mix(key + doc.astype(U) * U(0x9E3779B97F4A7C15)), return_index=True)[1]]


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, spans (of words removed), kept (the words left, joined by a space), kept_sha256."""
    spark = docs.sparkSession
    docs = documents(docs)
    copies = copies_of(docs)
    firsts = without(docs, copies, ("doc_id", "text_key")).where("doc_id is not null and text is not null")
    bits = _sketch.bits_for(text_bytes(docs) / 6 * 2 / (window - gram + 2))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = []
        for batch in batches:
            for _, _, w, anchor, ok in _anchored(batch, window, gram):
                ok[1:] &= (anchor[1:] != anchor[:-1]) | (w.doc[1 : len(anchor)] != w.doc[: len(anchor) - 1])
                keys.append(_distinct(anchor[ok], w.doc[: len(anchor)][ok]))
        yield from _sketch.of_partition(np.concatenate([*keys, np.zeros(0, U)]), bits)

    seen = spark.sparkContext.broadcast(_sketch.merged(firsts.mapInArrow(sketch, "block int, once binary, more binary"), bits))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy() for c in ("doc_id", "text_key"))
            for p, h, w, anchor, ok in _anchored(batch, window, gram):
                run = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
                hit = _sketch.repeated(seen.value, anchor[run], bits)
                at = np.flatnonzero(np.repeat(hit, np.diff(np.append(run, len(anchor)))) & ok)
                if len(at):
                    doc = w.doc[at]
                    yield as_batch(OCCURRENCE, grams(h, window)[at].view(np.int64), ids[p.lo + doc], keys[p.lo + doc], (at - w.first[doc]).astype(np.int32))

    found = saved(firsts.mapInArrow(occurrences, "window long, doc_id long, text_key long, pos int"), "windows")
    shared = found.groupBy("window").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id").drop("last_id")
    shared = saved(shared, "shared")  # so that the join below can split the rows of a hot window
    hits = found.join(shared, "window").where("doc_id > first_id")
    marks = (
        hits.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("at")).withColumn("whole", F.lit(False))
        .unionByName(copies.select("doc_id", "text_key", F.lit(None).cast("array<int>").alias("at"), F.lit(True).alias("whole")))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, at, whole in zip(*(batch.column(k) for k in ("doc_id", "text", "at", "whole"))):
                all_words = (text.as_py() or "").encode().split()
                n = len(all_words)
                if whole.as_py():
                    starts = np.arange(max(0, n - window + 1))
                else:
                    starts = np.zeros(0, int) if not at.is_valid else at.values.to_numpy()
                edge = np.zeros(n + 1, np.int32)
                starts = starts[starts <= n - window]
                edge[starts] += 1
                edge[starts + window] -= 1
                gone = np.cumsum(edge[:n]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                kept = b" ".join([x for x, g in zip(all_words, gone.tolist()) if not g] if len(starts) else all_words)
                spans = [{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()]
                out.append((doc_id.as_py(), n, int(gone.sum()), spans, kept.decode(), hashlib.sha256(kept).hexdigest()))
            if out:
                yield as_batch(RESULT_ARROW, *zip(*out))

    return docs.join(marks, ["doc_id", "text_key"], "left").mapInArrow(cut, RESULT)


RESULT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string()), ("kept_sha256", pa.string()),
    ]
)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")
