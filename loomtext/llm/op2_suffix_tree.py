"""LM scoring: a probabilistic suffix tree over words that grows with the corpus.

Contexts are the DEPTH words or fewer before a token, within a text. A context is grown if training tokens follow it
MIN_COUNT times; next symbols are the tokens (words and the end of a text) that occur MIN_WORD times in training, all
others are left to the root. A context is retained if its next-symbol counts n diverge from the distribution P of its
suffix: its gain, n * ln((n - 1 + S P) / ((N - 1 + S) P)) summed over next symbols, must be above PENALTY nats. The
counts are left out one by one, so chance followers count against a context. Retained counts are smoothed towards
the suffix, (n + S P) / (N + S), S = STRENGTH; the root is (c + 0.5) / (N + 0.5 (V + 1)), the base score's. A token is
scored in the longest retained suffix of what precedes it.

Nothing of the model is broadcast or held on one machine. Texts are a table of chunks, bucketed by chunk. Level by
level (0: words, k: contexts of k words with their next symbols) a chunk asks the owners of the hashes for the counts
of all training texts: a parcel for each owner, with each distinct pair once, its own training count, and P in steps
of a twentieth of a decade for the gain. The owners add up, decide what is retained, and answer each parcel; the next
level is asked with these answers at hand. A context that has more than an owner's share of the tokens is parted over
several by its next symbols; only its sums (one row for each, at most as many as there are owners) pass through the
driver. Words are told apart by 48 bits of hash and an owner, next symbols of one context by 32.

Bounds: an owner has the pairs of PART bytes of text, MOST_PARTS owners at most (1 TB; beyond that they grow).

Defined cases: a null or blank text is the end token alone; no training document gives every token log10 1; rows that
repeat a doc_id are scored each, and train as often as they stand there; a null doc_id is scored and held out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._chunks import chunked, opened, parcels
from ._common import as_batch, groups, packed, parts, saved, small_batches, text_bytes, unpacked
from ._words import Piece, U, hashes, mix, words

DEPTH, MIN_COUNT, MIN_WORD, STRENGTH, PENALTY, FOLDS, HELD, PART, MOST_PARTS = 2, 4, 2, 5.0, 1.0, 5, 1, 16 << 20, 1 << 16
END_HASH = U(0xE0D0E0D0E0D0E0D1)
ASK = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
#: An answer to a parcel or (chunk -1) sums: of level 0 tokens and types, else of a parted context N and its gain's first term.
ANSWER = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("data", pa.binary()), ("key", pa.int64()), ("total", pa.int64()), ("own", pa.float64())])
ANSWER_SQL = "chunk long, part int, n long, data binary, key long, total long, own double"
SCORE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
STEPS = 20


def in_training(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS != HELD


class Model:
    """What all chunks know: sizes, and the parted contexts of each level (by key, 0 if not retained)."""

    def __init__(self, n_parts: int):
        self.n_parts, self.tokens, self.types, self.parted = n_parts, 0, 0, []


class Text:
    """The tokens of one chunk and what has been learned of them so far."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, data: np.ndarray, at: np.ndarray):
        p = Piece(0, len(ids), data, at)
        w = words(p)
        ends = w.first[1:]
        self.held = np.array([none or not in_training(x) for x, none in zip(ids.tolist(), missing.tolist())], bool)
        self.token = np.insert(hashes(p, w, lower=True), ends, END_HASH)
        self.doc = np.insert(w.doc, ends, np.arange(len(ids)))
        self.train = ~self.held[self.doc]
        self.context = np.zeros(len(self.token), U)

    def questions(self, level: int, model: Model):
        """Of the distinct pairs that this level asks about: owners and arrays, in order; and each token's question or -1."""
        n, m = len(self.token), model.n_parts
        back = np.full(n, -1)
        if level == 0:
            key, first, inverse = np.unique(self.token, return_index=True, return_inverse=True)
            count = np.bincount(inverse, weights=self.train, minlength=len(key)).astype(np.uint32)
            part = ((key >> U(48)) % U(m)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            back = _place(order)[inverse]
            return part[order], [_low(key)[order], _high(key)[order], count[order]], back
        same = np.zeros(n, bool)
        same[level:] = self.doc[level:] == self.doc[: n - level]
        before = np.zeros(n, U)
        before[level:] = self.token[: n - level]
        with np.errstate(over="ignore"):
            self.context = mix(self.context * U(0x9E3779B97F4A7C15) + before)
        often = np.zeros(n, np.int64)  # training tokens after the context: as its last word has in the context before
        often[1:] = (self.count if level == 1 else self.n)[:-1]
        self.live = same & (often >= MIN_COUNT)
        self.parted = self.live & (often * m >= model.tokens) & (m > 1)
        at = np.flatnonzero(self.live)
        symbol = self.count >= MIN_WORD
        word = np.where(symbol, self.token, U(0))  # a token that is no next symbol asks for its context's total alone
        with np.errstate(over="ignore"):
            pair = mix(self.context[at] * U(0xC2B2AE3D27D4EB4F) + word[at])
        _, first, inverse = np.unique(pair, return_index=True, return_inverse=True)
        count = np.bincount(inverse, weights=(self.train & symbol)[at], minlength=len(first)).astype(np.uint32)
        one = at[first]
        context, token, parted = self.context[one], word[one], self.parted[one]
        shares = (often[one] * m // max(1, model.tokens) + 1).astype(U)
        with np.errstate(over="ignore"):
            spread = mix(context + token % shares) % U(m)
        part = np.where(parted, U(m) + spread, (context >> U(48)) % U(m)).astype(np.int32)
        order = np.lexsort((context, part))
        back[at] = _place(order)[inverse]
        step = np.minimum(255, np.rint(-STEPS * np.log10(self.p[one]))).astype(np.uint8)
        return part[order], [_low(context)[order], _high(context)[order], (token[order] >> U(16)).astype(np.uint32), count[order], step[order]], back

    def learn(self, level: int, model: Model, back: np.ndarray, said: list[np.ndarray]) -> None:
        asked = back >= 0
        n = np.zeros(len(self.token), np.int64)
        n[asked] = said[0][back[asked]]
        if level == 0:
            self.count = n
            self.base = self.p = (n + 0.5) / (model.tokens + 0.5 * (model.types + 1))
            if not model.tokens:
                self.base = self.p = np.ones(len(n))
            return
        self.n = n
        total = np.zeros(len(n), np.int64)
        total[asked] = said[1][back[asked]]
        known = model.parted[level - 1]
        if len(known[0]):
            key = (self.context[self.parted] & U(0xFFFFFFFFFFFF)).astype(np.int64)
            at = np.minimum(np.searchsorted(known[0], key), len(known[0]) - 1)
            total[self.parted] = np.where(known[0][at] == key, known[1][at], 0)
        self.p = np.where(total > 0, (n + STRENGTH * self.p) / (total + STRENGTH), self.p)


def _low(x: np.ndarray) -> np.ndarray:
    return (x & U(0xFFFFFFFF)).astype(np.uint32)


def _high(x: np.ndarray) -> np.ndarray:
    return ((x >> U(32)) & U(0xFFFF)).astype(np.uint16)


def _place(order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def _answer(level: int, n_parts: int):
    """The owners of a level: sums of counts over all parcels of a part, and an answer to each parcel."""
    kinds = [(np.uint32, 1), (np.uint16, 1), (np.uint32, 1)] + ([(np.uint32, 1), (np.uint8, 1)] if level else [])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["part"]):
            part, sizes = t["part"][0].as_py(), t["n"].to_pylist()
            low, high, *rest = (np.concatenate(x) for x in zip(*(unpacked(x.as_py(), n, *kinds) for x, n in zip(t["data"], sizes))))
            key = (high.astype(np.int64) << 32) | low
            if level == 0:
                _, inverse = np.unique(key, return_inverse=True)
                count = np.bincount(inverse, weights=rest[0]).astype(np.int64)
                yield as_batch(ANSWER, [-1], [part], [0], [None], [0], [int(count.sum())], [float((count > 0).sum())])
                said = [count[inverse].astype(np.uint32)]
            else:
                token, count, step = rest
                order = np.lexsort((token, key))
                new = np.ones(len(order), bool)
                new[1:] = (key[order][1:] != key[order][:-1]) | (token[order][1:] != token[order][:-1])
                first = np.flatnonzero(new)
                n = np.add.reduceat(count[order].astype(np.int64), first)
                context = np.concatenate([[True], key[order][first][1:] != key[order][first][:-1]])
                p = 10.0 ** (np.minimum.reduceat(step[order], first) / -STEPS)
                # a pair of held-out texts alone has n = 0 and no share in the gain
                own = np.where(n > 0, n * np.log((np.maximum(n, 1) - 1 + STRENGTH * p) / p), 0.0)
                at = np.flatnonzero(context)
                total, own = np.add.reduceat(n, at), np.add.reduceat(own, at)
                if part >= n_parts:
                    yield as_batch(ANSWER, [-1] * len(at), [part] * len(at), [0] * len(at), [None] * len(at), key[order][first][at], total, own)
                    kept = np.zeros(len(at), np.int64)
                else:
                    kept = retained(total, own)
                group = np.cumsum(new) - 1
                said = [np.empty(len(order), np.uint32), np.empty(len(order), np.uint32)]
                said[0][order], said[1][order] = n[group], kept[np.cumsum(context) - 1][group]
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            for lo in range(0, len(sizes), 500):
                hi = min(len(sizes), lo + 500)
                yield as_batch(ANSWER, t["chunk"][lo:hi].to_pylist(), [part] * (hi - lo), sizes[lo:hi], [packed(*[x[a:b] for x in said]) for a, b in zip(cuts[lo:hi], cuts[lo + 1 : hi + 1])], *[[None] * (hi - lo)] * 3)

    return stream


def retained(total: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The totals of the contexts whose gain is above PENALTY, 0 for the others."""
    n = np.maximum(total, 1)
    return np.where((total > 0) & (own - n * np.log(n - 1 + STRENGTH) > PENALTY), total, 0)


def suffix_tree_scores(docs: DataFrame, depth: int = DEPTH, part_bytes: int = PART) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = text_bytes(docs)
    n_owners = min(MOST_PARTS, int(size / part_bytes) + 1)
    texts = chunked(docs, "lm-chunks", parts(spark, size / 2))
    model = Model(n_owners)
    answers: list[DataFrame] = []

    def open_text(model: Model, batch: pa.RecordBatch, i: int, ids, missing, data, at, levels: int) -> Text:
        text = Text(ids, missing, data, at)
        for level in range(levels):
            _, arrays, back = text.questions(level, model)
            said = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            got = batch.column(f"a{level}")[i]
            for x in got.as_py() if got.is_valid else ():
                for k, values in enumerate(unpacked(x["data"], x["n"], *[(np.uint32, 1)] * (2 if level else 1))):
                    said[k].append(values)
            text.learn(level, model, back, [np.concatenate(x) for x in said])
        return text

    def joined() -> DataFrame:
        out = texts
        for k, a in enumerate(answers):
            out = out.join(a.withColumnRenamed("said", f"a{k}"), "chunk", "left")
        return out

    for level in range(depth + 1):
        known = spark.sparkContext.broadcast(model)

        def ask(batches: Iterator[pa.RecordBatch], level=level, known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, (chunk, *rest) in enumerate(opened(batch)):
                    text = open_text(known.value, batch, i, *rest, level)
                    part, arrays, _ = text.questions(level, known.value)
                    yield from parcels(ASK, part, arrays, chunk)

        asked = joined().mapInArrow(ask, "part int, chunk long, n long, data binary").repartition(parts(spark, size, part_bytes), "part").sortWithinPartitions("part")
        said = saved(asked.mapInArrow(_answer(level, n_owners), ANSWER_SQL), "answers")
        answers.append(said.where("chunk >= 0").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "n", "data"))).alias("said")))
        sums = said.where("chunk < 0").groupBy("key").agg(F.sum("total").alias("total"), F.sum("own").alias("own")).orderBy("key").collect()  # one row, or one a parted context
        new = Model(n_owners)
        new.tokens, new.types, new.parted = model.tokens, model.types, list(model.parted)
        if level == 0:
            new.tokens, new.types = (int(sums[0].total), int(sums[0].own)) if sums else (0, 0)
        else:
            new.parted.append((np.array([r.key for r in sums], np.int64), retained(np.array([r.total for r in sums], np.int64), np.array([r.own for r in sums], np.float64))))
        model = new
    final = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (_, ids, missing, data, at) in enumerate(opened(batch)):
                text = open_text(final.value, batch, i, ids, missing, data, at, depth + 1)
                n = len(ids)
                summed = lambda x: np.bincount(text.doc, weights=x, minlength=n)
                yield as_batch(SCORE, pa.array(ids, pa.int64(), mask=missing), text.held, np.bincount(text.doc, minlength=n), summed(text.count > 0).astype(np.int64), summed(np.log10(text.base)), summed(np.log10(text.p)))

    scored = joined().mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op2_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
