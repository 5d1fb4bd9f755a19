"""Target-distribution importance resampling over an integer word dictionary.

Features are the runs of 1 to 3 consecutive words of a text, hashed into BUCKETS buckets. A bucket's gain compares its
smoothed share of the target's features (benchmark) with its share of the corpus's; a document's weight is the sum of
its features' gains, and documents are drawn without replacement by weight plus a Gumbel number of their doc_id.

Texts are worked on in blocks. A block has an integer dictionary: its distinct words get ids, a pair of words is the
tuple (word id, word id), a triple the tuple (pair id, word id). The bytes of each distinct tuple are hashed once, from
the checksum of its first part on (crc32 of `a b c` is that of ` c` begun at crc32 of `a b`), and the buckets are joined
back to the places where the tuples stand, for counts of the corpus as for weights of documents. Dictionaries belong to
blocks because ids are only there to save work: a dictionary of the whole corpus would shuffle three tuples for each
word to save checksums of some 15 bytes, and gives the same buckets.

Nothing but counts of buckets (BUCKETS rows a task) and one row a document is shuffled. The table of gains is broadcast;
it has BUCKETS rows at any size. Ranks come from a range partitioning of scores, ties parted by doc_id and then row.

Defined cases: a null text has no features; a text without words has weight 0 and is not drawn; a null doc_id has no
score and is not drawn, nor counted in the size of the draw, but its features count for the corpus; rows that repeat
are drawn each for itself; null benchmark texts have no features; an empty benchmark leaves all gains to the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._common import as_batch, parts, saved, small_batches
from ._words import LOWER, Piece, pieces

BUCKETS, LONGEST, MIN_WORDS, PER_CENT, SEED = 10_000, 3, 20, 5, "42"
#: Bytes of texts that share a dictionary; a longer text is a block of its own.
BLOCK = 4 << 20
IS_WORD = np.zeros(256, bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
WEIGHTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def word_ids(p: Piece) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The dictionary id of each word, the dictionary, and the number of each text's first word (and the count of all)."""
    data = LOWER[p.data]
    on = IS_WORD[data]
    opens = on.copy()
    opens[1:] &= ~on[:-1]
    begins = p.at[:-1][p.at[:-1] < len(on)]
    opens[begins] = on[begins]
    start = np.flatnonzero(opens)
    letters = data[on]
    at = np.append((np.cumsum(on) - 1)[start], len(letters)) if len(start) else np.zeros(1, np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(letters.tobytes())])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist(), np.searchsorted(start, p.at)


def block_features(p: Piece, buckets: int = BUCKETS) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For runs of 1, 2 and 3 words: the bucket of each run, and the number of its first word; then each text's first word."""
    ids, dictionary, first = word_ids(p)
    tail = [b" " + x for x in dictionary]
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(ids))
    crc = [crc32(x) for x in dictionary]
    tuples = ids  # of each run, its tuple's id
    out = [(np.array(crc, np.int64)[ids] % buckets, place)]
    for n in range(2, LONGEST + 1):
        # tuples[i] is the tuple of the n - 1 words from place[i] on; those that a further word of the text follows are kept
        m = max(0, len(ids) - n + 1)
        followed = np.zeros(len(ids), bool)
        followed[:m] = text_of[n - 1 :][:m] == text_of[:m]
        stays = followed[place]
        place, tuples = place[stays], tuples[stays]
        distinct, tuples = np.unique(tuples * len(dictionary) + ids[place + n - 1], return_inverse=True)
        head, last = np.divmod(distinct, max(1, len(dictionary)))
        crc = [crc32(tail[b], crc[a]) for a, b in zip(head.tolist(), last.tolist())]
        out.append((np.array(crc, np.int64)[tuples] % buckets if crc else np.zeros(0, np.int64), place))
    return out, first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for p in pieces(batch.column("text"), BLOCK):
            for bucket, _ in block_features(p)[0]:
                total += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield as_batch(COUNTS, at, total[at])


def _weigh(gains):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.frombuffer(gains.value, np.int64)
        for batch in batches:
            for p in pieces(batch.column("text"), BLOCK):
                runs, first = block_features(p)
                weight = np.zeros(len(first) - 1, np.int64)
                features = np.zeros(len(first) - 1, np.int64)
                for bucket, place in runs:
                    total = np.concatenate([[0], np.cumsum(gain[bucket])])
                    cut = np.searchsorted(place, first)
                    weight += total[cut[1:]] - total[cut[:-1]]
                    features += np.diff(cut)
                yield as_batch(WEIGHTS, batch.column("doc_id").slice(p.lo, p.hi - p.lo), np.diff(first), features, weight)

    return stream


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features fall in each bucket; BUCKETS numbers at any size."""
    small_batches(texts.sparkSession)
    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counts.toLocalIterator():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed corpus share)) of each bucket, in doubles."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def ranked(rows: DataFrame, *order) -> DataFrame:
    """rows with rank 1, 2, 3 ... in the given order, without a single sorting task: ranges are sorted where they lie,
    and a range's first rank follows from the sizes of those before it (one number a partition goes to the driver)."""
    spark = rows.sparkSession
    size = rows.count()
    ranges = rows.repartitionByRange(parts(spark, size * 40.0), *order).sortWithinPartitions(*order)
    placed = saved(ranges.withColumn("_at", F.monotonically_increasing_id()), "ranges")  # the partition's number above, the place in it in 33 bits
    part = F.shiftright("_at", 33)
    sizes = sorted((r.part, r["count"]) for r in placed.groupBy(part.alias("part")).count().collect())
    offsets = np.concatenate([[0], np.cumsum([n for _, n in sizes])]).tolist()
    known = F.broadcast(spark.createDataFrame([(p, o) for (p, _), o in zip(sizes, offsets)] or [(0, 0)], "_part long, _before long"))
    return placed.join(known, part == F.col("_part")).withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_part", "_before")


def resample(docs: DataFrame, target: DataFrame, per_cent: int = PER_CENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of each row of docs; rank is null where it is not drawn."""
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(gains(bucket_counts(docs), bucket_counts(target)).tobytes())
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weighed = own.mapInArrow(_weigh(gain), "doc_id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = saved(weighed.withColumn("score", F.when(F.col("doc_id").isNotNull(), F.col("weight") + noise)).withColumn("_row", F.monotonically_increasing_id()), "scores")
    able = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    size = scored.where(able).count() * per_cent // 100
    order = ranked(scored.where(able), F.desc("score"), "doc_id", "_row")
    order = order.withColumn("rank", F.when(F.col("rank") <= size, F.col("rank")))
    return order.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long"))).drop("_row")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
