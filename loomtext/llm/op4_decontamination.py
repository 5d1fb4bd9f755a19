"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle check.

A window of a document has as many words as the item it is held against. Its 5-word shingles weigh their bytes;
similarity is the weighted Jaccard of the two multisets, and THRESHOLD of it is a leak. A window below the threshold
in shared weight alone cannot pass, so only windows whose shingles of the benchmark weigh that much are
fingerprinted: 128-bit SimHash. A fingerprint within RADIUS of an item's is within 3 bits of it in one of 8 blocks of
16 bits, so the index lists every item under all block values within 3 bits and finds all within RADIUS; each
candidate is then verified exactly. At similarity 0.8 the distance is 19.4 bits on average with deviation 4.1, so
RADIUS 31 leaves out fewer than one in 400 of such windows and none that are equal.

Documents are scanned once, whatever the benchmark's size: a bitmap of the shingles of all items (256 bits each, 128 MB
at most; a full one passes more) and the least weight of each item length mark the windows that can pass, and only
the stretches that these cover are written. The index is then broadcast in slices of at most SLICE_ITEMS items and
SLICE_SHINGLES hashes (45 MB and 32 MB), and each slice reads the stretches, not the documents.

Defined cases: an item of 1 to 4 words has one shingle, the whole, and is found wherever these words stand; a text
shorter than an item is one window as a whole; null or blank ones match nothing; equal items match each; of several
windows, or rows with one item_id, the most similar and then first one is reported; rows that repeat a doc_id with
other texts are reported each; a null doc_id or item_id takes no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._common import as_batch, documents, saved
from ._words import U, grams, hashes, mix, pieces, words

SHINGLE, THRESHOLD, RADIUS, SLICE_ITEMS, SLICE_SHINGLES = 5, 0.8, 31, 1000, 1 << 22
LEAK = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64())])
LEAK_SQL = "doc_id long, text_key long, item_id long, start_word int, n_words int, similarity double"
#: A stretch of a text: words in a shingle, its first word, the text's words, hashes and weights of its shingles.
STRETCH = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("of", pa.int32()), ("first", pa.int32()), ("n_words", pa.int32()), ("grams", pa.binary()), ("weights", pa.binary())])
NEAR = np.array([sum(1 << b for b in bits) for k in range(4) for bits in combinations(range(16), k)], np.uint16)


def shingled(column: pa.Array, sizes: tuple[int, ...] | None = None) -> Iterator[tuple[int, int, dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """Of each text: its number, its words and its shingles' hashes in order and their weights, by words in a shingle.

    sizes: those smaller than SHINGLE that are wanted too; without, a text shorter than a shingle has one, the whole."""
    for p in pieces(column):
        w = words(p)
        h = hashes(p, w)
        size = np.concatenate([[0], np.cumsum(w.end - w.start)])
        for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
            if b > a:
                wanted = [min(SHINGLE, b - a)] if sizes is None else [n for n in (*sizes, SHINGLE) if n <= b - a]
                yield p.lo + i, b - a, {n: (grams(h[a:b], n) if n == SHINGLE else mix(grams(h[a:b], n) + U(n)), size[a + n : b + 1] - size[a : b - n + 1]) for n in wanted}


def fingerprints(g: np.ndarray, weight: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """SimHash (8 blocks of 16 bits) of the shingles start..start+count."""
    bits = np.unpackbits(np.stack([g, mix(g ^ U(0xA5A5A5A55A5A5A5A))], 1).view(np.uint8), axis=1)
    votes = np.zeros((len(g) + 1, 128), np.int64)
    np.cumsum((bits.astype(np.int64) * 2 - 1) * weight[:, None], axis=0, out=votes[1:])
    return np.packbits(votes[start + count] > votes[start], axis=1).view(np.uint16)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard of two multisets of shingles."""
    ka, ia, na = np.unique(a, return_index=True, return_counts=True)
    kb, ib, nb = np.unique(b, return_index=True, return_counts=True)
    _, x, y = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = (np.minimum(na[x], nb[y]) * wa[ia[x]]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


class Index:
    """Items of a slice by length, with the block values within 3 bits of theirs; those shorter than a shingle by their hash."""

    def __init__(self, items: list[tuple[int, int, np.ndarray, np.ndarray]]):
        self.short: dict[int, list[int]] = {}
        for item_id, n, g, _ in items:
            if n < SHINGLE:
                self.short.setdefault(int(g[0]), []).append(item_id)
        self.items = items = [x for x in items if x[1] >= SHINGLE]
        self.grams = np.unique(np.concatenate([np.zeros(0, U), *[x[2] for x in items]]))
        self.lengths: dict[int, tuple[int, float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({x[1] for x in items}):
            own = np.array([i for i, x in enumerate(items) if x[1] == n])
            prints = np.concatenate([fingerprints(items[i][2], items[i][3], np.zeros(1, int), np.array([len(items[i][2])])) for i in own])
            key = ((np.arange(8, dtype=np.uint32)[None, :, None] << np.uint32(16)) | (prints[:, :, None] ^ NEAR)).reshape(-1)
            order = np.argsort(key, kind="stable")
            self.lengths[n] = (len(items[own[0]][2]), min(items[i][3].sum() for i in own) * THRESHOLD, own, prints, key[order], np.repeat(np.arange(len(own)), 8 * len(NEAR))[order])

    def leaks(self, whole: bool, g: np.ndarray, weight: np.ndarray) -> list[tuple[int, int, int, float]]:
        """item_id, start, words and similarity of the best window for each item that leaks; whole: the stretch is a whole text."""
        if not len(self.grams):
            return []
        at = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        held = np.concatenate([[0], np.cumsum(np.where(self.grams[at] == g, weight, 0))])
        if not held[-1]:
            return []
        best: dict[int, tuple[float, int, int]] = {}
        for n, (count, least, own, prints, key, item) in self.lengths.items():
            if count > len(g):
                if not whole:
                    continue
                count = len(g)
            starts = np.flatnonzero(held[count:] - held[:-count] >= least - 1e-9)
            for part in np.split(starts, np.flatnonzero(np.diff(starts // 4096)) + 1):
                if not len(part):
                    continue
                lo, hi = part[0], part[-1] + count
                mine = fingerprints(g[lo:hi], weight[lo:hi], part - lo, count)
                for b in range(8):
                    value = (np.uint32(b << 16) | mine[:, b]).astype(np.uint32)
                    first, last = np.searchsorted(key, value, "left"), np.searchsorted(key, value, "right")
                    many = last - first
                    window = np.repeat(np.arange(len(part)), many)
                    other = item[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)]
                    close = np.bitwise_count(mine[window] ^ prints[other]).sum(1) <= RADIUS
                    for s, i in set(zip(part[window[close]].tolist(), own[other[close]].tolist())):
                        j = similarity(g[s : s + count], weight[s : s + count], self.items[i][2], self.items[i][3])
                        if j >= THRESHOLD and (i not in best or (-j, s) < (-best[i][0], best[i][1])):
                            best[i] = (j, s, count + SHINGLE - 1)
        return [(self.items[i][0], s, n, j) for i, (j, s, n) in best.items()]


class Gate:
    """Which windows can pass: the item lengths with their least weights, and a bitmap of all items' shingles."""

    def __init__(self):
        self.least: dict[int, float] = {}
        self.short: set[int] = set()
        self.bits, self.map, self.n = 0, np.zeros(0, np.uint8), 0

    def measure(self, items: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        for _, n, g, weight in items:
            self.n += len(g)
            if n < SHINGLE:
                self.short.add(n)
            else:
                self.least[n] = min(self.least.get(n, np.inf), weight.sum() * THRESHOLD)

    def mark(self, items: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        if not self.bits:
            self.bits = int(min(30, max(16, np.ceil(np.log2(256 * self.n)))))
            self.map = np.zeros(1 << (self.bits - 3), np.uint8)
        at = np.concatenate([x[2] for x in items]) >> U(64 - self.bits)
        np.bitwise_or.at(self.map, at >> U(3), (128 >> (at & U(7)).astype(np.uint8)).astype(np.uint8))

    def has(self, g: np.ndarray) -> np.ndarray:
        at = g >> U(64 - self.bits)
        return (self.map[at >> U(3)] >> (7 - (at & U(7)).astype(np.uint8))) & 1 > 0

    def stretches(self, n_words: int, size: int, g: np.ndarray, weight: np.ndarray) -> list[tuple[int, int]]:
        """First and last + 1 of the runs of shingles that windows which can pass cover."""
        hit = self.has(g)
        if not hit.any():
            return []
        edge = np.zeros(len(g) + 1, np.int64)
        if size < SHINGLE:
            edge[:-1] += hit
            edge[1:] -= hit
        else:
            held = np.concatenate([[0], np.cumsum(np.where(hit, weight, 0))])
            for n, least in self.least.items():
                if held[-1] < least - 1e-9:
                    continue
                count = min(n - SHINGLE + 1, len(g))
                start = np.flatnonzero(held[count:] - held[: len(g) - count + 1] >= least - 1e-9)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + count, -1)
        return np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]))).reshape(-1, 2).tolist()


def _slices(bench: DataFrame) -> Iterator[list[tuple[int, int, np.ndarray, np.ndarray]]]:
    """Shingled items, SLICE_ITEMS and SLICE_SHINGLES at most at once; an item longer than that is a slice."""
    held, size = [], 0
    rows = bench.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null").toLocalIterator()
    for item_id, text in rows:
        for _, n, by_size in shingled(pa.array([text], pa.string())):
            ((g, weight),) = by_size.values()
            if held and (len(held) == SLICE_ITEMS or size + len(g) > SLICE_SHINGLES):
                yield held
                held, size = [], 0
            held.append((item_id, n, g, weight))
            size += len(g)
    if held:
        yield held


def decontaminate(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, start_word, n_words, similarity: the best window of each document for each item in it."""
    spark = docs.sparkSession
    docs = documents(docs).where("doc_id is not null and text is not null")
    made = Gate()
    for items in _slices(bench):
        made.measure(items)
    if not made.n:
        return spark.createDataFrame([], LEAK_SQL)
    for items in _slices(bench):
        made.mark(items)
    gate = spark.sparkContext.broadcast(made)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = tuple(sorted(gate.value.short))
        for batch in batches:
            ids, keys, out = batch.column("doc_id"), batch.column("text_key"), []
            for i, n, by_size in shingled(batch.column("text"), sizes):
                for size, (g, weight) in by_size.items():
                    out += [(ids[i].as_py(), keys[i].as_py(), size, a, n, g[a:b].tobytes(), weight[a:b].astype(np.int64).tobytes()) for a, b in gate.value.stretches(n, size, g, weight)]
            if out:
                yield as_batch(STRETCH, *zip(*out))

    found = saved(docs.mapInArrow(find, "doc_id long, text_key long, of int, first int, n_words int, grams binary, weights binary"), "stretches")
    out = None
    for items in _slices(bench):
        index = spark.sparkContext.broadcast(Index(items))

        def match(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for doc_id, key, size, first, n, g, weight in zip(*(batch.column(c) for c in STRETCH.names)):
                    doc_id, key, size, first, n = (x.as_py() for x in (doc_id, key, size, first, n))
                    g, weight = np.frombuffer(g.as_buffer(), U), np.frombuffer(weight.as_buffer(), np.int64)
                    if size < SHINGLE:
                        out += [(doc_id, key, item, first + k, size, 1.0) for k, x in enumerate(g.tolist()) for item in index.value.short.get(x, ())]
                    else:
                        out += [(doc_id, key, item, first + s, m, j) for item, s, m, j in index.value.leaks(len(g) == n - SHINGLE + 1, g, weight)]
                if out:
                    yield as_batch(LEAK, *zip(*out))

        part = found.mapInArrow(match, LEAK_SQL)
        out = part if out is None else out.unionByName(part)
    best = saved(out, "leaks").groupBy("doc_id", "text_key", "item_id").agg(F.min(F.struct((-F.col("similarity")).alias("less"), "start_word", "n_words")).alias("b"))
    return best.select("doc_id", "text_key", "item_id", "b.start_word", "b.n_words", (-F.col("b.less")).alias("similarity"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return leaks.select("doc_id", "item_id", "start_word", "n_words", "similarity")
