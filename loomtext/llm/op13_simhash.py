"""SimHash near-dedup by pigeonring filtering.

A text's fingerprint has a bit set where over half of its shingles' XXH64 hashes have it. Equal fingerprints are one
node, nodes link at RADIUS or fewer differing bits, and linked nodes are components.

The 64 bits are a ring of SEGMENTS segments with d differing bits each. If all d add up to no more than RADIUS, some
segment of the ring begins a chain of which the first l segments, for every l, differ in no more than l * RADIUS /
SEGMENTS bits together: 0 in the first, 1 in the first two or three, 2 in the first four or five, and so on. (Else from
each segment a run over budget would begin, and such runs laid end to end would bring the ring over RADIUS.) So a
node is sent, for each segment to begin with, under keys that two nodes share if their chain holds: within the first
`chain` segments a segment that differs has a bit or more, so the budgets leave at most chain // 2 of them differing,
and only in certain places; a key is such a choice of equal segments with their bits. Nodes with equal keys are compared
chain by chain: what leaves its budget after 3, 5 or 7 segments goes before the whole distance is counted.

`chain` is 3, 5 or 7, keys of 16, 24 or 32 bits, the smallest for which the nodes fill the key space no more than FILL
times; results do not depend on it. A key's nodes return a spanning forest, never pairs. A key with more than BLOCK
nodes is parted into blocks, each couple of blocks a unit, so no task holds a whole group.

Defined cases: null or blank texts have fingerprint zero and are linked like any other; a text of 1 to 3 words has one
shingle, the whole; rows that repeat a doc_id are nodes of their own, and each gets its component; a null doc_id has a
fingerprint, links nothing and has no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._common import as_batch, parts, saved, small_batches
from ._graph import components
from ._words import LOWER, U, Piece, pieces, words

SHINGLE, SEED, RADIUS, SEGMENTS, FILL, BLOCK = 4, 42, 4, 8, 16, 2048
BITS = 64 // SEGMENTS
#: Rows of a key up to this are compared all with all, at once for many keys.
SMALL, STREAM_ROWS = 64, 1 << 17
PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
KEYS = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprints(p: Piece, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text of a piece."""
    w = words(p)
    out = np.zeros(len(w.first) - 1, U)
    count = np.diff(w.first)
    if not len(w.start):
        return out
    # the words of a text, lower-cased, with one space between them; positions in it follow from what is kept
    edge = np.zeros(len(p.data) + 1, np.int8)
    edge[w.start] += 1
    edge[w.end] -= 1
    keep = np.cumsum(edge[:-1], dtype=np.int8) > 0
    more = np.ones(len(w.start), bool)
    more[w.first[1:][count > 0] - 1] = False
    data = LOWER[p.data]
    data[w.end[more]] = 0x20
    keep[w.end[more]] = True
    place = np.cumsum(keep) - 1
    plain = data[keep].tobytes()
    # a shingle begins at each word that shingle - 1 words of its text follow, and at the first word of a shorter text
    left = np.repeat(w.first[1:], count) - np.arange(len(w.start))
    first = np.zeros(len(w.start), bool)
    first[w.first[:-1][count > 0]] = True
    begin = np.flatnonzero((left >= shingle) | first)
    last = begin + np.minimum(left[begin], shingle) - 1
    digest = xxhash.xxh64_intdigest
    a, b = place[w.start[begin]], place[w.end[last] - 1] + 1
    h = np.concatenate([np.array([digest(plain[i:j], seed) for i, j in zip(a[lo : lo + STREAM_ROWS].tolist(), b[lo : lo + STREAM_ROWS].tolist())], U) for lo in range(0, len(a), STREAM_ROWS)])
    full = np.flatnonzero(count)
    at = np.searchsorted(begin, w.first[full])
    n = np.diff(np.append(at, len(h)))
    for text, lo, size in zip(full.tolist(), at.tolist(), n.tolist()):
        ones = np.zeros(64, np.int64)
        for a in range(lo, lo + size, 1 << 16):
            ones += np.unpackbits(h[a : min(a + (1 << 16), lo + size)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out[text] = np.packbits(2 * ones > size).view(">u8")[0]
    return out


def patterns(chain: int) -> list[tuple[int, ...]]:
    """The choices of equal segments among the first `chain` that the budgets leave: the first one always, and so many
    that only chain // 2 are left out, no more than l // 2 of them within the first l."""
    out = []
    for gone in combinations(range(1, chain), chain // 2):
        if all(sum(g < n for g in gone) <= n * RADIUS // SEGMENTS for n in range(1, chain + 1)):
            out.append(tuple(i for i in range(chain) if i not in gone))
    return out


def chain_for(nodes: int) -> int:
    """The length of the keys' chains: keys of 8 * (chain // 2 + 1) bits."""
    return next((c for c in (3, 5) if nodes <= FILL << (BITS * (c // 2 + 1))), 7)


def turned(fp: np.ndarray, begin: np.ndarray | int) -> np.ndarray:
    """The ring from the given segment on: that segment in the highest bits."""
    by = (np.asarray(begin) * BITS).astype(U)
    return (fp << by) | (fp >> ((U(64) - by) & U(63))) if np.ndim(by) or by else fp


def keys(fp: np.ndarray, chain: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of each fingerprint (rows) and the segment that each key begins with. Keys hold segment and pattern, too."""
    of = patterns(chain)
    out = np.empty((len(fp), SEGMENTS * len(of)), U)
    for s in range(SEGMENTS):
        ring = turned(fp, s)
        for k, pattern in enumerate(of):
            key = np.full(len(fp), s * len(of) + k, U)
            for i in pattern:
                key = (key << U(BITS)) | ((ring >> U(64 - BITS * (i + 1))) & U((1 << BITS) - 1))
            out[:, s * len(of) + k] = key
    return out, np.repeat(np.arange(SEGMENTS), len(of))


def near(a: np.ndarray, b: np.ndarray, chain: int) -> np.ndarray:
    """Which pairs link: rings turned to the chain's first segment; pairs are dropped as soon as a budget is exceeded."""
    x = a ^ b
    at = np.arange(len(x))
    for n in (*range(3, SEGMENTS, 2), SEGMENTS):
        y = x[at] >> U(64 - BITS * n)
        at = at[np.bitwise_count(y) <= n * RADIUS // SEGMENTS]
    out = np.zeros(len(x), bool)
    out[at] = True
    return out


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows reaches over the links i - j."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def group_forest(ring: np.ndarray, chain: int) -> np.ndarray:
    """As forest(), of one large group: rows are compared with those not reached yet only."""
    low, todo = np.arange(len(ring)), np.arange(len(ring))
    while len(todo) > 1:
        seed, todo = todo[0], todo[1:]
        queue = [seed]
        while queue and len(todo):
            hit = near(ring[todo], ring[queue.pop()], chain)
            reached = todo[hit]
            low[reached] = seed
            todo = todo[~hit]
            queue += reached.tolist()
    return low


def links(key: np.ndarray, ring: np.ndarray, chain: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row numbers) of the rows of each key; rows are sorted by key."""
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    size = np.diff(edge)
    low = np.arange(len(key))
    group = np.repeat(np.arange(len(size)), size)
    small = (size <= SMALL)[group]
    for_i, for_j = [], []
    for step in range(1, min(int(size.max(initial=1)), SMALL + 1)):
        i = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        i = i[near(ring[i], ring[i + step], chain)]
        for_i.append(i)
        for_j.append(i + step)
    if for_i:
        low = forest(len(key), np.concatenate(for_i), np.concatenate(for_j))
    for g in np.flatnonzero(size > SMALL).tolist():
        a, b = edge[g], edge[g + 1]
        low[a:b] = a + group_forest(ring[a:b], chain)
    at = np.flatnonzero(low != np.arange(len(low)))
    return at, low[at]


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p in pieces(batch.column("text")):
            yield as_batch(PRINTS, batch.column("doc_id").slice(p.lo, p.hi - p.lo), fingerprints(p).view(np.int64))


def _keyed(chain: int):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            found, _ = keys(fp.view(U), chain)
            yield as_batch(KEYS, found.view(np.int64).ravel(), np.repeat(fp, found.shape[1]))

    return stream


def _linked(chain: int, by: list[str]):
    """Rows sorted by `by`, of which `key` is the first, in runs of whole keys."""
    per = len(patterns(chain))

    def forests(t: pa.Table) -> pa.RecordBatch:
        key, fp = t["key"].to_numpy().view(U), t["fp"].to_numpy()
        begin = (key >> U(BITS * (chain // 2 + 1))).astype(np.int64) // per
        unit = key
        if len(by) > 1:  # blocks of one key are units of their own
            new = np.zeros(len(key), bool)
            for c in by:
                v = t[c].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            unit = np.cumsum(new)
        at, low = links(unit, turned(fp.view(U), begin), chain)
        return as_batch(EDGES, fp[at], fp[low])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < STREAM_ROWS:
                continue
            t = pa.Table.from_batches(held)
            same = np.ones(rows, bool)
            for c in by:
                v = t[c].to_numpy()
                same &= v == v[-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield forests(t.slice(0, cut))
                held = t.slice(cut).combine_chunks().to_batches()
                rows -= cut
        if rows:
            yield forests(pa.Table.from_batches(held))

    return stream


def near_prints(nodes: DataFrame, block: int = BLOCK, chain: int | None = None) -> DataFrame:
    """a, b: links that span the near groups of the distinct fingerprints nodes.fp; not all links."""
    spark = nodes.sparkSession
    n = nodes.count()
    chain = chain or chain_for(n)
    keyed = nodes.select("fp").mapInArrow(_keyed(chain), "key long, fp long")
    keyed = saved(keyed, "keys")
    large = saved(keyed.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("blocks > 1"), "large")
    count = parts(spark, 24.0 * n * SEGMENTS * len(patterns(chain)))
    rest, units = keyed, None
    if not large.isEmpty():
        rest = keyed.join(large, "key", "left_anti")
        own = keyed.join(large, "key").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        units = own.select("key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fp").where("one < two")
    edges = rest.repartition(count, "key").sortWithinPartitions("key").mapInArrow(_linked(chain, ["key"]), "a long, b long")
    if units is not None:
        by = ["key", "one", "two"]
        edges = edges.unionByName(units.repartition(count, *by).sortWithinPartitions(*by).mapInArrow(_linked(chain, by), "a long, b long"))
    return edges


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a long), fingerprint, component_id of each row of docs."""
    small_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = saved(own.mapInArrow(_prints, "doc_id long, fp long"), "prints")
    nodes = saved(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(near_prints(nodes)).select(F.col("id").alias("fp"), "component")
    linked = saved(nodes.join(found, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component")), "linked")
    least = saved(linked.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    known = saved(linked.join(least, "component").select("fp", "component_id"), "known")
    out = prints.where("doc_id is not null").join(known, "fp").unionByName(prints.where("doc_id is null").withColumn("component_id", F.lit(None).cast("long")))
    return out.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "fingerprint", "component_id")
