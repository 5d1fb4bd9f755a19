"""Centroid clustering on integer vectors: exact Lloyd rounds whose distances are matrix products.

Vectors become integers, floor(SCALE * x). They are packed once into blocks of ROWS vectors, which are written; each
round opens the blocks, finds the nearest centroids by |x|^2 - 2 x.c + |c|^2 in float64 BLAS, a block of rows at a time,
and sums the vectors of each cluster; RDD.treeAggregate combines the sums (K * (DIM + 1) integers, at any size) so
that the driver meets a few of them only. Vectors are never shuffled.

The products are exact: with |x| <= a and |c| <= b in each component all terms and partial sums are integers of at most
DIM * (a + b)^2 in size, and while that is below 2^53 float64 holds them whatever the order of summation. Rows beyond this
bound are compared in Python integers instead, sums of clusters are Python integers from the block upwards.

Defined cases: vectors that are null, have another length or a null or non-finite component (or one that is infinite
once scaled) are left out; with fewer than K kept vectors there are fewer centroids; rows that repeat a vec_id are
vectors of their own, and as first centroids are ordered by their components; a null vec_id is clustered but is no first
centroid; without any centroid cluster, distance, inertia and hash are null; distances and inertias that exceed a long
are given as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._common import as_batch, packed, saved, small_batches, unpacked

K, DIM, SCALE, ROUNDS, SEED = 16, 64, 64, 3, "1"
#: Vectors in a block, and rows of one matrix product.
ROWS, GEMM_ROWS = 4096, 1024
EXACT, MOST = 1 << 53, (1 << 63) - 1
BLOCKS = pa.schema([("n", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])
NEAREST = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])
Centroids = list[list[int]]


def integers(dim: int, scale: int):
    """Batches of (vec_id, embedding) as blocks of the kept vectors, scaled; a float64 holds any such integer."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            fit = np.flatnonzero(np.asarray(pa.compute.equal(pa.compute.list_value_length(column), dim).fill_null(False)))
            column, ids = column.take(pa.array(fit)), batch.column("vec_id").take(pa.array(fit))
            x = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dim)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * x)
            keep = np.isfinite(x).all(1)
            x, none = x[keep] + 0.0, ids.is_null().to_numpy(zero_copy_only=False)[keep]
            ids = ids.fill_null(0).to_numpy()[keep]
            for lo in range(0, len(x), ROWS):
                part = slice(lo, lo + ROWS)
                yield as_batch(BLOCKS, [len(ids[part])], [packed(ids[part], none[part].astype(np.uint8))], [packed(x[part])])

    return stream


def opened(n: int, ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """vec_ids, whether they are null, vectors."""
    own, none = unpacked(ids, n, (np.int64, 1), (np.uint8, 1))
    (x,) = unpacked(vectors, n, (np.float64, dim))
    return own, none > 0, x.reshape(n, dim)


def nearest(x: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row (ties: the smaller number) and the squared distance, exact up to MOST."""
    reach = max(abs(v) for c in centroids for v in c)
    label, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    with np.errstate(over="ignore"):
        far = x.shape[1] * (np.abs(x).max(1, initial=0) + float(reach)) ** 2 >= EXACT
    if not far.all():
        c = np.array(centroids, np.float64)
        cc = (c * c).sum(1)
        at = np.flatnonzero(~far)
        for lo in range(0, len(at), GEMM_ROWS):
            rows = at[lo : lo + GEMM_ROWS]
            y = x[rows]
            d = (y * y).sum(1)[:, None] - 2 * (y @ c.T) + cc
            label[rows] = d.argmin(1)
            distance[rows] = d.min(1)
    for i in np.flatnonzero(far).tolist():
        row = [int(v) for v in x[i].tolist()]
        d, label[i] = min((sum((a - b) ** 2 for a, b in zip(row, c)), k) for k, c in enumerate(centroids))
        distance[i] = min(d, MOST)
    return label, distance


def cluster_sums(x: np.ndarray, label: np.ndarray, k: int) -> list[list[int]]:
    """Count and componentwise sum of each cluster's rows, in Python integers."""
    own = label[:, None] == np.arange(k)
    if np.abs(x).max(initial=0) * len(x) < EXACT:  # then float64 sums are exact, too
        sums = (own.T.astype(np.float64) @ x).tolist()
    else:
        sums = [[sum(map(int, column)) for column in x[own[:, j]].T.tolist()] for j in range(k)]
    return [[n, *map(int, row)] for n, row in zip(own.sum(0).tolist(), sums)]


def first_centroids(blocks: DataFrame, k: int, dim: int, seed: str) -> Centroids:
    """The k kept vectors with the smallest hashes. Each block names its k least; k rows go to the driver."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, list[float]]] = []
        for batch in batches:
            for row in batch.to_pylist():
                ids, none, x = opened(row["n"], row["ids"], row["vectors"], dim)
                hashed = [(hashlib.sha256(f"{seed}:{v}".encode()).hexdigest(), i) for i, v in enumerate(ids.tolist()) if not none[i]]
                most = sorted(h for h, _ in hashed)[:k][-1:]  # rows of this hash are ordered by their vectors
                best = sorted(best + [(h, x[i].tolist()) for h, i in hashed if [h] <= most])[:k]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in best]), pa.array([x for _, x in best], pa.list_(pa.float64()))], names=["h", "x"])

    top = blocks.mapInArrow(least, "h string, x array<double>").orderBy("h", "x").limit(k).collect()
    return [[int(v) for v in row.x] for row in top]


def lloyd(blocks: DataFrame, centroids: Centroids, rounds: int, dim: int) -> Centroids:
    """The centroids after so many rounds; an empty cluster keeps its centroid."""
    sc, k = blocks.sparkSession.sparkContext, len(centroids)
    rows = blocks.rdd
    for _ in range(rounds if centroids else 0):
        known = sc.broadcast(centroids)

        def add(total, row):
            x = opened(row.n, bytes(row.ids), bytes(row.vectors), dim)[2]
            return combine(total, cluster_sums(x, nearest(x, known.value)[0], k))

        def combine(a, b):
            return b if a is None else a if b is None else [[u + v for u, v in zip(p, q)] for p, q in zip(a, b)]

        total = rows.treeAggregate(None, add, combine, depth=3)
        known.unpersist()
        if total:
            centroids = [[v // n for v in sums] if n else c for (n, *sums), c in zip(total, centroids)]
    return centroids


def cluster_vectors(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector."""
    spark = embeddings.sparkSession
    small_batches(spark, ROWS)
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = saved(own.mapInArrow(integers(dim, scale), "n long, ids binary, vectors binary"), "vectors")
    centroids = lloyd(blocks, first_centroids(blocks, k, dim, seed), rounds, dim)
    known = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, none, x = opened(row["n"], row["ids"], row["vectors"], dim)
                names = pa.array(ids, mask=none)
                if known.value:
                    label, distance = nearest(x, known.value)
                    yield as_batch(NEAREST, names, label, distance)
                else:
                    yield as_batch(NEAREST, names, [None] * len(ids), [None] * len(ids))

    found = saved(blocks.mapInArrow(assign, "vec_id long, cluster int, distance long"), "nearest")
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"))
    total = {r.cluster: int(r.total) for r in per.where("cluster is not null").collect()}  # k rows at most
    about = [(j, min(v, MOST), min(sum(total.values()), MOST), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for j, v in sorted(total.items())]
    known_clusters = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known_clusters), "cluster", "left").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
