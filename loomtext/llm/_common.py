"""What the operators of this package share: the shared folder, exact copies, grouped Arrow streams."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows of a table that lists hash buckets; such a table is broadcast, so this is its proven bound (about 16 MB).
COPY_BUCKETS = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; a local one only in local mode, where it is unset."""
    conf = spark.sparkContext.getConf()
    found = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file:///tmp/checkpoints/loomtext"


def saved(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends here and a lost executor costs no recomputation.

    codec: zstd for texts; hashes do not shrink."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, buckets: int, by: str) -> DataFrame:
    """As saved(), bucketed by a column."""
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.option("path", f"{shared_dir(df.sparkSession)}/{table}").bucketBy(buckets, by).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows and 16 MB in this session: a batch of texts then takes a few MB on either side."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def documents(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, text, text_key and the named columns alone, whatever other columns there are.

    A row is known by doc_id and text_key, a hash of its text: rows that repeat a doc_id with other texts are told apart."""
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"), *others)


def copies_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, first_id of each row whose text is that of a row with a smaller doc_id (first_id: the smallest)."""
    keyed = saved(docs.where("text is not null and doc_id is not null").select("doc_id", "text_key", F.unhex(F.md5("text")).alias("h")), "texts")
    first = keyed.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id").drop("last_id")
    first = saved(first, "firsts")  # read from a table both sides of the join are plain exchanges, so a hot key can be split
    return saved(keyed.join(first, "h").where("doc_id > first_id").select("doc_id", "text_key", "first_id").distinct(), "copies")


def _bucket():
    return F.pmod(F.xxhash64("doc_id"), F.lit(COPY_BUCKETS))


def without(docs: DataFrame, listed: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs less the rows listed (a written table with the columns of keys, doc_id among them).

    While the list is shorter than COPY_BUCKETS, a broadcast table of its hash buckets parts the documents, so that
    texts that are surely not listed are not shuffled; a longer list is an anti join."""
    name = "_bucket_of_doc"
    own = listed.select(*keys)
    if own.count() > COPY_BUCKETS:
        return docs.join(own, list(keys), "left_anti")
    buckets = F.broadcast(own.select(_bucket().alias(name)).distinct())
    keyed = docs.withColumn(name, F.when(F.col("doc_id").isNotNull(), _bucket()).otherwise(-1))
    sure = keyed.join(buckets, name, "left_anti").drop(name)
    rest = keyed.join(buckets, name, "left_semi").drop(name).join(own, list(keys), "left_anti")
    return sure.unionByName(rest)


class Listed:
    """A bitmap of hashed keys (doc_id, text_key): which rows may be listed. 16 bits a key, 128 MB at most."""

    def __init__(self, listed: DataFrame):
        own = listed.select(row_hash().alias("h"))
        self.bits = int(min(30, max(19, np.ceil(np.log2(16 * max(1, own.count()))))))

        def block(t: pa.Table) -> pa.Table:
            on = np.zeros(1 << 19, bool)
            on[t["cell"].to_numpy() & ((1 << 19) - 1)] = True
            return pa.table({"block": t["block"][:1], "bits": pa.array([np.packbits(on).tobytes()], pa.binary())})

        cell = own.select(F.shiftrightunsigned("h", 64 - self.bits).alias("cell")).distinct().withColumn("block", F.shiftright("cell", 19))
        self.map = np.zeros(1 << (self.bits - 3), np.uint8)
        got = cell.groupBy("block").applyInArrow(block, "block long, bits binary").toArrow()
        for k, x in zip(got["block"].to_pylist(), got["bits"]):
            self.map[k << 16 : (k + 1) << 16] = np.frombuffer(x.as_buffer(), np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        """h: values of row_hash()."""
        at = h.view(np.uint64) >> np.uint64(64 - self.bits)
        return (self.map[at >> np.uint64(3)] >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1 > 0


def row_hash():
    return F.xxhash64("doc_id", "text_key")


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts; sizes of sketches and partition counts follow from it."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts(spark: SparkSession, size: float, each: float = 32e6) -> int:
    """Partitions for so many bytes, no fewer than the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size / each) + 1)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each run of equal keys in a stream sorted by them; holds one group at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        table = pa.Table.from_batches([batch])
        edges = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:]):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.concat_tables(held)


def releasing(stream):
    """A stream of batches that gives unused memory back when its task ends: workers live on, and what their allocators
    keep would add to what the next stages need."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from stream(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return out


def as_batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema)], schema=schema)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as one compressed string; the bytes of numbers are stored plane by plane."""
    planes = [np.ascontiguousarray(a.reshape(len(a), -1)).view(np.uint8).reshape(len(a), -1) for a in arrays]
    return pa.Codec("zstd", compression_level=3).compress(b"".join((x if a.dtype == np.uint8 else x.T).tobytes() for a, x in zip(arrays, planes)), asbytes=True)


def unpacked(data: bytes, n: int, *kinds: tuple[type, int]) -> list[np.ndarray]:
    """The arrays that packed() took; n: their length, kinds: type and width of each."""
    widths = [np.dtype(k).itemsize * w for k, w in kinds]
    raw = np.frombuffer(pa.Codec("zstd").decompress(data, n * sum(widths)), np.uint8)
    out, at = [], 0
    for (kind, width), size in zip(kinds, widths):
        part = raw[at : at + n * size]
        part = part.reshape(n, size) if np.dtype(kind) == np.uint8 else np.ascontiguousarray(part.reshape(size, n).T)
        out.append(part.view(kind) if width > 1 else part.view(kind)[:, 0])
        at += n * size
    return out
