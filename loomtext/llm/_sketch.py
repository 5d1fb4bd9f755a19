"""Count-min sketches of 64-bit keys: one from each partition, merged by ranges of cells, read as bits "two or more"."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import as_batch
from ._words import U, mix

ROWS = 3
#: Cells of one block; a block of a partition's sketch is one row.
BLOCK = 1 << 16
#: Most bits of a row's width: the merged sketch is at most ROWS * 2**MAX_BITS / 8 bytes (101 MB). Beyond it more keys pass, none are lost.
MAX_BITS = 28
SCHEMA = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])
SEEDS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9][:ROWS]


def bits_for(keys: float) -> int:
    """Four to eight cells a key."""
    return min(MAX_BITS, max(16, int(np.ceil(np.log2(max(1.0, 4 * keys))))))


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return mix(keys ^ U(SEEDS[row])) >> U(64 - bits)


def of_partition(keys: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """The sketch of these keys: cells met once and more often, block by block."""
    for row in range(ROWS):
        met, count = np.unique(cells(keys, row, bits), return_counts=True)
        block, low = (met >> U(16)).astype(np.int32), (met & U(0xFFFF)).astype(np.uint16)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]]) if len(block) else [0]
        ids, once, more = [], [], []
        for lo, hi in zip(edges[:-1], edges[1:]):
            two = count[lo:hi] > 1
            ids.append((row << (bits - 16)) + int(block[lo]))
            once.append(low[lo:hi][~two].tobytes())
            more.append(low[lo:hi][two].tobytes())
            if len(ids) == 4096:
                yield as_batch(SCHEMA, ids, once, more)
                ids, once, more = [], [], []
        yield as_batch(SCHEMA, ids, once, more)


def _merge(table: pa.Table) -> pa.Table:
    count = np.zeros(BLOCK, np.uint8)
    for once, more in zip(table["once"], table["more"]):
        at = np.frombuffer(once.as_py(), np.uint16)
        count[at] = np.minimum(count[at] + 1, 2)
        count[np.frombuffer(more.as_py(), np.uint16)] = 2
    return pa.table({"block": table["block"][:1], "bits": pa.array([np.packbits(count > 1).tobytes()], pa.binary())})


def merged(partitions: DataFrame, bits: int) -> np.ndarray:
    """ROWS x 2**bits / 8 bytes: which cells hold a count of two or more."""
    out = np.zeros((ROWS << (bits - 16), BLOCK // 8), np.uint8)
    for batch in [partitions.groupBy("block").applyInArrow(_merge, "block int, bits binary").toArrow()]:
        for block, row in zip(batch["block"].to_pylist(), batch["bits"]):
            out[block] = np.frombuffer(row.as_buffer(), np.uint8)
    return out.reshape(ROWS, -1)


def repeated(sketch: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether each key's estimated count is two or more."""
    ok = np.ones(len(keys), bool)
    for row in range(ROWS):
        c = cells(keys[ok], row, bits)
        ok[ok] = (sketch[row][c >> U(3)] >> (7 - (c & U(7)).astype(np.uint8))) & 1 > 0
    return ok
