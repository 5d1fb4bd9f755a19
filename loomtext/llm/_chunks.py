"""Texts as a table of compressed chunks: written once, joined again and again by the chunk's number.

What is learned of a text elsewhere comes back to (chunk, row), so no text is shuffled uncompressed, and a message
between a chunk and a partition is one parcel, not a row for each thing said."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ._common import as_batch, bucketed, packed, saved, unpacked

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK = 4 << 20
SCHEMA = pa.schema([("chunk", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("rows", pa.binary()), ("texts", pa.binary())])


def chunked(docs: DataFrame, name: str, buckets: int = 0) -> DataFrame:
    """chunk, n, size, rows (packed doc_id, byte length and whether the doc_id is null), texts (packed bytes). text is not null.

    buckets: if given, the table is bucketed by chunk, so joins on it move the other side only."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        ids: list[np.ndarray] = []
        missing: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        texts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            data = np.concatenate(texts)
            return as_batch(SCHEMA, [number], [sum(map(len, ids))], [len(data)], [packed(np.concatenate(ids), np.concatenate(sizes), np.concatenate(missing))], [packed(data) if len(data) else b""])

        for batch in batches:
            column = batch.column("text").cast(pa.large_binary())
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
            own, none = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            lo = 0
            while lo < len(own):
                hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK - held, "right")) - 1)
                ids.append(own[lo:hi])
                missing.append(none[lo:hi])
                sizes.append(np.diff(at[lo : hi + 1]))
                texts.append(data[at[lo] : at[hi]])
                held += int(at[hi] - at[lo])
                lo = hi
                if held >= CHUNK or lo < len(own):
                    yield flush()
                    number, held, ids, missing, sizes, texts = number + 1, 0, [], [], [], []
            texts = [x.copy() for x in texts]  # so that no batch is held
        if ids:
            yield flush()

    out = docs.select("doc_id", "text").mapInArrow(pack, "chunk long, n long, size long, rows binary, texts binary")
    return saved(out, name) if not buckets else bucketed(out, name, buckets, "chunk")


def opened(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """chunk, doc_ids, whether they are null, bytes, where each text begins (and the end) of each chunk of a batch."""
    for chunk, n, size, rows, texts in zip(*(batch.column(c) for c in SCHEMA.names)):
        ids, sizes, missing = unpacked(rows.as_py(), n.as_py(), (np.int64, 1), (np.int64, 1), (np.uint8, 1))
        (data,) = unpacked(texts.as_py(), size.as_py(), (np.uint8, 1)) if size.as_py() else (np.zeros(0, np.uint8),)
        yield chunk.as_py(), ids, missing > 0, data, np.concatenate([[0], np.cumsum(sizes)])


def parcels(schema: pa.Schema, part: np.ndarray, arrays: list[np.ndarray], *head) -> Iterator[pa.RecordBatch]:
    """One row for each part: part, *head, how many and the packed arrays. The order within a part is kept."""
    order = np.argsort(part, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1], [True]])) if len(part) else np.zeros(1, int)
    for at in range(0, len(edge) - 1, 500):
        cuts = list(zip(edge[at : at + 500][: len(edge) - 1 - at], edge[at + 1 : at + 501]))
        rows = [order[a:b] for a, b in cuts]
        yield as_batch(schema, part[[r[0] for r in rows]].astype(np.int32), *[[h] * len(rows) for h in head], [len(r) for r in rows], [packed(*[x[r] for x in arrays]) for r in rows])
