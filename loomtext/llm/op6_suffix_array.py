"""Suffix-array dedup of bytes: sparse suffixes, range-partitioned by sampled splitters and sorted by multikey quicksort.

Every 50-byte string has an anchor: the least hash of its 27 runs of 24 bytes. Only suffixes that begin at anchors
are sorted (a fourteenth of all), and of these only those whose 24 leading bytes occur in two texts or more: each
chunk of texts asks the owner of an anchor's hash, by 32 bits of it, and gets a bit back (a wrong yes costs a row, a
wrong no cannot be). A row holds the suffix from the anchor on and, reversed, the bytes on its left that belong to
the same 50-byte strings; suffix and left bytes are its sort key. Splitters, sampled from the chunks, range-partition
the keys. A task sends each bucket its sorted rows as one parcel, after it has settled equal rows among themselves:
of a common passage it sends one row a variant. In a bucket rows are sorted by multikey quicksort on 8-byte symbols.

Two rows share a string with k bytes left of the anchor if their suffixes' common prefix, the least between
neighbours from one to the other, has 50 - k bytes and their left sides agree in k: for each k the neighbours with that
prefix are a run, and the strings of a run that agree on the left go to its smallest document. Comparison across
boundaries: where a run reaches a splitter, that is, its prefix is the splitter's too, other buckets may hold more of
it; its strings not yet given to a smaller document are put beside those of the other buckets, and the smallest
document of all takes them. So a lead that a third of all rows share is split over buckets like any other.

Bounds: a bucket has the rows of PART bytes of text and an owner of hashes those of four times as much; there are
MOST_PARTS buckets at most, so up to 1 TB of text, beyond which they grow with it (MOST_PARTS goes with the memory of
an executor); the splitters are broadcast, 76 bytes each, 10 MB at most.

Defined cases: null is an empty text; a text under 50 bytes has no string; exact copies lose all their bytes if
they have 50; rows that repeat a doc_id are judged each on its own text, and neither removes from the other; a null
doc_id neither removes nor is removed from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._chunks import chunked, opened, parcels
from ._common import as_batch, copies_of, documents, groups, packed, parts, releasing, saved, text_bytes, unpacked, without
from ._words import U, byte_grams, mix, slide_min

LENGTH, LEAD, PART, MOST_PARTS, SAMPLES, FLUSH = 50, 24, 8 << 20, 1 << 17, 64, 200_000
#: In place of a count of rows: spans that a task has settled itself, dealt evenly over the buckets.
SETTLED = -1
ASK = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])
ANSWER = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("bits", pa.binary())])
ROWS = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])
#: Spans of one chunk (key null), or one string (key) of a document.
SPAN = pa.schema([("chunk", pa.int64()), ("n", pa.int64()), ("data", pa.binary()), ("key", pa.binary()), ("doc_id", pa.int64()), ("row", pa.int32()), ("start", pa.int32())])
SPAN_SQL = "chunk long, n long, data binary, key binary, doc_id long, row int, start int"
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary()), ("kept_sha256", pa.string()),
    ]
)
RESULT_SQL = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:int,end:int>>, kept binary, kept_sha256 string"


def _runs(anchor: np.ndarray, doc: np.ndarray, ok: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and count of strings that follow each other, share an anchor and lie in one text; most at once."""
    n = len(anchor)
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:n] != doc[: n - 1]) | (ok[1:] != ok[:-1])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, n))
    start, count = start[ok[start]], count[ok[start]]
    times = -(-count // most)
    k = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return np.repeat(start, times) + k * most, np.minimum(most, np.repeat(count, times) - k * most)


def _pieced(values: np.ndarray, n: int, of) -> np.ndarray:
    """of(values, n), which has a number for every n consecutive values, piece by piece: what it holds besides stays small."""
    step = 1 << 18
    out = np.empty(max(0, len(values) - n + 1), U)
    for lo in range(0, len(out), step):
        out[lo : lo + step] = of(values[lo : lo + step + n - 1], n)
    return out


class _Anchors:
    """The anchored runs of strings of one chunk, and the questions about their anchors."""

    def __init__(self, data: np.ndarray, at: np.ndarray, length: int, lead: int):
        self.data, self.at, self.length, self.most = data, at, length, length - lead + 1
        self.grams = _pieced(data, lead, byte_grams) if len(data) >= length else np.zeros(0, U)
        anchor = _pieced(self.grams, self.most, slide_min)
        doc = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
        if len(anchor):
            self.start, self.count = _runs(anchor, doc, doc[: len(anchor)] == doc[length - 1 :], self.most)
        else:
            self.start = self.count = np.zeros(0, np.int64)
        self.anchor, self.doc = anchor[self.start], doc[self.start]

    def asked(self, n_parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each anchor of a text once: its owner and 32 bits, in the order of owners; then which question each run has."""
        with np.errstate(over="ignore"):
            _, first, back = np.unique(mix(self.anchor + self.doc.astype(U) * U(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
        key = self.anchor[first]
        part = ((key >> U(40)) % U(n_parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return part[order], (key[order] & U(0xFFFFFFFF)).astype(np.uint32), order, place[back]

    def rows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sort keys (suffix, then left bytes reversed, each filled up with zeros), lengths of both, text and start of these runs."""
        # a string's anchor is its first run with the least hash; in periodic text a run of strings has several
        start, last = self.start[at], self.start[at] + self.count[at] - 1
        near = start[:, None] + np.arange(2 * self.most - 1)
        r, off = np.nonzero((self.grams[np.minimum(near, len(self.grams) - 1)] == self.anchor[at][:, None]) & (near < len(self.grams)))
        anchored = start[r] + off
        new = np.concatenate([[True], r[1:] != r[:-1]])
        start = np.where(new, start[r], np.concatenate([[0], anchored[:-1] + 1]))
        last = np.minimum(last[r], anchored)
        live = start <= last
        start, last, anchored, doc = start[live], last[live], anchored[live], self.doc[at][r[live]]
        right, left = last + self.length - anchored, anchored - start
        key = np.zeros((len(doc), self.length + self.most - 1), np.uint8)
        step = np.arange(self.length)
        inside = step < right[:, None]
        key[:, : self.length][inside] = self.data[np.minimum(anchored[:, None] + step, len(self.data) - 1)[inside]]
        step = np.arange(self.most - 1)
        inside = step < left[:, None]
        key[:, self.length :][inside] = self.data[np.maximum(anchored[:, None] - 1 - step, 0)[inside]]
        return key, right.astype(np.uint8), left.astype(np.uint8), doc, (start - self.at[doc]).astype(np.int32), last - start + 1


def as_strings(key: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(key).view(f"S{key.shape[1]}")[:, 0]


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """The order of the rows of keys (n x k symbols): three-way partitions by one symbol, the equal part by the next."""
    order = np.arange(len(keys))
    todo = [(0, len(keys), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth == keys.shape[1]:
            continue
        at = order[lo:hi]
        if hi - lo <= 256:
            order[lo:hi] = at[np.lexsort(keys[at, depth:].T[::-1])]
            continue
        symbol = keys[at, depth]
        pivot = np.sort(symbol[:: max(1, len(symbol) // 9)])[4]
        less, more = symbol < pivot, symbol > pivot
        same = ~(less | more)
        order[lo:hi] = np.concatenate([at[less], at[same], at[more]])
        a, b = lo + int(less.sum()), hi - int(more.sum())
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def symbols(key: np.ndarray, length: int) -> np.ndarray:
    """Keys as 8-byte symbols, suffix and left side filled up to whole symbols."""
    out = np.zeros((len(key), -(-length // 8) * 8 + -(-(key.shape[1] - length) // 8) * 8), np.uint8)
    out[:, :length] = key[:, :length]
    out[:, -(-length // 8) * 8 :][:, : key.shape[1] - length] = key[:, length:]
    return out.view(">u8").astype(U)


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes the rows of a and b share."""
    return np.where((same := a == b).all(1), a.shape[1], same.argmin(1))


def compared(key: np.ndarray, right: np.ndarray, left: np.ndarray, doc: np.ndarray, length: int, low: bytes | None, high: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Of a bucket's rows (in any order) and each count k of bytes left of the anchor: whether a smaller document of
    the bucket holds that string, and whether, if not, another bucket may hold it too. low, high: the splitters around."""
    n, most = len(key), key.shape[1] - length + 1
    gone, edge = np.zeros((n, most), bool), np.zeros((n, most), bool)
    order = multikey_quicksort(symbols(key, length))
    suffix = key[order, :length]
    prefix = common_prefix(suffix[1:], suffix[:-1])
    outer = np.zeros(n, np.int64)
    for bound in (low, high):
        if bound is not None:
            outer = np.maximum(outer, common_prefix(suffix, np.frombuffer(bound[:length].ljust(length, b"\0"), np.uint8)[None]))
    right, left, doc = right[order].astype(np.int64), left[order].astype(np.int64), doc[order]
    agree = np.zeros(n, U)
    for k in range(most):
        if k:
            with np.errstate(over="ignore"):
                agree = mix(agree * U(0x9E3779B97F4A7C15) + key[order, length + k - 1].astype(U) + U(1))
        need = length - k
        at = np.flatnonzero((right >= need) & (left >= k))
        if not len(at):
            continue
        # a row between two others shares what they share, so the least prefix on the way decides
        new = np.ones(len(at), bool)
        if len(at) > 1:
            new[1:] = np.minimum.reduceat(prefix, at[:-1])[: len(at) - 1] < need if at[-1] == n - 1 else np.minimum.reduceat(prefix, at)[:-1] < need
        run = np.cumsum(new)
        edge[order[at[outer[at] >= need]], k] = True
        many = np.bincount(run)[run] > 1
        at, run = at[many], run[many]
        if len(at):
            with np.errstate(over="ignore"):
                group = mix(run.astype(U) * U(0xC2B2AE3D27D4EB4F) ^ agree[at])
            by = np.argsort(group, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], group[by][1:] != group[by][:-1]]))
            least = np.repeat(np.minimum.reduceat(doc[at][by], first), np.diff(np.append(first, len(by))))
            gone[order[at[by]], k] = doc[at][by] > least
    return gone, edge & ~gone


def _spans(chunk: np.ndarray, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The spans of each chunk as one row."""
    order = np.argsort(chunk, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1) if len(order) else ():
        yield as_batch(SPAN, [chunk[part[0]]], [len(part)], [packed(row[part].astype(np.int32), start[part].astype(np.int32), stop[part].astype(np.int32))], *[[None]] * 4)


def _bucket(key, right, left, doc, chunk, row, start, length, low, high) -> Iterator[pa.RecordBatch]:
    """Spans of a bucket's rows that smaller documents hold too, and the strings to compare across its boundaries."""
    gone, edge = compared(key, right, left, doc, length, low, high)
    # neighbouring strings of a row are one span: k falls as the string's start rises
    flat = np.zeros((len(gone), gone.shape[1] + 2), np.int8)
    flat[:, 1:-1] = gone[:, ::-1]
    turn = np.diff(flat, axis=1)
    r, a = np.nonzero(turn == 1)
    _, b = np.nonzero(turn == -1)
    begin = start[r].astype(np.int64) + left[r] - (gone.shape[1] - 1 - a)
    yield from _spans(chunk[r], row[r], begin, begin + (b - a) - 1 + length)
    r, k = np.nonzero(edge)
    for lo in range(0, len(r), 20_000):
        i, j = r[lo : lo + 20_000], k[lo : lo + 20_000]
        strings = [key[x, length : length + y][::-1].tobytes() + key[x, : length - y].tobytes() for x, y in zip(i.tolist(), j.tolist())]
        yield as_batch(SPAN, chunk[i], [None] * len(i), [None] * len(i), strings, doc[i], row[i], (start[i] + left[i] - j).astype(np.int32))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, lead: int = LEAD, part_bytes: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (of bytes removed), kept (bytes left), kept_sha256."""
    spark = docs.sparkSession
    docs = documents(docs)
    sized = docs.where(F.octet_length("text") >= length)
    copies = copies_of(sized)
    whole = without(docs, copies, ("doc_id", "text_key"))
    texts = chunked(whole.where("doc_id is not null and text is not null"), "chunks")
    size = text_bytes(docs)
    n_parts = min(MOST_PARTS, int(size / part_bytes) + 1)
    n_owners = min(MOST_PARTS, int(size / part_bytes / 4) + 1)

    @releasing
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, _, _, data, at in opened(batch):
                part, key, _, _ = _Anchors(data, at, length, lead).asked(n_owners)
                yield from parcels(ASK, part, [key], chunk)

    @releasing
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["part"]):
            counts = t["n"].to_pylist()
            key = np.concatenate([unpacked(x.as_py(), n, (np.uint32, 1))[0] for x, n in zip(t["data"], counts)])
            _, back, count = np.unique(key, return_inverse=True, return_counts=True)
            bits = np.split(count[back] > 1, np.cumsum(counts)[:-1])
            for lo in range(0, len(bits), 1000):
                yield as_batch(ANSWER, t["chunk"][lo : lo + 1000].to_pylist(), t["part"][lo : lo + 1000].to_pylist(), [np.packbits(x).tobytes() for x in bits[lo : lo + 1000]])

    asked = texts.mapInArrow(ask, "part int, chunk long, n long, data binary").repartition(parts(spark, size, 4 * part_bytes), "part").sortWithinPartitions("part")
    answers = asked.mapInArrow(answer, "chunk long, part int, bits binary").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("part", "bits"))).alias("answers"))
    splitters = spark.sparkContext.broadcast(_splitters(texts, n_parts, length, lead))

    @releasing
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, right, left, doc, chunk, row, start, count = (np.concatenate([x[i] for x in held]) for i in range(8))
            held.clear()
            text = as_strings(np.concatenate([key, right[:, None], left[:, None]], 1))
            order = np.argsort(text, kind="stable")
            text = text[order]
            first = np.concatenate([[True], text[1:] != text[:-1]])
            del text
            group = np.cumsum(first) - 1
            least = np.minimum.reduceat(doc[order], np.flatnonzero(first))[group]
            done = doc[order] > least
            at = order[done]
            n_buckets = len(splitters.value) + 1
            yield from (as_batch(ROWS, [k % n_buckets], [SETTLED], [x]) for k, x in enumerate(_shipped(chunk[at], row[at], start[at], start[at] + count[at] - 1 + length)))
            at = order[~done]
            bound = splitters.value
            part = np.searchsorted(bound, as_strings(key[at]), "right") if len(bound) else np.zeros(len(at), np.int64)
            yield from parcels(ROWS, part, [x[at] for x in (key, right, left, doc, chunk, row, start)])

        for batch in batches:
            said = batch.column("answers")
            for i, (chunk, ids, _, data, at) in enumerate(opened(batch)):
                anchors = _Anchors(data, at, length, lead)
                part, _, _, question = anchors.asked(n_owners)
                if not len(part) or not said[i].is_valid:
                    continue
                counts = np.unique(part, return_counts=True)[1].tolist()
                yes = np.concatenate([np.unpackbits(np.frombuffer(x["bits"], np.uint8))[:n] for x, n in zip(said[i].as_py(), counts)]) > 0
                for lo in range(0, len(question), 20_000):
                    hit = np.flatnonzero(yes[question[lo : lo + 20_000]]) + lo
                    if len(hit):
                        key, right, left, doc, start, count = anchors.rows(hit)
                        held.append((key, right, left, ids[doc], np.full(len(doc), chunk), doc.astype(np.int32), start, count))
                        size_held += len(doc)
                if size_held > FLUSH:
                    yield from flush()
                    size_held = 0
        if held:
            yield from flush()

    @releasing
    def sort_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches, ["part"]):
            part, width, got = t["part"][0].as_py(), 2 * length - lead, []
            for x, n in zip(t["data"], t["n"].to_pylist()):
                if n == SETTLED:
                    yield _received(x.as_py())
                else:
                    got.append(unpacked(x.as_py(), n, (np.uint8, width), (np.uint8, 1), (np.uint8, 1), (np.int64, 1), (np.int64, 1), (np.int32, 1), (np.int32, 1)))
            if not got:
                continue
            key, right, left, doc, chunk, row, start = (np.concatenate(x) for x in zip(*got))
            got.clear()
            bound = splitters.value
            low, high = bound[part - 1] if part else None, bound[part] if part < len(bound) else None
            yield from _bucket(key, right, left, doc, chunk, row, start, length, low, high)

    rows = texts.join(answers, "chunk").mapInArrow(suffixes, "part int, n long, data binary")
    buckets = rows.repartition(parts(spark, size, part_bytes), "part").sortWithinPartitions("part")
    found = saved(buckets.mapInArrow(sort_bucket, SPAN_SQL), "spans", "zstd")
    strings = found.where("key is not null").select("key", "doc_id", "chunk", "row", "start")
    first = saved(strings.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most"), "across")

    def of_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, row, start = (batch.column(c).to_numpy() for c in ("chunk", "row", "start"))
            for x in _spans(chunk, row, start, start + length):
                yield x.select(["chunk", "n", "data"])

    across = strings.join(first, "key").where("doc_id > least").select("chunk", "row", "start").mapInArrow(of_strings, "chunk long, n long, data binary")
    spans = found.where("key is null").select("chunk", "n", "data").unionByName(across)
    marks = spans.groupBy("chunk").agg(F.collect_list(F.struct("n", "data")).alias("spans_of"))

    @releasing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (_, ids, _, data, at) in enumerate(opened(batch)):
                edge = np.zeros(len(data) + 1, np.int32)
                of = batch.column("spans_of")[i]
                for x in of.as_py() if of.is_valid else ():
                    row, lo, hi = unpacked(x["data"], x["n"], *[(np.int32, 1)] * 3)
                    np.add.at(edge, at[row] + lo, 1)
                    np.add.at(edge, at[row] + hi, -1)
                gone = np.cumsum(edge[:-1]) > 0
                for lo in range(0, len(ids), 500):
                    out = []
                    for r in range(lo, min(len(ids), lo + 500)):
                        raw, g = data[at[r] : at[r + 1]], gone[at[r] : at[r + 1]]
                        spans = np.flatnonzero(np.diff(np.concatenate([[0], g, [0]]))).reshape(-1, 2).tolist()
                        kept = raw[~g].tobytes() if spans else raw.tobytes()
                        out.append((int(ids[r]), len(raw), len(raw) - len(kept), len(spans), [{"start": a, "end": b} for a, b in spans], kept, hashlib.sha256(kept).hexdigest()))
                    yield as_batch(RESULT, *zip(*out))

    main = texts.join(marks, "chunk", "left").mapInArrow(cut, RESULT_SQL)
    n = F.octet_length("text").cast("long")
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    odd = whole.where("doc_id is null or text is null").select("doc_id", F.coalesce(n, F.lit(0).cast("long")).alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), no_spans.alias("spans"), raw.alias("kept"), F.sha2(raw, 256).alias("kept_sha256"))
    # a copy has nothing left; each row of the input that is one gives a row
    key = docs.select("doc_id", "text_key", n.alias("n_bytes")).where(F.col("n_bytes") >= length).join(copies.select("doc_id", "text_key"), ["doc_id", "text_key"], "left_semi")
    every = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    nothing = F.lit(b"")
    gone = key.select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), every.alias("spans"), nothing.alias("kept"), F.sha2(nothing, 256).alias("kept_sha256"))
    return main.unionByName(odd).unionByName(gone)


def _shipped(chunk: np.ndarray, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Iterator[bytes]:
    """Spans that a task has settled, on their way past the buckets: one Arrow row a chunk."""
    for batch in _spans(chunk, row, start, stop):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as w:
            w.write_batch(batch)
        yield sink.getvalue().to_pybytes()


def _received(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def _splitters(texts: DataFrame, n_parts: int, length: int, lead: int) -> np.ndarray:
    """n_parts - 1 sort keys at most that part a sample of the rows evenly: about SAMPLES a part from some 64 chunks.

    They only say where buckets end; what is found does not depend on them."""
    width = 2 * length - lead
    if n_parts == 1:
        return np.zeros(0, f"S{width}")
    n_chunks = texts.count()
    share = min(1.0, 64 / max(1, n_chunks))
    each = int(min(SAMPLES * n_parts, 1 << 20) / max(1.0, n_chunks * share)) + 1

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, data, at in opened(batch):
                anchors = _Anchors(data, at, length, lead)
                pick = np.argsort(mix(anchors.anchor + anchors.start.astype(U)))[:each]
                if len(pick):
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in anchors.rows(pick)[0]], pa.binary())], names=["key"])

    drawn = texts.where(F.pmod(F.xxhash64("chunk"), F.lit(1 << 20)) < int(share * (1 << 20)))
    keys = drawn.mapInArrow(sample, "key binary").toArrow()["key"].to_pylist()  # about SAMPLES a part
    if not keys:
        return np.zeros(0, f"S{width}")
    keys = np.sort(np.array(keys, f"S{width}"))
    return np.unique(keys[np.linspace(0, len(keys), n_parts + 1)[1:-1].astype(int)])


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
