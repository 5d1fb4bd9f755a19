"""Line dedup by pairwise alignment.

Documents overlap if they share a run of lines of `min_chars` bytes or more, in whatever number of texts: the least
such runs that begin and that end at each line are keys, so every block that could be deleted holds a key. Each key
pairs its documents with the smallest that holds it, so pairs grow with the lines and not with the square of a group.
A pair is aligned by patience diff on line hashes; blocks of consecutive aligned lines of `min_chars` bytes or more
are deleted from the later document. What an alignment leaves out because it crosses another block, or because the
later document repeats it, is aligned next: each run of `min_chars` bytes that is left in the later document and that
the earlier one holds is an anchor of its own and is extended both ways. So after a pair no such run is left, and as
each run has its smallest holder among the pairs, no run of that size that any earlier document holds stays whole in
a later one. All pairs are judged on the input. An exact copy loses all its lines.

`rare`, if given, is a rule for boilerplate: a run in more texts is no evidence alone, only with the line after it.

Defined cases: null text has no lines; an empty text has one empty line and keeps it; rows that repeat a doc_id are
judged each on its own text, none against the other; a null doc_id is left alone; a blank line counts no bytes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ._common import as_batch, copies_of, documents, saved, without
from ._words import U, _OF_WORDS, _prefix, mix

MIN_CHARS = 40
CUT = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("at", pa.list_(pa.int32()))])
KEY = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("key", pa.int64()), ("run", pa.int64())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_removed", pa.int64()), ("n_partners", pa.int64()), ("kept", pa.string())])


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal items of a and b; 0 stands for a blank line, which anchors nothing."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {x: j for j, x in enumerate(b[b0:b1], b0) if x and in_b[x] == 1}
        pairs = [(i, where[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in where]
        if not pairs:  # a plain longest common subsequence: all equal lines, the later positions of one line first
            spots = {}
            for j in range(b1 - 1, b0 - 1, -1):
                spots.setdefault(b[j], []).append(j)
            pairs = ((i, j) for i, x in enumerate(a[a0:a1], a0) if x for j in spots.get(x, ()))
        ends, heads = [], []  # longest increasing run of the second positions; heads: (i, j, head before)
        for i, j in pairs:
            n = bisect_left(ends, j)
            if n == len(ends) or ends[n] != j:
                ends[n:n + 1], heads[n:n + 1] = [j], [(i, j, heads[n - 1] if n else None)]
        if not heads:
            continue
        head, chain = heads[-1], []
        while head:
            chain.append(head[:2])
            head = head[2]
        i0, j0 = a0, b0
        for i, j in reversed(chain):
            todo.append((i0, i, j0, j))
            i0, j0 = i, j
        # the parts between anchors; each anchor begins the next part and is matched as its first line
        todo.append((i0, a1, j0, b1))
    return sorted(out)


def _least_run(lines: list, size: list[int], i: int, least: int) -> tuple:
    """The lines from i on that first reach so many bytes; () if they do not, or if one of them is None."""
    total, j = 0, i
    while total < least:
        if j == len(lines) or lines[j] is None:
            return ()
        total += size[j]
        j += 1
    return tuple(lines[i:j])


def common_blocks(a: list[int], b: list[int], size: list[int], least: int) -> list[int]:
    """Positions in b of its blocks of at least so many bytes that are aligned with a; size: of b's lines."""
    gone: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(a, b), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(size[x] for x in block) >= least:
                gone += block
            block = []
        block.append(j)
        last = (i, j)
    left: list = list(b)
    for j in gone:
        left[j] = None
    # what is left and held by a too: moved and repeated blocks
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        where.setdefault(x, []).append(i)
    for j in range(len(b)):
        run = _least_run(left, size, j, least) if left[j] and left[j] in where else ()
        at = next((i for i in where[run[0]] if tuple(a[i : i + len(run)]) == run), None) if run else None
        if at is not None:
            lo, hi, i, e = j, j + len(run), at, at + len(run)
            while lo and i and left[lo - 1] is not None and left[lo - 1] == a[i - 1]:
                lo, i = lo - 1, i - 1
            while hi < len(b) and e < len(a) and left[hi] is not None and left[hi] == a[e]:
                hi, e = hi + 1, e + 1
            gone += range(lo, hi)
            left[lo:hi] = [None] * (hi - lo)
    return gone


def runs(lines: np.ndarray, sizes: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last line and hash of the least runs of so many bytes that begin or end at each line.

    lines, sizes: of all texts; at: where each begins, and the end."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    total = np.concatenate([[0], np.cumsum(np.where(lines == 0, 0, sizes))])
    each = np.flatnonzero(lines)
    last = np.searchsorted(total, total[each] + least, "left") - 1
    ok = last < at[doc[each] + 1]
    first = np.searchsorted(total, total[each + 1] - least, "right") - 1
    ok2 = first >= at[doc[each]]
    both = np.unique(np.stack([np.concatenate([each[ok], first[ok2]]), np.concatenate([last[ok], each[ok2]])]), axis=1)
    return both[0], both[1], _hash(lines, both[0], both[1])


def _hash(lines: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    total, down = _prefix(lines.view(U), _OF_WORDS)
    with np.errstate(over="ignore"):
        return mix((total[last + 1] - total[first]) * down[first] + (last - first).astype(U))


def keys_of(seqs: DataFrame, least: int, couples: bool) -> DataFrame:
    """doc_id, text_key, key, run: the hashes of its runs (run null) and, for couples, of each with the line after it (run: its own).

    seqs: doc_id, text_key, lines, sizes."""

    def distinct(ids: np.ndarray, texts: np.ndarray, own: np.ndarray, h: np.ndarray, run: np.ndarray | None) -> pa.RecordBatch:
        order = np.lexsort((h, own))
        new = np.ones(len(h), bool)
        new[1:] = (own[order][1:] != own[order][:-1]) | (h[order][1:] != h[order][:-1])
        at = order[new]
        return as_batch(KEY, ids[own[at]], texts[own[at]], h[at].view(np.int64), np.full(len(at), None, object) if run is None else run[at].view(np.int64))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, col = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy(), batch.column("lines")
            lines, sizes = (c.flatten().to_numpy(zero_copy_only=False) for c in (col, batch.column("sizes")))
            at = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())]).astype(np.int64)
            doc = np.repeat(np.arange(len(ids)), np.diff(at))
            first, last, h = runs(lines, sizes, at, least)
            own = doc[first]
            yield distinct(ids, texts, own, h, None)
            if couples:
                solid = np.append(np.flatnonzero(lines), len(lines))
                after = solid[np.searchsorted(solid, last, "right")]
                ok = after < at[own + 1]
                yield distinct(ids, texts, own[ok], _hash(lines, first[ok], after[ok]), h[ok])

    return seqs.mapInArrow(find, "doc_id long, text_key long, key long, run long")


def pairs_of(seqs: DataFrame, rare: int | None, least: int) -> DataFrame:
    """doc_id, text_key, other_id, other_key: each document with the smallest holder of each of its keys."""
    keys = saved(keys_of(seqs, least, rare is not None), "keys")

    def known(k: DataFrame, name: str) -> DataFrame:
        held = k.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_key")).alias("first"), F.max("doc_id").alias("last_id"))
        held = held.where("first.doc_id < last_id").select("key", "n", F.col("first.doc_id").alias("other_id"), F.col("first.text_key").alias("other_key"))
        return saved(held, name)  # written, so that a join with it can split a hot key

    own = keys.where("run is null").select("doc_id", "text_key", "key")
    first = known(own, "lines")
    if rare is None:
        shared = own.join(first, "key")
    else:
        common = first.where(F.col("n") > rare).select(F.col("key").alias("run"))
        couple = saved(keys.join(common, "run").select("doc_id", "text_key", "key").distinct(), "couples")
        shared = own.join(first.where(F.col("n") <= rare), "key").unionByName(couple.join(known(couple, "first-couples"), "key"))
    return saved(shared.where("doc_id > other_id").select("doc_id", "text_key", "other_id", "other_key").distinct(), "pairs")


def aligned(seqs: DataFrame, rare: int | None, least: int) -> DataFrame:
    """doc_id, text_key, at: the lines that are deleted, for each pair that has such."""
    pairs = pairs_of(seqs, rare, least)
    earlier = seqs.select(F.col("doc_id").alias("other_id"), F.col("text_key").alias("other_key"), F.col("lines").alias("a"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, key, a, b, sizes in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text_key", "a", "b", "sizes"))):
                if at := common_blocks(a, b, sizes, least):
                    out.append((doc_id, key, at))
            if out:
                yield as_batch(CUT, *zip(*out))

    both = pairs.join(seqs.withColumnRenamed("lines", "b"), ["doc_id", "text_key"]).join(earlier, ["other_id", "other_key"])
    return saved(both.mapInArrow(align, "doc_id long, text_key long, at array<int>"), "cuts")


def line_dedup(docs: DataFrame, rare: int | None = None, min_chars: int = MIN_CHARS, others: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_lines, n_removed, n_partners (earlier documents aligned with), kept: the text without the deleted lines.

    others: columns of docs to hand on."""
    docs = documents(docs, *others)
    copies = copies_of(docs)
    firsts = without(docs, copies, ("doc_id", "text_key")).where("doc_id is not null and text is not null")
    blank = "length(trim(both ' \\t\\r\\u000b\\u000c' from x)) = 0"
    seqs = saved(
        firsts.select("doc_id", "text_key", F.split("text", "\n", -1).alias("l"))
        .select("doc_id", "text_key", F.expr(f"transform(l, x -> case when {blank} then 0L else xxhash64(x) end)").alias("lines"), F.expr(f"transform(l, x -> case when {blank} then 0 else octet_length(x) end)").alias("sizes"))
        .dropDuplicates(["doc_id", "text_key"]),
        "sequences",
    )
    cuts = aligned(seqs, rare, min_chars)
    marks = (
        cuts.groupBy("doc_id", "text_key").agg(F.count("*").alias("n_partners"), F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")).withColumn("whole", F.lit(False))
        .unionByName(copies.select("doc_id", "text_key", F.lit(1).cast("long").alias("n_partners"), F.lit(None).cast("array<int>").alias("at"), F.lit(True).alias("whole")))
    )

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, n, at, whole in zip(*(batch.column(k) for k in ("doc_id", "text", "n_partners", "at", "whole"))):
                text = text.as_py()
                if text is None:
                    out.append((doc_id.as_py(), 0, 0, 0, None))
                elif whole.as_py() and len(text.encode()) >= min_chars:
                    out.append((doc_id.as_py(), k := text.count("\n") + 1, k, 1, ""))
                elif not at.is_valid:
                    out.append((doc_id.as_py(), text.count("\n") + 1, 0, 0, text))
                else:
                    gone, lines = set(at.as_py()), text.split("\n")
                    kept = [x for i, x in enumerate(lines) if i not in gone]
                    out.append((doc_id.as_py(), len(lines), len(lines) - len(kept), n.as_py(), "\n".join(kept)))
            if out:
                own = as_batch(RESULT, *zip(*out))
                yield pa.RecordBatch.from_arrays([*own.columns, *(batch.column(c) for c in others)], names=[*RESULT.names, *others])

    schema = T.StructType.fromDDL("doc_id long, n_lines long, n_removed long, n_partners long, kept string")
    return docs.join(marks, ["doc_id", "text_key"], "left").mapInArrow(delete, T.StructType([*schema.fields, *(docs.schema[c] for c in others)]))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_removed", "n_partners", F.sha2("kept", 256).alias("kept_sha256"))
