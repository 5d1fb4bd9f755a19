"""N-gram Jaccard join: a MinHash LSH forest over 5-word shingles, with exact verification.

Documents with equal shingle sets are one node; the join runs on nodes. A node has TREES labels of DEPTH minhashes (8
bits each, so a label is one 64-bit path in a prefix trie). The labels of each tree are sorted over the cluster, and
each carries the longest prefix that it shares with a neighbour: these are the tries. Prefixes start at full length and
are shortened, one tree at a time, until the chance that a pair at the threshold shares a matched prefix in some
tree reaches `recall`; the tree that is shortened next is the one where that brings the fewest new neighbours for the
recall that it adds, as counted in the sorted labels. So depths follow the data, and the recall is the same for all.

Nodes below one trie node at its tree's depth are a bucket. In a bucket labels are compared: a pair at the threshold
agrees in 128 of 160 minhashes on average with deviation 5, so pairs with fewer than MATCHES (96) are not followed. What
remains links nodes to candidate clusters; these are verified exactly on whole shingle sets, each set sent once a
block couple: a cluster of up to BLOCK nodes is one unit, a larger one is parted by size bands (sets whose sizes
differ by more than the threshold are never compared) and blocks, each couple of blocks a unit, so no task holds a
whole group. A unit returns, for each node, its number of links and one link to the smallest node it reaches, never
the pairs themselves. Components of those links are the near-duplicate classes.

Defined cases: a text of 1 to 4 words has one shingle, the whole; null, empty or blank texts have none: each is a
class of its own without links; rows that repeat a doc_id with the same text count once and get one result row, with
other texts they are documents of their own (so the doc_id has several rows); a null doc_id is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._common import Listed, as_batch, documents, groups, parts, row_hash, saved
from ._graph import components
from ._words import U, hashes, mix, per_doc, pieces, shingles, words

TREES, DEPTH, THRESHOLD, RECALL, BLOCK, LABEL_BLOCK, MATCHES = 20, 8, 0.8, 0.9999, 512, 4096, 0.6
SIGNATURE = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("labels", pa.list_(pa.int64()))])
PATH = pa.schema([("node", pa.int64()), ("tree", pa.int32()), ("label", pa.int64()), ("before", pa.int32()), ("near", pa.int32())])
SETS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("shingles", pa.binary())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
LINKS = pa.schema([("node", pa.int64()), ("n_links", pa.int64()), ("low", pa.int64())])
with np.errstate(over="ignore"):
    _SEEDS = mix(np.arange(1, TREES * DEPTH + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def labels(s: np.ndarray) -> np.ndarray:
    """The trie path of a shingle set in each tree: DEPTH minhashes, 8 bits of each, the first the highest."""
    low = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, U)
    with np.errstate(over="ignore"):
        for at in range(0, len(s), 256):  # blocks that stay in the cache
            x = (s[at : at + 256, None] ^ _SEEDS) * U(0x9FB21C651E98DF25)
            x ^= x >> U(32)
            low = np.minimum(low, (x * U(0xD6E8FEB86659FD93)).min(0))
    # mixed, as the least values' own high bits are nearly all zero
    return (mix(low) >> U(56)).astype(np.uint8).reshape(TREES, DEPTH).view(">u8")[:, 0].astype(U)


def minhashes(column: pa.ListArray | pa.ChunkedArray) -> np.ndarray:
    """The minhashes of rows of labels: n x (TREES * DEPTH) bytes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().astype(">i8").view(np.uint8).reshape(-1, TREES * DEPTH)


def depths(counts: dict[tuple[int, int], int], threshold: float, recall: float) -> list[int]:
    """The prefix length of each tree. counts: (tree, length) -> neighbours in the sorted labels that share just that much."""
    out = [DEPTH] * TREES
    miss = lambda d: math.log1p(-(threshold**d)) if d and threshold < 1 else -math.inf
    while sum(map(miss, out)) > math.log1p(-recall) and any(d > 1 for d in out):
        cost = {t: (1 + counts.get((t, d - 1), 0)) / (miss(d) - miss(d - 1)) for t, d in enumerate(out) if d > 1}
        out[min(cost, key=lambda t: (cost[t], -out[t], t))] -= 1
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist()
        for p in pieces(batch.column("text")):
            w = words(p)
            out = []
            for doc_id, key, h in zip(ids[p.lo : p.hi], keys[p.lo : p.hi], per_doc(w, hashes(p, w))):
                s = shingles(h)
                with np.errstate(over="ignore"):
                    node = mix(mix(s).sum(dtype=U).reshape(1) ^ mix(mix(s + U(0x51ED270B)).sum(dtype=U).reshape(1)) + U(len(s)))
                out.append((doc_id, key, int(node.view(np.int64)[0]), len(s), labels(s).view(np.int64) if len(s) else None))
            yield as_batch(SIGNATURE, *zip(*out))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted labels with the prefix (in minhashes) shared with the label before, and with the nearer neighbour.
    What lies before and after a partition is not known: there the prefix counts as whole."""

    def shared(a: np.ndarray, b: np.ndarray, same_tree: np.ndarray) -> np.ndarray:
        x = (a ^ b).astype(">u8").view(np.uint8).reshape(-1, 8) != 0
        return np.where(same_tree, np.where(x.any(1), x.argmax(1), DEPTH), 0)

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, label = batch.column("tree").to_numpy(), batch.column("label").to_numpy().view(U)
        before = np.zeros(len(tree), np.int64)
        before[1:] = shared(label[1:], label[:-1], tree[1:] == tree[:-1])
        before[0] = -1 if held is None else shared(label[:1], held[2][-1:], tree[:1] == held[1][-1:])[0]
        if held is not None:
            yield _near(held, before[0])
        held = (batch.column("node").to_numpy(), tree, label, before)
    if held is not None:
        yield _near(held, DEPTH)


def _near(held: tuple, after: int) -> pa.RecordBatch:
    node, tree, label, before = held
    own = np.where(before < 0, DEPTH, before)
    return as_batch(PATH, node, tree, label.view(np.int64), np.maximum(before, 0), np.maximum(own, np.append(own[1:], after)))


def joined_rows(m: np.ndarray, n: np.ndarray, threshold: float, matches: float) -> np.ndarray:
    """The smallest row that each row is linked to, over chains. Rows are compared with those not reached yet only, so
    a group of alike rows costs little more than one pass."""
    low = np.arange(len(m))
    todo = np.arange(len(m))
    need = int(matches * m.shape[1])
    while len(todo) > 1:
        seed, todo = todo[0], todo[1:]
        queue = [seed]
        while queue and len(todo):
            r = queue.pop()
            close = (m[todo] == m[r]).sum(1) >= need
            close &= np.minimum(n[todo], n[r]) >= threshold * np.maximum(n[todo], n[r]) - 1e-6
            reached = todo[close]
            low[reached] = seed
            todo = todo[~close]
            queue += reached.tolist()
    return low


def _candidates(threshold: float, matches: float):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for t in groups(batches, ["tree", "prefix", "one", "two"]):
            t = t.sort_by("node")
            node = t["node"].to_numpy()
            low = joined_rows(minhashes(t["labels"]), t["n"].to_numpy(), threshold, matches)
            at = np.flatnonzero(low != np.arange(len(low)))
            out += zip(node[at].tolist(), node[low[at]].tolist())
            if len(out) > 20_000:
                yield as_batch(EDGES, *zip(*out))
                out = []
        if out:
            yield as_batch(EDGES, *zip(*out))

    return stream


def _sets(listed):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(listed.value.has(batch.column("h").to_numpy())))
            ids, keys = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
            for p in pieces(batch.column("text")):
                w = words(p)
                yield as_batch(SETS, ids[p.lo : p.hi], keys[p.lo : p.hi], [shingles(h).tobytes() for h in per_doc(w, hashes(p, w))])

    return stream


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    if n == 2:
        out[:] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return out
    of = np.repeat(np.arange(n), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[col] > 1
    of, col = of[keep], (np.cumsum(count > 1) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    of, col = of[order], col[order]
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, 2048):
        a, b = np.searchsorted(col, [lo, lo + 2048])
        m = np.zeros((n, 2048), np.float32)
        m[of[a:b], col[a:b] - lo] = 1
        out += m @ m.T
    return out


def _verify(threshold: float):
    def unit(t: pa.Table) -> list[tuple[int, int, int]]:
        node, first = np.unique(t["node"].to_numpy(), return_index=True)
        side = t["one"].to_numpy() == t["own"].to_numpy()
        side = side[first]
        sets = [np.frombuffer(t["shingles"][int(i)].as_buffer(), U) for i in first]
        common = shared_counts(sets)
        size = np.array([len(s) for s in sets], np.float32)
        i, j = np.nonzero(np.triu(common >= threshold * (size[:, None] + size[None] - common) - 1e-6, 1))
        if t["one"][0] != t["two"][0]:
            apart = side[i] != side[j]
            i, j = i[apart], j[apart]
        if not len(i):
            return []
        degree = np.bincount(i, minlength=len(node)) + np.bincount(j, minlength=len(node))
        low = np.arange(len(node))
        while True:  # smallest row reached
            new = low.copy()
            np.minimum.at(new, i, low[j])
            np.minimum.at(new, j, low[i])
            new = new[new]
            if (new == low).all():
                break
            low = new
        at = np.flatnonzero(degree)
        return list(zip(node[at].tolist(), degree[at].tolist(), node[low[at]].tolist()))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for t in groups(batches, ["cluster", "one", "two"]):
            out += unit(t)
            if len(out) > 20_000:
                yield as_batch(LINKS, *zip(*out))
                out = []
        if out:
            yield as_batch(LINKS, *zip(*out))

    return stream


def forest(heads: DataFrame, threshold: float, recall: float) -> DataFrame:
    """node, tree, prefix, m: the buckets of the forest with two nodes or more (m of them). heads: node, labels.
    Buckets of several trees with the same nodes are kept once."""
    spark = heads.sparkSession
    spread = heads.select("node", F.posexplode("labels").alias("tree", "label"))
    ordered = spread.repartitionByRange(parts(spark, 24 * TREES * heads.count()), "tree", "label", "node").sortWithinPartitions("tree", "label")
    paths = saved(ordered.mapInArrow(_neighbours, "node long, tree int, label long, before int, near int"), "paths")
    counts = {(r.tree, r.before): r["count"] for r in paths.groupBy("tree", "before").count().collect()}  # a row a tree and length
    chosen = depths(counts, threshold, recall)
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("tree") + 1)
    prefix = F.coalesce(*[F.when(F.col("tree") == t, F.shiftrightunsigned("label", 8 * (DEPTH - d))) for t, d in enumerate(chosen)])
    met = paths.where(F.col("near") >= of(chosen)).select("node", "tree", prefix.alias("prefix"))
    buckets = met.groupBy("tree", "prefix").agg(F.count("*").alias("m"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who")).where("m > 1")
    once = buckets.groupBy("m", "who").agg(F.min(F.struct("tree", "prefix")).alias("b")).select("b.tree", "b.prefix", "m")
    return saved(met.join(saved(once, "once"), ["tree", "prefix"]), "buckets")


def clusters(heads: DataFrame, threshold: float, recall: float, matches: float) -> DataFrame:
    """id (a node), component: the candidate clusters."""
    spark = heads.sparkSession
    met = forest(heads, threshold, recall).withColumn("blocks", F.ceil(F.col("m") / LABEL_BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    units = (
        met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("node", "tree", "prefix", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
        .join(heads, "node")
    )
    keys = ["tree", "prefix", "one", "two"]
    sent = met.agg(F.sum("blocks")).first()[0] or 0
    edges = units.repartition(parts(spark, sent * (8 * TREES + 48)), *keys).sortWithinPartitions(*keys).mapInArrow(_candidates(threshold, matches), "a long, b long")
    return components(edges)


def ngram_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, matches: float = MATCHES) -> DataFrame:
    """doc_id, text_key (a hash of the text), class_id (smallest doc_id of its near-duplicate class), is_first (whether
    this is the document of its class with the smallest doc_id), copy_of (smallest doc_id with the same shingle set),
    n_copies (other documents with that set), n_links (other shingle sets at the threshold or above)."""
    spark = docs.sparkSession
    docs = documents(docs).where("doc_id is not null")
    signed = saved(docs.mapInArrow(_signatures, "doc_id long, text_key long, node long, n int, labels array<long>"), "signatures")
    rows = saved(signed.select("doc_id", "text_key", "node", "n").distinct(), "rows")
    full, bare = rows.where("n > 0"), rows.where("n = 0")
    of_node = full.groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("head"), F.count("*").alias("copies"))
    of_node = saved(of_node, "nodes")  # so that the joins below can split the rows of a hot set
    heads = saved(signed.where("n > 0").select("node", "n", "labels").dropDuplicates(["node"]), "heads")
    cluster = clusters(heads, threshold, recall, matches).select(F.col("id").alias("node"), F.col("component").alias("cluster"))
    cluster = saved(cluster.join(of_node, "node").join(heads.select("node", "n"), "node").select("node", "cluster", "n", F.col("head.doc_id").alias("doc_id"), F.col("head.text_key").alias("text_key")), "clusters")
    # blocks of the large clusters: by size bands a little wider than the threshold, then by hash
    size = cluster.groupBy("cluster").agg(F.count("*").alias("m"))
    band = F.when(F.col("m") > BLOCK, F.floor(F.log("n") / (math.log(1 / threshold) * 1.0001) if threshold < 1 else F.col("n"))).otherwise(0).cast("int")
    placed = cluster.join(saved(size, "sizes"), "cluster").withColumn("band", band)
    bands = saved(placed.groupBy("cluster", "band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "bands")
    near_bands = bands.select("cluster", F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])).alias("band"), F.col("band").alias("other_band"), "blocks")
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks"))
    placed = placed.join(bands, ["cluster", "band"]).withColumn("own", F.struct(F.col("band"), own.cast("int").alias("block"))).drop("blocks")
    placed = saved(placed.select("node", "doc_id", "text_key", "n", "cluster", "band", (F.col("band") * F.lit(1 << 32) + F.col("own.block")).cast("long").alias("own")), "placed")
    fan = near_bands.groupBy("cluster", "band").agg(F.sum("blocks").alias("times"))
    sent = placed.join(fan, ["cluster", "band"]).agg(F.sum(F.col("times") * (F.col("n") * 8 + 56))).first()[0] or 0
    listed = spark.sparkContext.broadcast(Listed(placed))
    sets = docs.withColumn("h", row_hash()).mapInArrow(_sets(listed), "doc_id long, text_key long, shingles binary").join(placed, ["doc_id", "text_key"])
    other = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (F.col("other_band") * F.lit(1 << 32) + j).cast("long")))
    couples = saved(near_bands.withColumn("other", other).select("cluster", "band", "other"), "couples").groupBy("cluster", "band").agg(F.collect_list("other").alias("others"))
    units = sets.join(couples, ["cluster", "band"]).select("node", "shingles", "cluster", "own", F.explode("others").alias("other")).withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))
    keys = ["cluster", "one", "two"]
    links = units.select("node", "shingles", "own", *keys).repartition(parts(spark, sent), *keys).sortWithinPartitions(*keys)
    links = saved(links.mapInArrow(_verify(threshold), "node long, n_links long, low long"), "links")
    near = components(links.select(F.col("node").alias("a"), F.col("low").alias("b"))).select(F.col("id").alias("node"), "component")
    degree = links.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    linked = saved(degree.join(near, "node").join(of_node.select("node", "head"), "node"), "linked")
    top = saved(linked.groupBy("component").agg(F.min("head").alias("top")), "tops")
    known = saved(linked.join(top, "component").select("node", "n_links", "top"), "known")
    top = F.coalesce("top", "head")
    out = full.join(of_node, "node").join(known, "node", "left").select(
        "doc_id", "text_key", top["doc_id"].alias("class_id"), (F.struct("doc_id", "text_key") == top).alias("is_first"), F.col("head.doc_id").alias("copy_of"), (F.col("copies") - 1).alias("n_copies"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    zero = F.lit(0).cast("long")
    return out.unionByName(bare.select("doc_id", "text_key", F.col("doc_id").alias("class_id"), F.lit(True).alias("is_first"), F.col("doc_id").alias("copy_of"), zero.alias("n_copies"), zero.alias("n_links")))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "copy_of", "n_copies", "n_links")
