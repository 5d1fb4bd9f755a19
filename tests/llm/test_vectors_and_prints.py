"""op11, op12 and op13 against brute force, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomtext.llm import op11_resampling as op11, op12_clustering as op12, op13_simhash as op13

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, fp long, key string, rank int, _row int, n_words int"
RNG = random.Random(5)
VOCAB = ["".join(RNG.choice("abcdeéüñXY09") for _ in range(RNG.randrange(1, 9))) for _ in range(300)]


def say(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def table(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 3, "k", 4, 5, 6) for i, t in zip(ids, texts)], SCHEMA).repartition(3)


def runs_of(text):
    words, word = [], b""
    for b in (text or "").encode() + b" ":
        b = b + 32 if 65 <= b <= 90 else b
        if 0x30 <= b < 0x3A or 0x61 <= b < 0x7B or b >= 0x80:
            word += bytes([b])
        elif word:
            words.append(word)
            word = b""
    return words, [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def resampled(docs, bench):
    bucket = lambda texts: Counter(zlib.crc32(g) % 10000 for t in texts for g in runs_of(t)[1])
    s, t = bucket(x for _, x in docs), bucket(bench)
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    out = []
    for i, x in docs:
        words, grams = runs_of(x)
        weight = sum(gain(zlib.crc32(g) % 10000) for g in grams)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(grams), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(repr, (r[:5] for r in out)))


def test_op11_equals_brute_force(spark, monkeypatch):
    texts = [say(RNG.randrange(15, 60)) for _ in range(150)] + [None, "", " \t.,", "one", "A-b_C  d", say(5000), "é", "ß" * 3000, "a" * 200_000, say(30) + " " + say(5)]
    docs = [*enumerate(texts), (7, texts[7]), (7, say(40)), (None, say(50))]
    bench = [say(40), None, "", texts[3], "x"]
    df = table(spark, [t for _, t in docs], [i for i, _ in docs])
    target = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(bench)], "item_id long, text string, n_features string")
    for block in (300, 4 << 20):  # many dictionaries and one
        monkeypatch.setattr(op11, "BLOCK", block)
        got = op11.resample(df, target).select("doc_id", "n_features", "weight", "score", "rank").collect()
        assert sorted(repr(list(r)) for r in got) == resampled(docs, bench)


def test_op11_empty_tables(spark):
    none = table(spark, ["x"]).limit(0)
    target = spark.createDataFrame([], "item_id long, text string")
    assert op11.resample(none, target).collect() == []
    assert {r.n_features for r in op11.resample(table(spark, [say(30), None]), target).collect()} == {87, 0}


def test_ranks_over_many_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        values = [RNG.randrange(40) for _ in range(3000)]
        df = spark.createDataFrame(list(enumerate(values)), "doc_id long, score long").repartition(7)
        got = {r.doc_id: r["rank"] for r in op11.ranked(df, F.desc("score"), "doc_id").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {i: k + 1 for k, (i, _) in enumerate(sorted(enumerate(values), key=lambda x: (-x[1], x[0])))}


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, 1, 2, "c") for i, x in rows], "vec_id long, embedding array<double>, label int, distance int, cluster string").repartition(3)


def clustered(rows, k=16):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) and math.isfinite(64 * v) for v in x):
            kept.append((i, [math.floor(64 * v) for v in x]))
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    c = [x for _, x in first]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))
    for _ in range(3):
        of = [near(x)[1] for _, x in kept]
        for j in range(len(c)):
            own = [x for (_, x), o in zip(kept, of) if o == j]
            if own:
                c[j] = [sum(v) // len(own) for v in zip(*own)]
    found = [(i, *near(x)) for i, x in kept]
    big = (1 << 63) - 1
    sums = Counter()
    for _, d, j in found:
        sums[j] += min(d, big)
    return sorted(repr([i, j, min(d, big), min(sums[j], big), min(sum(sums.values()), big), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()]) for i, d, j in found)


@pytest.mark.parametrize("size", [1.0, 3e5, 1e12, 1e300])
def test_op12_equals_brute_force(spark, size):
    """Within the bound of float64, across it, and far beyond."""
    r = np.random.default_rng(3)
    centres = r.normal(0, size, (9, 64))
    rows = [(i, (centres[i % 9] + r.normal(0, size / 5, 64)).tolist()) for i in range(120)]
    rows += [(3, rows[3][1]), (4, rows[5][1]), (None, rows[6][1]), (900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [0.0] * 63), (905, [math.nan] * 64), (906, [math.inf] * 64), (907, [-0.0] * 64), (908, [1.7e308] * 64), (909, [0.01] * 64)]
    got = op12.cluster_vectors(vectors(spark, rows)).collect()
    assert sorted(repr(list(r)) for r in got) == clustered(rows)


def test_op12_few_and_no_vectors(spark):
    assert op12.cluster_vectors(vectors(spark, [(1, None)])).collect() == []
    assert op12.cluster_vectors(vectors(spark, [(1, None)]).limit(0)).collect() == []
    rows = [(1, [0.0] * 64), (2, [1.0] * 64), (2, [1.0] * 64)]
    got = op12.cluster_vectors(vectors(spark, rows)).collect()
    assert sorted(repr(list(r)) for r in got) == clustered(rows)
    alone = op12.cluster_vectors(vectors(spark, [(None, [0.5] * 64)])).collect()
    assert [(r.cluster, r.distance, r.centroid_sha256) for r in alone] == [(None, None, None)]


def test_op12_ties_go_to_the_smaller_number():
    label, distance = op12.nearest(np.array([[1.0, 0.0], [5.0, 5.0]]), [[0, 0], [2, 0], [0, 0]])
    assert label.tolist() == [0, 1] and distance.tolist() == [1, 34]


def fingerprint(text):
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_classes(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    nodes = sorted({f for i, f in prints if i is not None})
    root = {f: f for f in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(nodes):
        for b in nodes[n + 1 :]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, f in prints:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(repr([i, f"{f:016x}", None if i is None else least[find(f)]]) for i, f in prints)


@pytest.mark.parametrize("chain,block", [(3, 2048), (5, 2048), (7, 2048), (3, 7), (7, 5)])
def test_op13_equals_brute_force(spark, monkeypatch, chain, block):
    base = say(400).split(" ")
    near = []
    for _ in range(60):
        w = base[:]
        for _ in range(RNG.randrange(6)):
            w[RNG.randrange(len(w))] = RNG.choice(VOCAB)
        near.append(" ".join(w))
    texts = near + [say(RNG.randrange(1, 80)) for _ in range(60)] + [None, "", "  \n", "One", "one two THREE", "a b c d", "A\tb\x0bc  d", "x" * 100_000, say(4000), "。" * 9, "一 二 三 四 五"]
    rows = [*enumerate(texts), (3, texts[3]), (3, say(9)), (None, near[0]), (None, None), (500, near[2])]
    plain = op13.near_prints
    monkeypatch.setattr(op13, "near_prints", lambda nodes: plain(nodes, block, chain))
    got = op13.simhash_dedup(table(spark, [t for _, t in rows], [i for i, _ in rows])).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(repr(list(r)) for r in got) == simhash_classes(rows)


def test_op13_empty(spark):
    assert op13.simhash_dedup(table(spark, ["x"]).limit(0)).collect() == []


@pytest.mark.parametrize("chain", [3, 5, 7])
def test_chains_lose_no_pair_within_the_radius(chain):
    r = np.random.default_rng(2)
    a = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = a.copy()
    for n in range(len(b)):
        # of one segment, of neighbours, of anywhere
        places = r.choice([range(8), range(20), range(64)][n % 3], n % 5, replace=False) + r.integers(64)
        for p in places:
            b[n] ^= np.uint64(1) << np.uint64(p % 64)
    one, begin = op13.keys(a, chain)
    two, _ = op13.keys(b, chain)
    met = np.zeros(len(a), bool)
    for k in range(one.shape[1]):
        s = np.full(len(a), begin[k])
        met |= (one[:, k] == two[:, k]) & op13.near(op13.turned(a, s), op13.turned(b, s), chain)
    assert met.all()
    c = b ^ np.uint64(0b11111 << 20)
    far = np.bitwise_count(a ^ c) > 4
    assert not op13.near(a[far], c[far], chain).any()


def test_large_keys_are_walked():
    r = np.random.default_rng(4)
    ring = np.unique(np.uint64(77 << 40) ^ (np.uint64(1) << r.integers(0, 60, 900, dtype=np.uint64)) ^ (np.uint64(1) << r.integers(0, 60, 900, dtype=np.uint64)))
    at, low = op13.links(np.zeros(len(ring), np.uint64), ring, 3)
    pairs = [(i, j) for i in range(len(ring)) for j in range(i) if op13.near(ring[[i]], ring[[j]], 3)[0]]
    want = op13.forest(len(ring), *map(np.array, zip(*pairs)))
    assert len(ring) > op13.SMALL and (op13.forest(len(ring), at, low) == want).all()
