"""The dealt operators and the pipeline against brute force, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtext.llm import _sketch, _words as W
from loomtext.llm._graph import components
from loomtext.llm.op1_substring_dedup import substring_dedup
from loomtext.llm.op2_suffix_tree import suffix_tree_scores
from loomtext.llm.op3_language_crf import Crf, identify
from loomtext.llm.op4_decontamination import decontaminate
from loomtext.llm.op5_quality_rules import binomial_tail, counts, quality_rules
from loomtext.llm.op6_suffix_array import multikey_quicksort, suffix_dedup
from loomtext.llm.op7_mixing import mix_sources
from loomtext.llm.op8_ngram_join import DEPTH, TREES, depths, joined_rows, labels, minhashes, ngram_join
from loomtext.llm.op9_line_dedup import common_blocks, line_dedup, patience
from loomtext.llm.op10_url_filter import by_rule, split_url, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos int, a string, window string, _bucket string"
RNG = random.Random(11)
VOCAB = ["".join(RNG.choice("abcdeéüñ") for _ in range(RNG.randrange(1, 9))) for _ in range(400)]


def say(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def corpus():
    passage, text = say(70), say(300)
    words = text.split(" ")
    near = words[:]
    near[150] = "changed"
    texts = [
        text, text, " ".join(near), say(40) + "\n" + passage + "\n" + say(30), passage, say(9) + "\t\x0b" + passage[:-3] + say(5), None, "", "  \n ", "one", "one", "one two three four",
        "\n".join([say(12), passage, say(12)]), "spam " * 200, "spam " * 90, "\n".join(say(15) for _ in range(12)), say(2500), "x" * 400, "y" + "x" * 200, "。" * 60 + say(60), "é" * 130,
    ]
    return texts


def rows(texts, sources=("s1", "s2", None)):
    return [(i, t, None if i % 7 == 3 else ("en", "fr")[i % 2], sources[i % len(sources)], len(t or ""), i, "a", "w", "b") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    data = rows(corpus())
    return spark.createDataFrame([*data, data[0], (None, say(60), "en", "s1", 1, 1, "", "", "")], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}


def test_words_are_those_of_split(spark):
    import pyarrow as pa

    texts = [*corpus(), "a\x0bb\x0cc\rd\te\nf  g", "é ü"]
    for size in (7, 1 << 20):
        found = []
        for p in W.pieces(pa.array(texts), size):
            w = W.words(p)
            own = [bytes(p.data[s:e]) for s, e in zip(w.start, w.end)]
            found += [own[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        assert found == [(t or "").encode().split() for t in texts]


def test_sketch_never_underestimates():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 1 << 62, 5000).astype(np.uint64)
    twice = keys[:700]
    count = {}
    for part in (keys, twice):
        for batch in _sketch.of_partition(part, 16):
            for block, once, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
                c = count.setdefault(block, np.zeros(_sketch.BLOCK, int))
                c[np.frombuffer(once, np.uint16)] += 1
                c[np.frombuffer(more, np.uint16)] += 2
    bits = np.zeros((_sketch.ROWS, _sketch.BLOCK // 8), np.uint8)
    for block, c in count.items():
        bits[block] = np.packbits(c > 1)
    assert _sketch.repeated(bits, twice, 16).all()
    assert _sketch.repeated(bits, keys[700:], 16).mean() < 0.05


def test_op1(spark, docs, none):
    n, first, own = 50, {}, {k: t.encode().split() for k, t in texts_of(docs).items()}
    for k in sorted(own):
        for i in range(len(own[k]) - n + 1):
            first.setdefault(tuple(own[k][i : i + n]), k)
    got = substring_dedup(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        w = own[r.doc_id]
        gone = [any(first[tuple(w[j : j + n])] < r.doc_id for j in range(max(0, i - n + 1), min(i, len(w) - n) + 1)) for i in range(len(w))]
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest()), r.doc_id
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
    assert any(r.n_removed for r in got) and substring_dedup(none).count() == 0


def test_op6(spark, docs, none):
    n, first, own = 50, {}, {k: t.encode() for k, t in texts_of(docs).items()}
    for k in sorted(own):
        for i in range(len(own[k]) - n + 1):
            first.setdefault(own[k][i : i + n], k)
    got = suffix_dedup(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
            continue
        t = own[r.doc_id]
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - n + 1):
            if first[t[i : i + n]] < r.doc_id:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()), r.doc_id
    assert any(r.n_spans > 0 for r in got) and suffix_dedup(none).count() == 0


def test_op6_over_many_small_buckets_and_chunks(spark, monkeypatch):
    import loomtext.llm._chunks as chunks

    monkeypatch.setattr(chunks, "CHUNK", 3000)
    hot, odd = "a lead of bytes that all of them share", "z" * 30 + "\0" * 40 + "q\0" * 30
    texts = [say(12)[: RNG.randrange(30)] + hot + say(8)[: RNG.randrange(20, 40)] + RNG.choice(["alpha beta gamma delta", "omega psi chi phi"]) for _ in range(300)] + [say(30) + odd, odd + "x", "y" + odd, say(5) + odd[5:70] + "t"]
    want, first = {}, {}
    for k, t in enumerate(texts):
        raw = t.encode()
        for i in range(len(raw) - 49):
            first.setdefault(raw[i : i + 50], k)
    for k, t in enumerate(texts):
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            gone[i : i + 50] |= first[raw[i : i + 50]] < k
        want[k] = int(gone.sum())
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(5)
    for part_bytes in (600, 5000):
        assert {r.doc_id: r.n_removed for r in suffix_dedup(df, part_bytes=part_bytes).collect()} == want
    assert sum(want.values()) > 500


def test_multikey_quicksort_sorts():
    keys = np.random.default_rng(1).integers(0, 4, (3000, 5)).astype(np.uint64)
    assert [tuple(x) for x in keys[multikey_quicksort(keys)]] == sorted(tuple(x) for x in keys)


def test_op2_base_and_model(spark, docs, none):
    low = lambda b: bytes(c + 32 if 65 <= c <= 90 else c for c in b)
    all_ = [(r.doc_id, [*low((r.text or "").encode()).split(), None]) for r in docs.collect()]
    train = [t for k, t in all_ if k is not None and zlib.crc32(str(k).encode()) % 5 != 1]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    own = dict(all_)
    got = suffix_tree_scores(docs).collect()
    assert len(got) == len(all_)
    for r in got:
        t = own[r.doc_id]
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 1) and r.score < 0
    assert suffix_tree_scores(none).count() == 0


def plain_tree(texts, train, depth=2):
    """Scores by a suffix tree in plain dicts."""
    from loomtext.llm.op2_suffix_tree import MIN_COUNT, MIN_WORD, PENALTY, STEPS, STRENGTH

    c = Counter(w for t, ok in zip(texts, train) if ok for w in t)
    n, v = sum(c.values()), len(c)
    p = [[(c[w] + 0.5) / (n + 0.5 * (v + 1)) for w in t] for t in texts]
    for k in range(1, depth + 1):
        follows, before = defaultdict(Counter), {}
        for t, ok, q in zip(texts, train, p):
            for i in range(k, len(t)):
                before[tuple(t[i - k : i]), t[i]] = 10 ** (-min(255, round(-STEPS * math.log10(q[i]))) / STEPS)
                if ok:
                    follows[tuple(t[i - k : i])][t[i]] += 1
        total = {}
        for ctx, nexts in follows.items():
            seen = {w: m for w, m in nexts.items() if c[w] >= MIN_WORD}
            m = sum(seen.values())
            grown = (c[ctx[0]] if k == 1 else shorter[ctx[:-1]][ctx[-1]]) >= MIN_COUNT  # tokens after it in training
            gain = sum(x * math.log((x - 1 + STRENGTH * before[ctx, w]) / ((m - 1 + STRENGTH) * before[ctx, w])) for w, x in seen.items()) if m else 0
            if grown and m and gain > PENALTY:
                total[ctx] = m
        p = [[q[i] if i < k or tuple(t[i - k : i]) not in total else ((follows[tuple(t[i - k : i])][w] if c[w] >= MIN_WORD else 0) + STRENGTH * q[i]) / (total[tuple(t[i - k : i])] + STRENGTH) for i, w in enumerate(t)] for t, q in zip(texts, p)]
        shorter = follows
    return [sum(math.log10(x) for x in q) for q in p]


def test_op2_is_the_plain_tree_over_chunks_and_owners(spark, monkeypatch):
    import loomtext.llm._chunks as chunks

    monkeypatch.setattr(chunks, "CHUNK", 4000)
    few = VOCAB[:60]
    texts = [" ".join(RNG.choice(few) if RNG.random() < 0.9 else "the" for _ in range(RNG.randrange(0, 120))) for _ in range(150)]
    texts += [texts[3] + " " + texts[4], "the the the the the the", say(50), "", "ONE Two", "new " + texts[5]] * 3
    ids = list(range(len(texts)))
    split = [[*"".join(x.lower() if x.isascii() else x for x in t).split(), None] for t in texts]
    want = plain_tree(split, [zlib.crc32(str(i).encode()) % 5 != 1 for i in ids])
    df = spark.createDataFrame(rows(texts), SCHEMA).repartition(3)
    for part_bytes in (1 << 24, 2000):
        got = {r.doc_id: r.score for r in suffix_tree_scores(df, part_bytes=part_bytes).collect()}
        assert got == pytest.approx(dict(zip(ids, want)), rel=1e-9)


def test_op2_odd_tables(spark):
    held, train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1], [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 != 1]
    run = lambda data: {r.doc_id: r for r in suffix_tree_scores(spark.createDataFrame([(k, t, "en", "s", 0, 0, "", "", "") for k, t in data], SCHEMA)).collect()}
    got = run([(i, say(20)) for i in held])
    assert all(r.held_out and r.score == 0 and r.base_score == 0 and r.train_tokens == 0 for r in got.values())
    assert all(r.n_tokens == 1 and r.score < 0 for r in run([(i, None) for i in train]).values())
    assert all(r.n_tokens == 2 and r.score < 0 for r in run([(i, f"word{i}") for i in train]).values())
    flat = run([(i, " ".join(f"w{RNG.randrange(3000)}" for _ in range(500))) for i in train])
    assert all(r.n_tokens == 501 and -3000 < r.score < 0 for r in flat.values())
    long_ = run([(train[0], "some words " * 400_000), (train[1], "a")])
    assert long_[train[0]].n_tokens == 800_001 and long_[train[0]].score > long_[train[0]].base_score


def test_op2_beats_the_base_on_held_out_texts(spark, sf):
    got = suffix_tree_scores(spark.read.parquet(f"{sf}/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_op2_learns_a_rare_repeated_passage(spark):
    passage = " ".join(f"rare{i}word" for i in range(40))
    shuffled = passage.split(" ")
    random.Random(3).shuffle(shuffled)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    texts = [say(200) + ("" if i in held or i % 40 else " " + passage) for i in range(400)]
    texts[held[0]], texts[held[1]] = passage, " ".join(shuffled)
    got = {r.doc_id: r for r in suffix_tree_scores(spark.createDataFrame(rows(texts), SCHEMA)).collect()}
    assert got[held[0]].base_score == pytest.approx(got[held[1]].base_score)
    assert got[held[0]].score > got[held[1]].score + 20


def test_op3_learns_held_out_languages_and_switches(spark, sf, docs, none):
    real = spark.read.parquet(f"{sf}/documents.parquet")
    got = identify(real).join(real.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.95
    odd = {r.doc_id: r for r in identify(docs).collect() if r.doc_id is not None}
    assert (odd[6].lang_pred, odd[6].score) == ("und", 0.0) and odd[7].lang_pred == odd[8].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in odd.values()) and len(odd) == 21
    assert identify(none).count() == 0


def test_op3_marginals_are_those_of_a_plain_chain():
    rng = np.random.default_rng(4)
    crf = Crf(["a", "b", "c"])
    crf.move, crf.begin = rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.array([0, 200, 200, 203, 331])
    e = rng.normal(size=(331, 3))
    got, _ = crf.marginals(e, first)
    for lo, hi in zip(first[:-1], first[1:]):
        if lo == hi:
            continue
        a, b, f, g = np.exp(crf.move), np.exp(e[lo:hi]), np.zeros((hi - lo, 3)), np.ones((hi - lo, 3))
        f[0] = np.exp(crf.begin) * b[0]
        f[0] /= f[0].sum()
        for t in range(1, hi - lo):
            f[t] = f[t - 1] @ a * b[t]
            f[t] /= f[t].sum()
        for t in range(hi - lo - 2, -1, -1):
            g[t] = a @ (b[t + 1] * g[t + 1])
            g[t] /= g[t].sum()
        want = f * g / (f * g).sum(1, keepdims=True)
        assert np.allclose(got[lo:hi], want, atol=1e-6)


def test_op4(spark, none):
    item, other = say(30), say(18)
    edited = item.split(" ")
    edited[29] = "new"
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (5, "three short words"), (None, item)], "item_id long, text string")
    texts = [say(50) + " " + item + " " + say(20), say(80), other, say(10) + "\n" + " ".join(edited), "three short words", "say three short words", None, "", " ".join(item.split(" ")[:12]) + say(30), " ".join(item.split(" ")[:28])]
    got = decontaminate(spark.createDataFrame([*rows(texts), rows(texts)[0]], SCHEMA), bench).collect()

    def weighted(t):
        w = t.encode().split()
        return Counter({k: n * sum(map(len, k)) for k, n in Counter(tuple(w[i : i + min(5, len(w))]) for i in range(max(1, len(w) - 4))).items()})

    want = {}
    for k, t in enumerate(texts):
        w = (t or "").split()
        for i, b in ((1, item), (2, other), (5, "three short words")):
            n = len(b.split())
            for s in range(max(len(w) - n + 1, int(len(w) >= 5 and n > len(w)))):
                x, y = weighted(" ".join(w[s : s + n])), weighted(b)
                j = sum((x & y).values()) / sum((x | y).values())
                if j >= 0.8 and j > want.get((k, i), (0, 0))[0]:
                    want[k, i] = (j, s)
    assert {(r.doc_id, r.item_id): (pytest.approx(r.similarity), r.start_word) for r in got} == want
    assert set(want) == {(0, 1), (2, 2), (3, 1), (4, 5), (5, 5), (9, 1)} and len(got) == 6 and decontaminate(none, bench).count() == 0
    assert decontaminate(spark.createDataFrame(rows(texts), SCHEMA), bench.where("false")).count() == 0


def test_op4_many_items_and_repeated_ids(spark):
    items = [say(RNG.randrange(1, 40)) for _ in range(2300)]
    texts = [say(20) + " " + items[k] + " " + say(9) for k in (3, 1001, 1500, 2299)] + [say(60)]
    data = [(k // 2, t, "en", "s", 0, 0, "", "", "") for k, t in enumerate(texts)]
    bench = spark.createDataFrame([(i // 2, t) for i, t in enumerate(items)], "item_id long, text string")
    got = decontaminate(spark.createDataFrame(data, SCHEMA), bench).collect()
    long_ = {(k // 2, i // 2) for k, i in enumerate((3, 1001, 1500, 2299)) if len(items[i].split()) >= 5}
    short = {(r[0], i // 2) for r in data for i, x in enumerate(items) if len(x.split()) < 5 and f" {x} " in f" {r[1]} "}
    assert {(r.doc_id, r.item_id) for r in got} == long_ | short and long_
    assert len(got) == len({(r.doc_id, r.text_key, r.item_id) for r in got})


def test_op5_counts(spark, docs, none):
    got = counts(docs).collect()
    own = texts_of(docs)
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            continue
        t = own[r.doc_id]
        w = t.encode().split()
        seen, twice = set(), 0
        for line in t.split("\n"):
            twice += line in seen and bool(line.encode().split())
            seen.add(line)
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        repeat = sum(any(grams[tuple(w[j : j + 8])] > 1 for j in range(max(0, i - 7), min(i, len(w) - 8) + 1)) for i in range(len(w)))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), twice, repeat), r.doc_id
        assert r.base_failed == (len(w) < 20 or 100 * repeat > 30 * len(w))
    assert counts(none).count() == 0


def test_op5_cutoffs_keep_their_promise(spark):
    good = [(i, say(40), "en", "s", 0, 0, "", "", "") for i in range(700)]
    bad = [(1000 + i, say(40).replace(" ", " $$ "), "en", "s", 0, 0, "", "", "") for i in range(50)]
    few = [(2000 + i, say(40).replace(" ", " ## "), "fr", "s", 0, 0, "", "", "") for i in range(20)]
    labels = spark.createDataFrame([*((i, 1, 0) for i in range(600)), (0, 1, 1), *((1000 + i, 0, 0) for i in range(30)), *((2000 + i, 1, 0) for i in range(20))], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(good + bad + few, SCHEMA), labels).collect()}
    assert len(got) == 770 and all(got[i].kept for i in range(700)) and not any(got[1000 + i].kept for i in range(50))
    assert all(got[2000 + i].kept and got[2000 + i].cutoff is None for i in range(20))  # too few labels to certify anything
    assert binomial_tail(0, 10, 0.1) == pytest.approx(0.9**10) and binomial_tail(3, 3, 0.5) == pytest.approx(1.0)


def test_op7(spark, docs, none):
    got = mix_sources(docs).collect()
    assert len(got) == docs.count() and mix_sources(none).count() == 0
    fates = lambda rows: sorted((r.doc_id or -1, r.size, r.taken) for r in rows)
    assert fates(mix_sources(docs.repartition(5)).collect()) == fates(got)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.size == len((texts_of(docs).get(r.doc_id) or "").encode().split()) or r.doc_id is None
    names = sorted(x for x in size if x is not None) + [None]
    weight, free, left, goal = {s: i % 3 + 1 for i, s in enumerate(names)}, set(names), sum(size.values()), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            goal |= share
            break
        for s in over:
            goal[s] = 3 * size[s]
            left -= goal[s]
            free.discard(s)
    assert target == pytest.approx(goal)
    assert all(abs(taken[s] - goal[s]) <= 1 for s in names)


def test_op7_reshares_what_small_sources_cannot_take(spark):
    data = [(i, say(100), "en", "a", 0, 0, "", "", "") for i in range(60)] + [(100, say(5), "en", "b", 0, 0, "", "", ""), (101, say(7), "en", "c", 0, 0, "", "", "")]
    got = {r.source: r.target for r in mix_sources(spark.createDataFrame(data, SCHEMA)).collect()}
    assert got == pytest.approx({"a": 6012 - 15 - 21, "b": 15, "c": 21})


def near_truth(own):
    sets = {}
    for k, t in own.items():
        w = t.encode().split()
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    head = {}
    for k in sorted(sets):
        head.setdefault(sets[k] if sets[k] else k, k)
    rep = {k: head[s if s else k] for k, s in sets.items()}
    links, low = Counter(), {k: k for k in sets}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    heads = sorted(set(rep.values()))
    for i, a in enumerate(heads):
        for b in heads[i + 1 :]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                low[max(x, y)] = min(x, y)
    return {k: (root(rep[k]), rep[k], links[rep[k]]) for k in sets}


def test_op8(spark, docs, none):
    got = ngram_join(docs).collect()
    want = near_truth(texts_of(docs))
    assert {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in got} == want and len(got) == len(want)
    assert ngram_join(none).count() == 0


def test_op8_large_group_over_several_blocks(spark, monkeypatch):
    import loomtext.llm.op8_ngram_join as m

    monkeypatch.setattr(m, "BLOCK", 16)
    monkeypatch.setattr(m, "LABEL_BLOCK", 24)
    base = say(120).split(" ")
    texts = []
    for i in range(70):
        w = base[:]
        w[(i * 7) % 120] = f"edit{i}"
        texts.append(" ".join(w))
    want = near_truth(dict(enumerate(texts)))
    assert {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in ngram_join(spark.createDataFrame(rows(texts), SCHEMA)).collect()} == want
    assert sum(x[2] for x in want.values()) > 70 * 40


def test_op8_labels_and_depths():
    import pyarrow as pa

    s = np.sort(np.random.default_rng(2).integers(0, 1 << 62, 700).astype(np.uint64))
    path = labels(s)
    m = minhashes(pa.array([path.view(np.int64)], pa.list_(pa.int64())))
    assert path.shape == (TREES,) and m.shape == (1, TREES * DEPTH)
    assert [int(p) >> 56 for p in path] == m[0, ::DEPTH].tolist()  # the first minhash is the highest byte
    other = labels(s[:630])  # Jaccard 0.9
    assert 0.8 < (minhashes(pa.array([other.view(np.int64)], pa.list_(pa.int64()))) == m).mean() < 0.98
    for counts in ({}, {(t, d): 10 ** (8 - d) * (t + 1) for t in range(TREES) for d in range(9)}):
        got = depths(counts, 0.8, 0.9999)
        assert 1 - math.prod(1 - 0.8**d for d in got) >= 0.9999 > 1 - math.prod(1 - 0.8 ** min(8, d + 1) for d in got)
    assert depths({(0, d): 10**6 for d in range(9)}, 0.8, 0.9999)[0] > min(depths({}, 0.8, 0.9999))


def test_op8_chains_of_labels():
    rng = np.random.default_rng(3)
    m = rng.integers(0, 256, (60, 160)).astype(np.uint8)
    for i in (5, 11, 30):
        m[i] = m[i - 1]
        m[i, :40] = 0
    m[6], m[6, 100:140] = m[5], 1
    assert {i: x for i, x in enumerate(joined_rows(m, np.full(60, 100), 0.8, 0.6)) if i != x} == {5: 4, 6: 4, 11: 10, 30: 29}


def test_op8_finds_all_pairs_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = near_truth({r.doc_id: r.text or "" for r in docs.collect()})
    assert {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in ngram_join(docs).collect()} == want


def test_op8_rows_that_repeat_a_doc_id(spark):
    a, b = say(60), say(60)
    data = [(5, a), (5, a), (5, b), (3, b), (9, a + " end")]
    got = sorted((r.doc_id, r.class_id, r.n_copies, r.n_links, r.is_first) for r in ngram_join(spark.createDataFrame([(k, t, "en", "s", 0, 0, "", "", "") for k, t in data], SCHEMA)).collect())
    assert got == [(3, 3, 1, 0, True), (5, 3, 1, 0, False), (5, 5, 0, 1, True), (9, 5, 0, 1, False)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 150: 100}


def test_patience_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randrange(0, 12) for _ in range(rng.randrange(0, 25))]
        b = [rng.randrange(0, 12) for _ in range(rng.randrange(0, 25))]
        pairs = patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert patience([1, 2, 3, 4], [9, 1, 2, 8, 3, 4]) == [(0, 1), (1, 2), (2, 4), (3, 5)]


def test_patience_aligns_repeated_lines():
    assert len(patience([7, 1, 2, 1, 2, 8], [9, 1, 2, 1, 2, 1, 2, 6])) == 4
    assert patience([7, 0, 0, 8], [9, 0, 0, 0, 6]) == []


def test_op9(spark, docs, none):
    shared = [say(14) for _ in range(6)]
    common = say(14)
    texts = ["\n".join(shared), "\n".join([say(12), *shared[:3], say(12), *shared[3:]]), "\n".join([say(14), common]), *("\n".join([common, say(14)]) for _ in range(9)), "\n".join(shared), None, "", "ab", "ab", "\n\n"]
    df = spark.createDataFrame([*rows(texts), rows(texts)[1]], SCHEMA)
    got = {r.doc_id: r for r in line_dedup(df, rare=5, others=("lang", "pos")).collect()}
    assert got[0].kept == texts[0] and got[1].n_removed == 6 and got[1].kept.split("\n") == [texts[1].split("\n")[0], texts[1].split("\n")[4]]
    assert all(got[i].kept == texts[i] for i in range(2, 12))  # a lone common line is no evidence
    assert got[12].n_removed == 6 and got[12].kept == "" and got[13].kept is None and got[16].kept == "ab" and got[17].kept == "\n\n"
    assert got[1].pos == 1 and line_dedup(df, rare=5).count() == len(texts) + 1 and line_dedup(none).count() == 0
    assert line_dedup(docs).count() == docs.count()


def test_op9_large_group_of_near_copies(spark):
    base = [say(12) for _ in range(10)]
    texts = ["\n".join([*base[: i % 10], f"own line number {i} of this very text indeed", *base[i % 10 :]]) for i in range(40)]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows(texts), SCHEMA), rare=5).collect()}
    assert got[0].n_removed == 0 and all(got[i].n_removed >= 8 for i in range(1, 40))


def test_op9_common_line_of_many_texts(spark):
    common, half = say(14), ["short line one of two", "short line two of two"]
    texts = ["\n".join([say(14), common, say(14)]) for _ in range(120)] + ["\n".join([say(14), *half, say(14)]) for _ in range(120)]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows(texts), SCHEMA)).collect()}
    assert [got[i].n_removed for i in range(240)] == [0] + [1] * 119 + [0] + [2] * 119


def least_runs(lines):
    """(first, last) of the least runs of 40 bytes or more that begin or end at each line."""
    size = [len(x.encode()) if x.strip() else 0 for x in lines]
    out = set()
    for i in range(len(lines)):
        out |= {next(((i, j) for j in range(i, len(lines)) if sum(size[i : j + 1]) >= 40), None), next(((j, i) for j in range(i, -1, -1) if sum(size[j : i + 1]) >= 40), None)}
    return sorted(out - {None})


def check_lines(data, got):
    """Every deleted line lies in a run that an earlier document holds, and no such run is left whole."""
    first = {}
    for k, t in data:  # by doc_id
        for i, j in least_runs((t or "").split("\n")):
            first.setdefault(tuple(t.split("\n")[i : j + 1]), k)
    for doc_id, text in data:
        if text is None:
            continue
        lines = text.split("\n")
        shared = [(i, j) for i, j in least_runs(lines) if first[tuple(lines[i : j + 1])] < doc_id]
        for kept in got[doc_id, text]:
            at, gone = 0, set()
            for i, x in enumerate(lines):  # which lines are gone: kept is a subsequence, equal lines may be matched either way
                if at < len(kept) and kept[at] == x and len(kept) - at <= len(lines) - i:
                    at += 1
                else:
                    gone.add(i)
            if len(set(lines)) == len(lines):
                covered = {k for i, j in shared for k in range(i, j + 1)}
                whole = text in [t for k, t in data if k < doc_id] and len(text.encode()) >= 40
                assert whole and len(gone) == len(lines) or {k for k in gone if lines[k].strip()} <= covered, (doc_id, gone, shared)
                assert all(gone & set(range(i, j + 1)) for i, j in shared), (doc_id, gone, shared)
            assert len(gone) == len(lines) - len(kept)


def test_op9_leaves_no_run_that_an_earlier_document_holds(spark):
    x, y, z = say(14), say(14), say(14)
    crossed = ["\n".join(p) for p in ([y, say(14), x], [x, y, say(14)], [say(14), x, y], [z, say(14), x, y], [x, y, say(14), z], [z, x, y])]
    pool, rng = [say(RNG.choice((2, 3, 14))) for _ in range(25)], random.Random(5)
    for texts in (crossed, ["\n".join(rng.sample(pool, rng.randrange(1, 9))) for _ in range(80)]):
        got = defaultdict(list)
        for r in line_dedup(spark.createDataFrame(rows(texts), SCHEMA)).collect():
            got[r.doc_id, texts[r.doc_id]].append([] if r.n_removed == r.n_lines else r.kept.split("\n"))
        check_lines(list(enumerate(texts)), got)


def test_op9_on_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {(r.doc_id, texts[r.doc_id]): [[] if r.n_removed == r.n_lines else r.kept.split("\n")] for r in line_dedup(docs).collect()}
    assert len(got) == len(texts)
    check_lines(sorted(texts.items()), got)


def test_rows_that_repeat_a_doc_id_with_other_texts(spark):
    a, b, c, d = say(100), say(60), say(80), say(60)
    lines = ["\n".join(say(14) for _ in range(3)) for _ in range(4)]
    data = [(1, a + " " + b), (2, a + " " + b), (2, b + "\n" + c), (3, c + " " + d), (4, "\n".join([lines[0], lines[1]])), (5, lines[1]), (5, "\n".join([lines[2], lines[0]])), (6, lines[2]), (6, "\n".join([lines[2], lines[3]])), (7, lines[3])]
    df = spark.createDataFrame([(k, t, "en", "s", 0, 0, "", "", "") for k, t in data], SCHEMA)
    words = lambda t: t.encode().split()
    first, first_bytes = {}, {}
    for k, t in sorted(data):
        w, raw = words(t), t.encode()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), k)
        for i in range(len(raw) - 49):
            first_bytes.setdefault(raw[i : i + 50], k)
    want, want_bytes = Counter(), Counter()
    for k, t in data:
        w, raw = words(t), t.encode()
        gone = [any(first[tuple(w[j : j + 50])] < k for j in range(max(0, i - 49), min(i, len(w) - 50) + 1)) for i in range(len(w))]
        want[k, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()] += 1
        cut = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            cut[i : i + 50] |= first_bytes[raw[i : i + 50]] < k
        want_bytes[k, len(raw), int(cut.sum()), hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~cut])).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df).collect()) == want
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup(df).collect()) == want_bytes
    kept = Counter((r.doc_id, r.n_lines, r.n_removed) for r in line_dedup(df).collect())
    assert all(kept[x] for x in [(1, 1, 0), (2, 1, 1), (2, 2, 0), (4, 6, 0), (5, 3, 3), (5, 6, 3), (6, 3, 3), (6, 6, 3), (7, 3, 3)]) and sum(kept.values()) == len(data)


def slow_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
    path = path[: next((i for i, c in enumerate(path) if c in "?#"), len(path))]
    best = None
    for verdict, h, p in (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")):
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, *(best or (None, None))


def test_op10_rules(spark):
    urls = ["http://A.Example.org/es/1", "https://example.org/en/15?x", "http://org/", "http://x.org", "http://borg/", "http://www.example.com/de/9#a", "ftp://q.com/fr/", "nope", None, "", "://", "http://é.org/ü", "http://a.com/en/://b", "http://h\n.org/\n", "HTTP://X.COM/De/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    host, path = split_url(F.col("url"))
    got = df.select("page_id", host.alias("host"), path.alias("path")).withColumn("r", by_rule(F.col("host"), F.col("path"))).collect()
    for r in got:
        assert (r.host, r.path, r.r.rule if r.r else None, r.r.verdict if r.r else None) == slow_url(urls[r.page_id])
    out = url_filter(df).collect()
    assert len(out) == len(urls) and {r.verdict for r in out} <= {"allow", "block"}
    assert url_filter(df.where("false")).count() == 0


def test_op10_model_learns_a_separable_table(spark):
    good, bad = ["garden", "library", "school", "museum"], ["casino", "pills", "lottery", "jackpot"]
    make = lambda names, verdict, at: [(f"http://www.{RNG.choice(names)}{RNG.randrange(99)}.example.net/{RNG.choice(names)}/{i}", verdict) for i in range(at)]
    labelled = spark.createDataFrame([*make(good, "allow", 60), *make(bad, "block", 60)], "url string, verdict string")
    test = [*make(good, "allow", 30), *make(bad, "block", 30)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(test)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter(pages, labelled).collect()}
    assert sum(got[i] == v for i, (_, v) in enumerate(test)) >= 57


def test_registered():
    from loomtext.llm import queries

    assert {int(k[2:].split("_")[0]) for k in queries.QUERIES if k.startswith("op")} == set(range(1, 14))
