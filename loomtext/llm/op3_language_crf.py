"""Language ID: a linear-chain conditional random field that labels every word, by forward-backward.

A word's features are its 2- and 3-byte n-grams, its prefixes and suffixes of 2 and 3 bytes and its identity, hashed
into BUCKETS, and a lexicon: the log share of each language among the training occurrences of a word seen LEXICON
times or more. Transitions are learned. Training texts are of one language each, so half of the training sequences
are spliced from pieces of 3 to 40 words of different texts: these teach the transitions of code-switched text.
A text's language is the one with the largest share of its words' posterior marginals; words without a letter have
no say.

The model is fitted on the driver to a sample of labelled texts: about PER_LANG of each language, those with the
smallest hashes, of at most TRAIN_BYTES bytes each. Prediction is one map over all texts, whole: texts are cut into
segments of SEGMENT words whose transfer matrices are chained, so a long text is labelled exactly, in vector steps.

Defined cases: null text or a text without a letter is `und` with score 0, as is every text if nothing can be
learned; ties go to the language first in code-point order; repeated rows are judged each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ._common import as_batch, small_batches
from ._words import LOWER, Piece, U, Words, byte_grams, hashes, mix, pieces, words

BUCKETS, LEXICON, PER_LANG, TRAIN_BYTES, SEGMENT, ROUNDS, FOLDS, HELD = 1 << 16, 3, 120, 20_000, 64, 40, 5, 0
OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64()), ("n_switches", pa.int64())])
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(p: Piece, w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a word's number and a bucket."""
    data = LOWER[p.data]
    number = np.full(len(data) + 1, -1)
    number[w.start] = np.arange(len(h))
    inside = np.zeros(len(data) + 1, np.int8)
    inside[w.start] = 1
    inside[w.end] -= 1
    inside = np.cumsum(inside[:-1]) > 0
    number = np.where(inside, np.maximum.accumulate(number[:-1]), -1)
    word, bucket = [np.arange(len(h))], [h >> U(48)]
    for n in (2, 3):
        g = byte_grams(data, n)
        if not len(g):
            continue
        at = np.flatnonzero((number[: len(g)] >= 0) & (number[: len(g)] == number[n - 1 :]))
        word.append(number[at])
        bucket.append(g[at] >> U(48))
        long_ = np.flatnonzero(w.end - w.start >= n)
        for kind, place in ((1, w.start[long_]), (2, w.end[long_] - n)):
            word.append(long_)
            bucket.append(mix(g[place] + U(kind)) >> U(48))
    return np.concatenate(word), np.concatenate(bucket).astype(np.int64)


class Crf:
    def __init__(self, langs: list[str]):
        self.langs = langs
        k = len(langs)
        self.weight = np.zeros((BUCKETS, k))
        self.move = np.zeros((k, k))
        self.begin = np.zeros(k)
        self.trust = np.ones(1)  # of the lexicon
        self.words, self.share = np.zeros(0, U), np.zeros((1, k))

    def lexicon(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros((len(h), len(self.langs)))
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where((self.words[at] == h)[:, None], self.share[at], 0.0)

    def emissions(self, word: np.ndarray, bucket: np.ndarray, n: int, lexicon: np.ndarray) -> np.ndarray:
        out = np.stack([np.bincount(word, weights=self.weight[bucket, k], minlength=n) for k in range(len(self.langs))], 1)
        return out + self.trust[0] * lexicon

    def marginals(self, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posterior of each word's label, and the sum of the posteriors of its pairs with the word before.
        first: where each sequence's words begin, and the count of all."""
        k = len(self.langs)
        length = np.diff(first)
        pieces_of = -(-length // SEGMENT)
        n_seg = int(pieces_of.sum())
        if not n_seg:
            return np.zeros((0, k)), np.zeros((k, k))
        seq = np.repeat(np.arange(len(length)), pieces_of)
        order = np.arange(n_seg) - np.repeat(np.cumsum(pieces_of) - pieces_of, pieces_of)  # place in its sequence
        start = first[:-1][seq] + order * SEGMENT
        size = np.minimum(SEGMENT, first[1:][seq] - start)
        b = np.ones((SEGMENT, n_seg, k))
        step, seg = np.nonzero(np.arange(SEGMENT)[:, None] < size[None])
        b[step, seg] = np.exp(e - e.max(1, keepdims=True))[start[seg] + step]
        a = np.exp(self.move - self.move.max())
        live = np.arange(SEGMENT)[:, None] < size[None]
        whole = np.broadcast_to(np.eye(k), (n_seg, k, k)).copy()
        for t in range(SEGMENT):
            x = (whole @ a) * b[t][:, None]
            whole = np.where(live[t][:, None, None], x / x.sum((1, 2), keepdims=True), whole)
        # messages into and out of segments, in step with their place
        into, back = np.zeros((n_seg, k)), np.ones((n_seg, k)) / k
        by_place = [np.flatnonzero(order == i) for i in range(int(order.max()) + 1)] if order.max() < 64 else np.split(np.argsort(order, kind="stable"), np.cumsum(np.bincount(order))[:-1])
        opening = np.exp(self.begin - self.begin.max())
        # before the first word stands a vector whose step gives the opening weights
        lead = np.linalg.lstsq(a.T, opening, rcond=None)[0] if abs(np.linalg.det(a)) > 1e-12 else None
        for i, at in enumerate(by_place):
            if i == 0:
                into[at] = opening if lead is None else lead
            else:
                x = np.einsum("nk,nkj->nj", into[at - 1], whole[at - 1])
                into[at] = x / np.abs(x).sum(1, keepdims=True)
        for at in reversed(by_place[1:]):
            x = np.einsum("nkj,nj->nk", whole[at], back[at])
            back[at - 1] = x / x.sum(1, keepdims=True)
        f = np.zeros((SEGMENT, n_seg, k))
        now = into
        for t in range(SEGMENT):
            x = (now @ a) * b[t]
            x = np.maximum(x, 1e-300)
            now = np.where(live[t][:, None], x / x.sum(1, keepdims=True), now)
            f[t] = now
        g = np.zeros_like(f)
        now = back
        pair = np.zeros((k, k))
        for t in range(SEGMENT - 1, -1, -1):
            x = f[t] * now
            g[t] = x / x.sum(1, keepdims=True)
            out = (b[t] * now) @ a.T
            came = f[t - 1] if t else np.maximum(into, 0)
            use = live[t] & ((order > 0) | (t > 0))
            both = came[:, :, None] * a[None] * (b[t] * now)[:, None]
            total = both.sum((1, 2), keepdims=True)
            pair += (both / np.where(total > 0, total, 1))[use].sum(0)
            now = np.where(live[t][:, None], out / out.sum(1, keepdims=True), now)
        gamma = np.zeros_like(e)
        gamma[start[seg] + step] = g[step, seg]
        return gamma, pair

    def fit(self, texts: list[str], labels: list[int], seed: int = 5) -> "Crf":
        """Gradient ascent (Adam) on the likelihood of word labels, half of the sequences spliced."""
        rng = np.random.default_rng(seed)
        k = len(self.langs)
        pairs, hs, lengths, n = [], [], [], 0
        for p in pieces(pa.array(texts, pa.string()), 1 << 26):
            w = words(p)
            h = hashes(p, w, lower=True)
            word, bucket = features(p, w, h)
            pairs.append((word + n, bucket))
            hs.append(h)
            lengths += np.diff(w.first).tolist()
            n += len(h)
        word, bucket, h = np.concatenate([x[0] for x in pairs]), np.concatenate([x[1] for x in pairs]), np.concatenate(hs)
        y = np.repeat(np.array(labels), lengths)
        self.words, at = np.unique(h, return_inverse=True)
        count = np.stack([np.bincount(at, weights=y == j, minlength=len(self.words)) for j in range(k)], 1)
        often = count.sum(1) >= LEXICON
        self.words, count = self.words[often], count[often] / np.maximum(1, np.bincount(y, minlength=k))
        self.share = np.log((count + 1e-5) / (count + 1e-5).sum(1, keepdims=True)) + np.log(k)
        lexicon = self.lexicon(h)
        # sequences as an order of the words: whole texts, then pieces of random texts one after another
        edge = np.concatenate([[0], np.cumsum(lengths)])
        spliced, total = [], 0
        while total < n // 2 and n > 3:
            size = int(rng.integers(3, 41))
            s = int(rng.integers(0, n))
            spliced.append(np.arange(s, min(n, s + size)))
            total += len(spliced[-1])
        order = np.concatenate([np.arange(n), *spliced]).astype(np.int64)
        cuts = np.arange(n, len(order), 400)
        first = np.unique(np.concatenate([edge, cuts, [len(order)]]))
        gold = y[order]
        inner = np.ones(len(order), bool)
        inner[first[:-1][first[:-1] < len(order)]] = False
        moves = np.zeros((k, k))
        np.add.at(moves, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
        opens = np.bincount(gold[first[:-1][np.diff(first) > 0]], minlength=k)
        state = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in self._parts()}
        target = np.eye(k)[gold]
        for t in range(1, ROUNDS + 1):
            e = self.emissions(word, bucket, n, lexicon)
            gamma, pair = self.marginals(e[order], first)
            off = target - gamma
            per_word = np.stack([np.bincount(order, weights=off[:, j], minlength=n) for j in range(k)], 1)
            slope = {
                "weight": np.stack([np.bincount(bucket, weights=per_word[word, j], minlength=BUCKETS) for j in range(k)], 1) - 0.1 * self.weight,
                "move": moves - pair - 0.1 * self.move,
                "begin": opens - gamma[first[:-1][np.diff(first) > 0]].sum(0) - 0.1 * self.begin,
                "trust": np.array([(per_word * lexicon).sum()]),
            }
            for name, v in self._parts():
                m, s = state[name]
                m += 0.1 * (slope[name] - m)
                s += 0.01 * (slope[name] ** 2 - s)
                v += 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        return self

    def _parts(self):
        return [(name, getattr(self, name)) for name in ("weight", "move", "begin", "trust")]


def fitted(docs: DataFrame) -> Crf:
    """A model of the labelled rows (text, lang, train) of docs."""
    rows = docs.where("train and text is not null and lang is not null")
    langs = [(r.lang, r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()]  # a row a language
    model = Crf([x for x, _ in langs])
    if langs:
        u = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
        share = F.create_map(*[x for lang, n in langs for x in (F.lit(lang), F.lit(min(1.0, PER_LANG / n)))])
        sample = rows.where(F.octet_length("text") <= TRAIN_BYTES).where(u < share[F.col("lang")]).orderBy("doc_id", "text").limit(4 * PER_LANG * len(langs))
        got = sample.select("text", "lang").collect()
        if got:
            model.fit([r.text for r in got], [model.langs.index(r.lang) for r in got])
    return model


def identify(docs: DataFrame, train_share: str = f"crc32(cast(cast(doc_id as string) as binary)) % {FOLDS} <> {HELD}") -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_switches (words whose likeliest label differs from the one before)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.withColumn("train", F.coalesce(F.expr(train_share), F.lit(False)))
    model = docs.sparkSession.sparkContext.broadcast(fitted(rows))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = model.value
        for batch in batches:
            ids, train, texts = batch.column("doc_id"), batch.column("train").to_numpy(zero_copy_only=False), batch.column("text")
            for p in pieces(texts):
                w = words(p)
                h = hashes(p, w, lower=True)
                n = p.hi - p.lo
                letters = np.concatenate([[0], np.cumsum(_LETTER[p.data])])
                own = (letters[w.end] > letters[w.start]).astype(float)
                lang, score, turns = [None] * n, np.zeros(n), np.zeros(n, np.int64)
                if crf.langs and len(h):
                    word, bucket = features(p, w, h)
                    gamma, _ = crf.marginals(crf.emissions(word, bucket, len(h), crf.lexicon(h)), w.first)
                    share = np.stack([np.bincount(w.doc, weights=gamma[:, k] * own, minlength=n) for k in range(len(crf.langs))], 1)
                    total = np.bincount(w.doc, weights=own, minlength=n)
                    share /= np.maximum(1, total)[:, None]
                    best, score = share.argmax(1), np.minimum(1.0, share.max(1))
                    top = gamma.argmax(1)
                    turns = np.bincount(w.doc[1:], weights=(top[1:] != top[:-1]) & (w.doc[1:] == w.doc[:-1]), minlength=n).astype(np.int64)
                    lang = [crf.langs[b] if t and _has_letter(texts[p.lo + i], p, i) else None for i, (b, t) in enumerate(zip(best.tolist(), total.tolist()))]
                yield as_batch(OUT, ids.slice(p.lo, n), ~train[p.lo : p.hi], [x or "und" for x in lang], np.where([x is None for x in lang], 0.0, score), np.diff(w.first), turns)

    return rows.select("doc_id", "text", "train").mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long")


def _has_letter(text: pa.Scalar, p: Piece, i: int) -> bool:
    data = p.data[p.at[i] : p.at[i + 1]]
    plain = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122))
    return bool(plain.any()) or any(c.isalpha() for c in text.as_py())


def op3_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches")
