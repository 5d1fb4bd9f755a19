"""Windows at size: what is written, how tables are dealt, and characters beyond the basic plane."""

import random
import re
from collections import Counter
from dataclasses import replace

from pyspark.sql import functions as F

from loomtext.functions import text as T
from loomtext.operators import gates, rows, similar
from loomtext.profile import LATIN


def word(i: int) -> str:
    return ("z" + "".join(chr(97 + int(c)) for c in f"{i:012d}") + "y") * 3


def test_leakage_writes_only_windows_that_meet(spark, monkeypatch):
    """Windows that no rendered text holds are dropped where they are made, and stretches that many rows share are compared once."""
    alphabet, put, kept = "abcdefghijklmnopqrstuvwxyz", [], similar.stored
    sources = spark.createDataFrame([(i, f"{word(i)}. {'x' * 30} {alphabet * (i % 4 == 1)}. \U0001d49c{word(i)}") for i in range(400)], "src int, text string")
    cards = spark.createDataFrame([(i, "short" if i < 200 else f"so {word(i)[3:]}. {alphabet[10:]}. {'x' * 24}") for i in range(300)], "card int, own string")
    monkeypatch.setattr(similar, "stored", lambda df, name: put.append((name, kept(df, name))) or put[-1][1])
    got = {(r.card, r.src): r.fragment for r in similar.leakage(cards, "card", "own", sources, "src", "text", replace(LATIN, leak_window=14)).collect()}
    assert got == {(c, s): word(c)[:14] if c == s else "x" * 14 for c in range(200, 300) for s in range(400)}
    sizes = {name: df.count() for name, df in put}
    assert sizes["source-stretches"] < 750 and sizes["rendered-stretches"] == 300 and sizes["stretches"] < 120


def _by_definition(text: str) -> tuple[float, list[str]]:
    own = "".join(c for c in text if c.isalpha())
    grams = [own[i : i + 4] for i in range(len(own) - 3)]
    each = []
    for r in re.findall(r"[^\W\d_]{5,}", text):
        each += [r] if len(r) < 8 else [r[i : i + 8] for i in range(len(r) - 7)] + [r[-7:]]
    counts = Counter(each)
    return (len(grams) - len(set(grams))) / len(grams) if grams else 0.0, [x for x in counts if counts[x] >= 3]


def test_repeats_of_any_letters(spark):
    """Letters beyond the basic plane are one character each, and texts of very many letters are compared in full."""
    rng, astral, wide = random.Random(7), "\U0001d49c\U00020000\U00020001ab", [chr(0x4E00 + i) for i in range(3000)]
    own = ["", "abc", "aaaa", "abcdeabcde abcde abcde", "x" * 30, (astral * 9 + " ") * 3]
    own += [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(60)) for letters in ("ab", "aé\U00020000", "abcdefg")]
    piece = "".join(rng.choices(wide, k=20))
    own += [".".join(["".join(rng.choices(wide, k=2000)), *[piece + "".join(rng.choices(wide, k=3)) for _ in range(4)]])]
    df = spark.createDataFrame([*enumerate(own), (99, None)], "i int, t string").repartition(2)
    got = {r.i: (r.a, r.b) for r in df.select("i", T.repeated_ngram_ratio(F.col("t"), 4, LATIN).alias("a"), T.repeated_runs(F.col("t"), LATIN).alias("b")).collect()}
    assert got == {i: _by_definition(t) for i, t in enumerate(own)} | {99: (None, None)}


def test_a_table_is_dealt_in_pieces_of_one_size(spark, monkeypatch):
    """More bytes make more tasks, not longer ones, at any size."""
    few, cores = spark.range(0, 1000, 1, 1), spark.sparkContext.defaultParallelism
    assert rows.spread(few).rdd.getNumPartitions() == 4 * cores
    monkeypatch.setattr(rows, "PIECE", 100)
    assert rows.spread(few).rdd.getNumPartitions() == 80


def test_the_budget_scores_each_output_once(spark):
    """Ids of metrics are looked up in three places, but the rules run once a row."""
    seen = spark.sparkContext.accumulator(0)

    def scoring(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    ids = spark.range(1, 21)
    metrics = ids.selectExpr("id", "id > 3 as hard_gate_pass", "cast(id as int) as char_count", "array('length_short') as failure_types").mapInArrow(scoring, "id long, hard_gate_pass boolean, char_count int, failure_types array<string>")
    row = gates.quality_budget(ids, ids, metrics).first()
    assert (row.metrics_rows, row.hard_gate_pass, row.missing_metrics, row.duplicate_metrics, row.length_short) == (20, 17, 0, 0, 20)
    assert seen.value == 20
