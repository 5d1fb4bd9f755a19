"""Goldens of the Chinese profile, on tiny tables."""

import pytest
from pyspark.sql import functions as F

from loomtext.functions import rules as R, text as T
from loomtext.profile import ZH


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text,column,expected",
    [
        ("第1章 Hello，林默说：加钱。", T.counted_chars, 7),
        ("第一段\r\n\r\n\r\n第二段\n\n第三段", T.normalize_newlines, "第一段\n\n第二段\n\n第三段"),
        ("第一段\r\n\r\n\r\n第二段\n\n第三段", T.paragraph_lengths, [3, 3, 3]),
        ("“你好。”\n\n他走了。\n\n\"走吧", T.dialogue_ratio, 2 / 3),
        ("加钱加钱加钱加钱", lambda t: T.repeated_ngram_ratio(t, 2), 5 / 7),
        ("加钱", T.repeated_ngram_ratio, 0.0),
        ("", T.shingles, []),
        ("林默", T.shingles, ["林默"]),
        ("走了。来了！", T.sentence_lengths, [2, 2]),
        ("雨夜加钱雨夜", lambda t: T.count_of(t, "雨夜"), 2),
        ("雨", lambda t: T.coverage(t, T.texts(("加钱", "雨夜"))), 0.0),
        ("雨", lambda t: T.coverage(t, T.texts(())), 1.0),
        ("加钱雨夜来", lambda t: T.leak_fragment(t, F.lit("他说加钱雨夜"), 4), "加钱雨夜"),
        ("　前后　", T.strip, "前后"),
        ("a\nb", T.preview, "a\\nb"),
        ("Bad Label!! x", T.issue_label, "bad_label_x"),
        ("书/第一卷 a.txt", lambda p: F.substring(T.work_id(p), 1, 8), "书__第一卷_a"),
        ("节奏紧凑，减少 AI 味。", T.abstract_only, True),
        ("节奏紧凑，主角夺剑。", T.abstract_only, False),
    ],
)
def test_goldens(spark, text, column, expected):
    got = one(spark, text, column)
    assert got == pytest.approx(expected) if isinstance(expected, float) else got == expected


def test_repeated_runs_against_python(spark):
    texts = ["林默提剑走向雨夜深处，" * 4, "加钱加钱加钱", "一二三四五六七八九" * 3, "一二三四五，一二三四五，一二三四五。", ""]

    def slow(t):
        from collections import Counter
        import re

        c = Counter()
        for run in re.findall("[一-鿿]{5,}", t):
            c.update(run[i : i + 8] for i in range(0, max(len(run) - 7, 0) + 1))
        return sorted(x for x, n in c.items() if n >= 3)

    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.repeated_runs(F.col("t"))).collect()
    for i, found in rows:
        assert sorted(found) == slow(texts[i])


@pytest.mark.parametrize("n,failures", [(1999, ["length_short"]), (2000, []), (2500, []), (2501, ["length_long"])])
def test_length_boundaries(spark, n, failures):
    text = "".join(chr(0x4E00 + i) for i in range(n)) + "。"
    rows = spark.createDataFrame([(text,)], "t string")
    got = R.scored(rows, [], "t", T.texts(()), T.texts(()), F.lit(""), F.lit("")).first()["failure_types"]
    assert got == failures


def test_padding(spark):
    text = "他提着剑走进雨夜的山门" * 223 + "。"
    rows = spark.createDataFrame([(text,)], "t string")
    got = R.scored(rows, [], "t", T.texts(()), T.texts(()), F.lit(""), F.lit("")).first()["failure_types"]
    assert got == ["repetition", "padding_to_length", "semantic_repetition"]


def test_cap_cuts_at_a_sentence_or_before_the_next_character(spark):
    assert one(spark, "一二三。" * 2, lambda t: R.cap_counted(t, 5)) == "一二三。一二"
    assert one(spark, "一二三", lambda t: R.cap_counted(t, 5)) == "一二三"
    long = "一" * 2100 + "。" + "二" * 600
    assert one(spark, long, lambda t: R.cap_counted(t, 2500)) == "一" * 2100 + "。"


@pytest.mark.parametrize(
    "log,code,kind",
    [("CUDA out of memory", 1, "cuda_oom"), ("Killed", 137, "process_killed"), ("ok", 0, "none"), ("", 3, "process_killed"), ("", None, "none"), ("permission denied: adapter_model", 1, "adapter_save_error"), ("permission denied: x", 1, "process_killed"), ("FileNotFoundError: data_sft", 1, "dataset_error")],
)
def test_training_errors(spark, log, code, kind):
    row = spark.createDataFrame([(log, code)], "l string, c int").select(R.training_error(F.col("l"), F.col("c")).alias("k"))
    assert row.first().k == kind
    assert row.select(R.suggestion(F.col("k"))).first()[0]


def test_half_even_beats(spark):
    assert one(spark, "x", lambda t: T.beat_chars(F.lit(2500), 0.25)) == 600
    assert ZH.longest == 2500
