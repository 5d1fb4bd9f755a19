"""Combined decisions, scoring inputs, generation rows and the digests of a dataset's manifest."""

import json

import pytest
from pyspark.sql import functions as F

from loomtext.operators import assets, decisions as D


def test_rules_go_before_reviewers(spark):
    df = spark.createDataFrame([("blocked_length_short", "ready_for_next_expansion"), (D.READY, "blocked_by_agent_review"), (D.READY, None)], "r string, a string")
    got = [x[0] for x in df.select(D.combined_decision(F.col("r"), F.col("a"))).collect()]
    assert got == ["blocked_length_short", "blocked_by_agent_review", D.PENDING] and set(got) <= set(D.RECOMMENDATIONS)


def test_outputs_by_presence_and_by_content(spark):
    df = spark.createDataFrame([("", "o", "t"), (None, "o", "t"), (None, None, "t"), (None, None, None)], "raw string, output string, text string")
    assert [r[0] for r in df.select(D.output_text(F.col("raw"), F.col("output"), F.col("text"))).collect()] == ["", "o", "t", ""]
    assert [r[0] for r in df.select(D.filled_output(F.col("raw"), F.col("output"))).collect()] == ["o", "o", None, None]


def test_scoring_inputs(spark):
    outputs = spark.createDataFrame([(1, "a", None, "x", None), (2, "a", None, "y", None), (3, "z", None, None, None)], "row_idx int, id string, raw_output string, output string, text string")
    good, bad = D.scoring_inputs(outputs, spark.createDataFrame([("a",)], "id string"))
    assert [(r.id, r.text) for r in good.collect()] == [("a", "x")] and sorted((r.row_idx, r.message) for r in bad.collect()) == [(2, "duplicate output id: a"), (3, "output id not found in cards: z")]


def test_generation_rows(spark):
    df = spark.createDataFrame([(1, "raw", None, None, "p", None), (2, "raw", "clean", 7, None, [("cap",)])], "id int, raw_output string, sanitized_output string, generated_tokens int, prompt string, sanitizer_events array<struct<reason:string>>")
    one, two = D.generation_rows(df, "m", {"top_p": "0.9"}).orderBy("id").collect()
    assert (one.output, one.sanitized_output, one.generated_tokens, one.sanitizer_events, one.params) == ("raw", "raw", 0, [], {"top_p": "0.9"})
    assert (two.sanitized_output, two.generated_tokens, two.prompt_sha256) == ("clean", 7, "") and len(one.prompt_sha256) == 64


def test_manifest_digests_do_not_depend_on_where_files_lie(spark, tmp_path):
    row = json.dumps({"instruction": "a", "input": "b", "output": "c"}) + "\n"
    for base in ("one", "two"):
        (tmp_path / base / "sft" / "deep").mkdir(parents=True)
        (tmp_path / base / "sft" / "x.jsonl").write_text(row * 3)
        (tmp_path / base / "sft" / "deep" / "y.jsonl").write_text(row)
    a, b = (assets.files_digest(spark, f"file://{tmp_path}/{base}/sft") for base in ("one", "two"))
    assert a == b and a[0] == 2
    (tmp_path / "two" / "sft" / "x.jsonl").write_text(row * 2)
    assert assets.files_digest(spark, f"file://{tmp_path}/two/sft")[1] != a[1]
    contract = assets.style_contract("s", "approved", {}, {}, "t", created_at="t")
    splits, near = spark.createDataFrame([("train",), ("train",)], "split string"), spark.range(1)
    got = assets.dataset_manifest(spark, {"sft_dataset": f"file://{tmp_path}/one/sft/x.jsonl"}, contract, splits, near, True)
    assert got["row_count"] == 3 and got["files"]["sft_dataset"]["files"] == 1 and got["split_manifest"] == {"train": 2} and got["near_duplicates"] == 1
    (tmp_path / "bad.jsonl").write_text(row + json.dumps({"instruction": "a", "input": " "}) + "\n")
    with pytest.raises(ValueError, match="missing/invalid SFT fields: input, output"):
        assets.dataset_manifest(spark, {"sft_dataset": f"file://{tmp_path}/bad.jsonl"}, contract, splits, near, True)
