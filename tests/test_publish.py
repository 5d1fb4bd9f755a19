"""Publication as a whole, appends that repeat nothing, digests, and phases of a stream whose state expires."""

import hashlib
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loomtext.operators import inspect
from loomtext.operators.digest import table_digest
from loomtext.sources import publish as P
from loomtext.streaming import events as E


def seen(path):
    return sorted(f for f in os.listdir(path) if not f.startswith(".")) if os.path.isdir(path) else []


def test_publish_all_or_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}"
    rows = spark.range(5)
    P.publish(spark, folder, {"rows": rows, "report.md": "# five"})
    assert seen(tmp_path) == ["report.md", "rows"] and spark.read.json(f"{folder}/rows").count() == 5 and (tmp_path / "report.md").read_text() == "# five"
    # an output that fails half-way leaves nothing, stale results included
    with pytest.raises(Exception, match="broken"):
        P.publish(spark, folder, {"report.md": "# six", "rows": rows.select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))})
    assert seen(tmp_path) == []
    P.publish(spark, folder, {"rows": rows})
    bad = spark.createDataFrame([(3, "x", "must be y")], "row_idx int, entity_id string, message string")
    with pytest.raises(ValueError, match="row 3: must be y"):
        P.publish(spark, folder, {"rows": rows}, violations=bad)
    assert seen(tmp_path) == []


def test_a_run_lost_between_two_renames_is_finished(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    P.publish(spark, folder, {"a": "old a", "b": "old b"})
    plain, moved = P.Files.move, []

    def lost(self, name, to):
        moved.append(name)
        if len(moved) == 3:  # the list, then a, then b
            raise KeyboardInterrupt
        plain(self, name, to)

    monkeypatch.setattr(P.Files, "move", lost)
    with pytest.raises(KeyboardInterrupt):
        P.publish(spark, folder, {"a": "new a", "b": "new b"})
    monkeypatch.setattr(P.Files, "move", plain)
    assert (tmp_path / "a").read_text() == "new a" and not (tmp_path / "b").exists()
    P.recover(spark, folder)
    assert (tmp_path / "b").read_text() == "new b" and [x for x in seen(tmp_path) if x.startswith("_")] == []
    # one that was lost before its list was written leaves the old outputs
    monkeypatch.setattr(P.Files, "move", lambda self, name, to: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        P.publish(spark, folder, {"a": "newer a", "b": "newer b"})
    monkeypatch.setattr(P.Files, "move", plain)
    P.recover(spark, folder)
    assert (tmp_path / "a").read_text() == "new a" and [x for x in seen(tmp_path) if x.startswith("_")] == []


def test_append_adds_what_is_absent(spark, tmp_path):
    path = f"file://{tmp_path}/rows"
    rows = lambda *x: spark.createDataFrame(list(x), "id int, v string")
    P.append_absent(rows((1, "a"), (2, "b"), (2, "b"), (None, "n")), path, ["id"])
    P.append_absent(rows((1, "a"), (2, "b"), (3, "c"), (None, "n")), path, ["id"])
    P.append_absent(rows((1, "a"), (2, "b"), (3, "c"), (None, "n")), path, ["id"])
    assert sorted((r.id or 0, r.v) for r in spark.read.parquet(path).collect()) == [(0, "n"), (1, "a"), (2, "b"), (3, "c")]


def test_a_batch_that_comes_twice_is_one(spark, tmp_path):
    write = P.append_batch(f"file://{tmp_path}/rows")
    write(spark.range(3), 0)
    write(spark.range(3, 5), 1)
    write(spark.range(3, 5), 1)
    assert sorted(r.id for r in spark.read.parquet(f"file://{tmp_path}/rows").collect()) == [0, 1, 2, 3, 4]


def test_append_stream(spark, tmp_path):
    for n in range(3):
        spark.range(n * 10, n * 10 + 4).write.mode("append").parquet(f"file://{tmp_path}/in")
    for _ in range(2):
        stream = E.read_events(spark, f"file://{tmp_path}/in", "id long", files=1)
        P.append_stream(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/state")
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 12


def test_event_log(spark, tmp_path):
    events = P.log_events(spark.range(2), "save", "done", "id")
    P.append_absent(events, f"file://{tmp_path}/log", ["phase", "status", "detail"], "json")
    P.append_absent(events, f"file://{tmp_path}/log", ["phase", "status", "detail"], "json")
    assert sorted(json.loads(r.detail)["id"] for r in spark.read.json(f"file://{tmp_path}/log").collect()) == [0, 1]


def test_digest_is_of_the_rows_alone(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("row "), (F.col("id") % 1700).cast("string")).alias("t"))
    one = table_digest(df).first()
    assert one.rows == 5000 and table_digest(df.orderBy(F.desc("id")).repartition(7)).first() == one
    assert table_digest(df.where("id <> 77")).first().digest != one.digest and table_digest(df.unionByName(df.where("id = 77"))).first().digest != one.digest
    assert table_digest(df, "t").first().rows == 5000 and table_digest(df.where("false")).first().digest == hashlib.sha256(b"").hexdigest()


def test_phases_of_a_stream(spark, tmp_path):
    """Two phases in a line, a phase again, a late line, and a run that speaks again after its state is gone."""
    start = datetime(2026, 1, 1)
    batches = [
        [("a", 0, "Loading tokenizer"), ("a", 1, "4-bit base model is a PEFT model"), ("a", 2, "loading tokenizer again"), ("b", 0, "nothing")],
        [("c", 240, "first_forward")],  # the watermark is now at 180
        [("a", 5, "first_backward, late"), ("a", 241, "loading tokenizer"), ("a", 242, "first_forward")],
        [("c", 1400, "first_backward")],  # and at 1,340: a's state, last heard of at 242, is dropped
        [("c", 1401, "save_pretrained")],
        [("a", 1402, "loading tokenizer")],
    ]
    for n, rows in enumerate(batches):
        df = spark.createDataFrame([(r, start + timedelta(minutes=m), line) for r, m, line in rows], "run string, ts timestamp, line string")
        df.coalesce(1).write.parquet(f"file://{tmp_path}/{n}")
        (part,) = [f for f in os.listdir(tmp_path / str(n)) if f.endswith(".parquet")]
        os.makedirs(tmp_path / "in", exist_ok=True)
        os.rename(tmp_path / str(n) / part, tmp_path / "in" / f"{n}.parquet")
        os.utime(tmp_path / "in" / f"{n}.parquet", (1_700_000_000 + 10 * n,) * 2)
    stream = E.read_events(spark, f"file://{tmp_path}/in", "run string, ts timestamp, line string", files=1)
    E.drain(E.phases_seen(stream), f"file://{tmp_path}/out", f"file://{tmp_path}/state")
    got = sorted((r.run, r.phase, int((r.ts - start).total_seconds() // 60)) for r in spark.read.parquet(f"file://{tmp_path}/out").collect())
    assert got == [
        ("a", "first_forward", 242), ("a", "load_base_model_4bit", 1), ("a", "load_tokenizer", 0), ("a", "load_tokenizer", 1402), ("a", "prepare_lora", 1), ("c", "first_backward", 1400), ("c", "first_forward", 240), ("c", "save_adapter", 1401),
    ]


def test_phases_of_a_table(spark):
    df = spark.createDataFrame([("a", 2, "Loading tokenizer"), ("a", 1, " loading tokenizer, peft model "), ("b", 1, "x")], "run string, n int, line string")
    assert sorted((r.run, r.phase, r.order, r.line) for r in E.phases_first(df, "n").collect()) == [("a", "load_tokenizer", 1, "loading tokenizer, peft model"), ("a", "prepare_lora", 1, "loading tokenizer, peft model")]


def test_all_classes_of_issues(spark, sf):
    from loomtext.plans import asset_queries as Q

    got = {r.issue for r in inspect.issue_counts(Q.card_inspection(spark, sf)).collect()}
    assert got == {"missing_required_fields", "source_leakage_errors", "render_errors", "schema_errors", "non_object_rows", "unmatched_chapter_ids", "cards_with_empty_lists"}
    lax = inspect.inspect_cards(spark.createDataFrame([(1, "{}"), (2, "[]")], "row_idx int, line string"), strict=False)
    assert [(r.issue, r.row_idx) for r in lax.collect()] == [("non_object_rows", 2)]


def test_run_changes_none_one_two(spark):
    data = [("r0", None, {"lr": "1", "n": "2"}), ("r1", "r0", {"lr": "1", "n": "2"}), ("r2", "r0", {"lr": "3", "n": "2"}), ("r3", "r0", {"lr": "3", "n": None, "x": None})]
    runs = spark.createDataFrame(data, "run_id string, baseline_id string, params map<string,string>")
    got = {r.run_id: (r.changed, r.error) for r in inspect.run_changes(runs).collect()}
    assert got["r0"] == (None, "baseline run not found") and got["r1"] == ([], "primary variable must change") and got["r2"] == (["lr"], None) and got["r3"][0] == ["lr", "n", "x"]


def test_sft_errors(spark):
    df = spark.createDataFrame([(1, "a", "b", "c"), (2, "a", " ", None)], "row_idx int, instruction string, input string, output string")
    assert [r.message for r in inspect.sft_errors(df, "data.jsonl").collect()] == ["data.jsonl:2 missing/invalid SFT fields: input, output"]
