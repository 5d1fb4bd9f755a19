"""Operators on small tables: order, negative cases and invariance."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from loomtext import reports
from loomtext.operators import builders, chapters, gates, review, rows, sanitize, similar, split
from loomtext.profile import ZH
from loomtext.sources import files, jsonl


def test_first_and_last(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (3, "b", 7)], "i int, k string, v int")
    assert {(r.k, r.v) for r in rows.first_of(df, ["k"], "i").collect()} == {("a", 5), ("b", 7)}
    assert {(r.k, r.v) for r in rows.last_of(df, ["k"], "i").collect()} == {("a", 6), ("b", 7)}


def test_clean_keeps_the_first_of_each_text(spark):
    df = spark.createDataFrame([(1, "x", 600), (2, "x", 600), (3, "y", 10), (4, "z", 5000)], "i int, t string, n int")
    assert sorted(r.i for r in rows.clean(df, "t", "n", "i").collect()) == [1, 4]


def test_grouped_split_is_that_of_the_definition_and_ignores_order(spark):
    data = [(None, f"text {i % 7}") for i in range(20)] + [("n1", "a"), ("n1", "b")]
    df = spark.createDataFrame(data, "id string, text string")
    got = {(r.id, r.text): (r.split, r.group_sha256) for r in split.grouped_split(df, "id", "text", 2, 3).collect()}
    other = {(r.id, r.text): (r.split, r.group_sha256) for r in split.grouped_split(df.orderBy(F.desc("text")).repartition(3), "id", "text", 2, 3).collect()}
    assert got == other
    members = {}
    for i, t in data:
        h = hashlib.sha256(t.encode()).hexdigest()
        members.setdefault(f"id:{i}" if i else f"text:{h}", []).append(h)
    sha = {k: hashlib.sha256("\n".join(["20260625", k, *sorted(v)]).encode()).hexdigest() for k, v in members.items()}
    ranked = sorted(sha, key=sha.get)
    for i, t in data:
        k = f"id:{i}" if i else f"text:{hashlib.sha256(t.encode()).hexdigest()}"
        assert got[i, t] == ("validation" if k in ranked[:2] else "sealed" if k in ranked[2:5] else "train", sha[k])
    with pytest.raises(ValueError):
        split.grouped_split(df, "id", "text", -1, 0)


def test_seeded_split_draws_as_python_does(spark):
    df = spark.range(30).withColumnRenamed("id", "k")
    got = sorted(r.k for r in split.seeded_split(spark, df, "k", 5, 42).where("split = 'eval'").collect())
    assert got == sorted(random.Random(42).sample(range(30), 5))


def test_chapters(spark):
    text = "序言\n\n第一章 起\n甲\n\n第二章 承\n乙\n作者有话说：谢谢\n还有\n\n丙"
    got = chapters.split_chapters(spark.createDataFrame([("w", text), ("v", "无题")], "w string, t string"), "w", "t").orderBy("id").collect()
    assert [(r.id, r.chapter_title, r.text) for r in got] == [
        ("v_chapter_0001", "未命名章节", "无题"), ("w_chapter_0001", "前置正文", "序言"), ("w_chapter_0002", "第一章 起", "甲"), ("w_chapter_0003", "第二章 承", "乙\n\n丙"),
    ]


def slow_sanitize(text):
    import re

    out, events, block = [], [], False
    for n, raw in enumerate(text.replace("\r\n", "\n").replace("\r", "\n").split("\n"), 1):
        line = raw.strip()
        if not line:
            if out and out[-1]:
                out.append("")
            block = False
        elif re.search("【[^】]{1,80}】", line):
            block = True
            events.append((n, "outline_heading"))
        elif "【" in line or "】" in line:
            block = True
            events.append((n, "outline_bracket"))
        elif any(m in line for m in ZH.directive_markers):
            block = True
            events.append((n, "meta_directive"))
        elif re.match(r"^[-—_]{3,}$", line):
            block = False
            events.append((n, "separator"))
        elif re.match(r"^(?:[-*]\s+|\d+[.、]\s*)", line):
            events.append((n, "list_item"))
        elif block and len(line) <= 60 and not re.search("[。！？!?…’”）)]$", line):
            events.append((n, "meta_block_continuation"))
        else:
            block = False
            out.append(line)
    while out and not out[-1]:
        out.pop()
    return "\n".join(out).strip(), events


def test_sanitizer_against_a_fold_over_lines(spark):
    rng = random.Random(3)
    kinds = ["", "【提纲】", "【半", "本章目标：", "---", "- 项目", "1. 一", "短句", "他走了。", "长" * 70]
    texts = ["\n".join(rng.choice(kinds) for _ in range(rng.randrange(0, 14))) for _ in range(120)]
    got = sanitize.sanitize(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "i", "t").collect()
    assert len(got) == len(texts)
    for r in got:
        text, events = slow_sanitize(texts[r.id])
        assert (r.sanitized, [(e.line_number, e.reason) for e in r.events]) == (text, events)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(1)
    base = "".join(chr(0x4E00 + rng.randrange(300)) for _ in range(400))
    texts = [base, base, base[:390] + "山", base[50:], "".join(reversed(base)), base[:200] + "水" + base[200:], "", "短"]
    data = [(i, t, "train" if i % 2 else "eval") for i, t in enumerate(texts)]
    grams = [{t[i : i + 12] for i in range(len(t) - 11)} if len(t) > 12 else {t} - {""} for t in texts]
    expected = set()
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            if grams[i] and grams[j] and i % 2 != j % 2 and (o := round(len(grams[i] & grams[j]) / len(grams[i] | grams[j]), 4)) >= 0.82:
                expected.add((i, j, o))
    got = similar.near_duplicates(spark.createDataFrame(data, "i int, t string, s string"), "i", "t", "s").collect()
    assert {(r.left_id, r.right_id, r.overlap) for r in got} == expected and expected


def test_votes(spark):
    who = review.REVIEWERS
    data = [(1, 7, who[0], True, "none", []), (2, 7, who[0], False, "none", ["late"]), (3, 7, who[1], True, "blocker", ["gore"]), (4, 7, who[2], False, "minor", ["dull"]), (5, 8, who[0], True, "none", []), (6, 8, "nobody", True, "none", [])]
    rev = spark.createDataFrame(data, "row_idx int, id int, reviewer string, pass boolean, severity string, issues array<string>")
    ids = spark.createDataFrame([(7,), (8,)], "id int")
    got = {r.id: r for r in review.votes(ids, rev).collect()}
    assert (got[7].pass_votes, got[7].fail_votes, got[7].blocker_votes, got[7].issues, got[7].agent_gate_pass) == (2, 1, 1, ["gore", "dull"], True)
    assert (got[8].review_count, got[8].agent_gate_pass) == (1, False)
    bad = review.malformed(rev, ids)
    assert [r.error for r in bad.collect()] == ["unknown reviewer: nobody"]
    assert review.vote_decision(review.votes(ids, rev), bad).first().decision == "blocked_incomplete_agent_review"


def test_paired(spark):
    s = "id int, hard_gate_pass boolean, failure_types array<string>"
    b = spark.createDataFrame([(1, True, []), (2, False, ["a"]), (3, None, None)], s)
    c = spark.createDataFrame([(1, False, ["outline_leak"]), (2, True, []), (3, None, None)], s)
    j = spark.createDataFrame([(1, "candidate")], "id int, winner string")
    got = {r.id: (r.winner, r.winner_source, r.regression) for r in review.paired(b, c, j).collect()}
    assert got == {1: ("candidate", "review", True), 2: ("candidate", "metrics", False), 3: ("tie", "metrics", False)}
    assert review.paired_summary(review.paired(b, c, j)).first().asDict() == {"paired_rows": 3, "wins": 2, "losses": 0, "ties": 1, "regressions": 1}


def test_prompt_leaves_out_null_sections(spark):
    text = spark.range(1).select(builders.prompt({"previous_summary": F.lit(None).cast("string"), "must_include": F.array(F.lit("雨"))})).first()[0]
    assert "【前情摘要】\n【本章目标】" in text and "【必须出现】\n- 雨" in text and text.endswith(builders.ORDER)


def test_violations_name_the_first_row(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", " "), (3, "c", None)], "row_idx int, id string, t string")
    found = gates.violations(df, "id", gates.required("t"))
    assert gates.first_violation(found) == "row 2: t must be a non-empty string"
    with pytest.raises(ValueError, match="row 2"):
        gates.require(found)


def test_tampered_revision_breaks_one_rule(spark):
    sha = "a" * 64
    good = dict(row_idx=1, revision_id="r", card_id="c", chapter_id="h", style_contract_id="s", model_output="m", revised_output="n", revision_author="p", revised_at="t", edit_summary="e", acceptance_reason="q", style_contract_sha256=sha, prompt_sha256=sha, raw_output_sha256=sha, revision_status="accepted", defect_record_ids=["d"])
    run = lambda row: [r.message for r in gates.violations(spark.createDataFrame([row]), "revision_id", gates.revision_rules()).collect()]
    assert run(good) == []
    assert run(good | {"prompt_sha256": sha + "\n"}) == ["prompt_sha256 must be a lowercase SHA-256"]
    assert len(run(good | {"revision_status": "maybe"})) == 1


def test_readiness_order(spark):
    full = dict(raw=1, split_rows=5, train=4, eval_split=1, cards=3, card_issues=0, leaks=0, sft=30, eval_cards=12, dry_run_exit=0)
    decide = lambda **x: gates.readiness(spark.createDataFrame([full | x])).first().decision
    assert decide() == "ready_for_stage4_smoke_training"
    assert decide(raw=0) == "blocked_missing_raw_text"
    assert decide(leaks=1, eval_cards=0) == "blocked_source_leakage"
    assert decide(sft=3) == "blocked_insufficient_chapters"


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": "甲", "n": 1}\n\n{"id": "b", "n": 2}\n', encoding="utf-8")
    assert sorted((r.row_idx, r.id, r.n) for r in jsonl.read_jsonl(spark, str(p), "id string, n int").collect()) == [(1, "甲", 1), (3, "b", 2)]
    p.write_text('{"id": "a"}\n[1]\n{bad\n')
    with pytest.raises(ValueError, match=":2:"):
        jsonl.read_jsonl(spark, str(p), "id string")
    assert jsonl.count_jsonl(spark, str(p)) == (1, 2)
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), "id string").count() == 0
    with pytest.raises(FileNotFoundError):
        jsonl.read_jsonl(spark, str(tmp_path / "none"), "id string", required=True)
    out = str(tmp_path / "out")
    jsonl.write_jsonl(spark.createDataFrame([("甲", None)], "a string, b string"), out)
    text = "".join(part.read_text("utf-8") for part in (tmp_path / "out").glob("part*"))  # a part may be empty
    assert json.loads(text) == {"a": "甲", "b": None} and "甲" in text


def test_canonical_hash(spark):
    value = {"b": 1e-07, "a": "甲", "h": "x"}
    got = spark.createDataFrame([(json.dumps(value),)], "j string").select(jsonl.canonical_hash(F.col("j"), "h")).first()[0]
    assert got == hashlib.sha256('{"a":"甲","b":1e-07}'.encode()).hexdigest()


def test_texts_in_two_encodings(spark, tmp_path):
    (tmp_path / "卷").mkdir()
    (tmp_path / "卷" / "a.txt").write_bytes("林默".encode("gb18030"))
    (tmp_path / "b.MD").write_bytes("﻿雨夜".encode())
    (tmp_path / "c.bin").write_bytes(b"x")
    assert {(r.path, r.text) for r in files.read_texts(spark, str(tmp_path)).collect()} == {("卷/a.txt", "林默"), ("b.MD", "雨夜")}
    assert files.count_texts(spark, str(tmp_path)) == 2 and files.count_texts(spark, str(tmp_path / "none")) == 0


def test_samples_and_settings(spark):
    lines = lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    assert [tuple(r) for r in files.gpu_processes(lines("12, python, 300", "x, y, 3", "1,2")).collect()] == [(12, "python", 300)]
    assert {(r.key, r.kind, r.text) for r in files.flat_settings(lines("a: 1", "# b: 2", "c: 'x y'", "d: true", "e:", "f: 1.5", "none")).collect()} == {("a", "int", "1"), ("c", "string", "x y"), ("d", "bool", "true"), ("e", "null", ""), ("f", "float", "1.5")}


def test_settings_round_trip(spark):
    settings = {"a": 1, "b": 1.5, "c": True, "d": None, "e": "x y", "f": "12", "g": ""}
    lines = spark.createDataFrame([(v,) for v in files.settings_text(settings).splitlines()], "value string")
    assert {(r.key, r.kind, r.text) for r in files.flat_settings(lines).collect()} == {("a", "int", "1"), ("b", "float", "1.5"), ("c", "bool", "true"), ("d", "null", "null"), ("e", "string", "x y"), ("f", "string", "12"), ("g", "string", "")}
    with pytest.raises(TypeError):
        files.scalar_text([])


def test_line_numbers_over_splits(spark, tmp_path):
    p = tmp_path / "many.jsonl"
    p.write_text("".join(f'{{"id": {i}}}\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        lines = jsonl.numbered_lines(spark, str(p))
        assert lines.rdd.getNumPartitions() > 2
        assert lines.where(F.get_json_object("value", "$.id").cast("long") + 1 != F.col("row_idx")).count() == 0 and lines.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_report(spark):
    text = reports.report("Run", spark.createDataFrame([(2.0, 0.126)], "n double, r double"), rows=spark.createDataFrame([], "a int"), long=spark.range(1300))
    assert "(300 more rows)" in text and "| 999 |" in text
    assert "- n: 2\n- r: 0.13" in text and "(none)" in text


def slow_chapters(text):
    """The definition, on a whole text."""
    import re

    heading = re.compile(r"^[ \t　]*(第\s*[零一二三四五六七八九十百千万0-9]+\s*[章节卷集部].*)$", re.M)
    clean = lambda t: re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", t.replace("\r\n", "\n").replace("\r", "\n"))).strip()
    text = re.sub(r"^[ \t　]*(?:作者有话说|作者的话|题外话)\s*[:：]?.*(?:\n(?!\s*$)(?![ \t　]*第\s*[零一二三四五六七八九十百千万0-9]+\s*[章节卷集部]).*)*", "", text, flags=re.M)
    text = clean(re.sub(r"^\s*[-=*_]{3,}\s*$", "", text, flags=re.M))
    found = list(heading.finditer(text))
    if not found:
        return [("未命名章节", text)]
    out = [("前置正文", clean(text[: found[0].start()]))] if clean(text[: found[0].start()]) else []
    return out + [(m.group(1).strip(), clean(text[m.end() : n.start() if n else len(text)])) for m, n in zip(found, [*found[1:], None])]


def test_chapters_over_many_parts(spark):
    """Works whose chapters and notes run over many rows, in ranges that cut works anywhere."""
    rng = random.Random(3)
    lines = ["第一章 起", "  第2节 承", "作者的话", "作者有话说：谢", "题外话 多", "", "  ", "----", "甲乙丙", "丁戊 ", "己\r庚", "他说第三章好", "＊"]
    works = {f"w{w}": ["\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 5))) for _ in range(size)] for w, size in enumerate([1, 1, 2, 40, 150, 3, 60])}
    works["w9"] = ["", "作者的话", "", "\n", "还在", "仍然", "", "正文"]
    rows = [(w, i, t) for w, parts in works.items() for i, t in enumerate(parts)]
    rng.shuffle(rows)
    df = spark.createDataFrame([*rows, (None, 1, "x")], "w string, i int, t string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = chapters.split_chapters(df, "w", "t", part="i").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for w, parts in works.items():
        own = sorted((r.id, r.chapter_title, r.text) for r in got if r.work_id == w)
        assert own == [(f"{w}_chapter_{n:04d}", title, text) for n, (title, text) in enumerate(slow_chapters("\n".join(parts)), 1)], w
    assert {r.work_id for r in got} == set(works)


def test_similarity_join_over_parted_shingles_and_blocks(spark, monkeypatch):
    """Groups of near copies that share frequent shingles, with units far smaller than the groups."""
    rng = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(60)]
    base = ["".join(rng.choice(letters) for _ in range(n)) for n in (60, 90, 200)]
    texts = []
    for b in base:
        for _ in range(25):
            t = list(b)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice(letters)
            texts.append("".join(t[: len(t) - rng.randrange(8)]))
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))) for _ in range(30)] + [texts[0], texts[0], "", None, "短", "短", base[0] + base[1], base[0][:30] + base[2]]
    sets = {}
    for i, t in enumerate(texts):
        own = "".join(c for c in t or "" if "一" <= c <= "鿿")
        if own:
            sets[i] = {own} if len(own) <= 5 else {own[j : j + 5] for j in range(len(own) - 4)}
    want, ids = {}, sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            overlap = (20_000 * len(sets[a] & sets[b]) // len(sets[a] | sets[b]) + 1) // 2 / 10_000  # half up
            if overlap >= 0.7 and a % 3 != b % 3:
                want[a, b] = overlap
    df = spark.createDataFrame([(i, t, str(i % 3)) for i, t in enumerate(texts)], "id long, t string, s string").repartition(4)
    assert len(want) > 200
    for block, size in ((3, 2), (1024, 128)):
        monkeypatch.setattr(similar, "BLOCK", block)
        monkeypatch.setattr(similar, "SETS", size)
        got = {(r.left_id, r.right_id): r.overlap for r in similar.near_duplicates(df, "id", "t", "s", 0.7, 5, ZH).collect()}
        assert got == want
    links = {r.id: (r.class_id, r.n_copies, r.n_across) for r in similar.near_duplicate_links(df, "id", "t", "s", 0.7, 5, ZH).collect()}
    assert set(links) == set(ids)
    for a in ids:
        same = [b for b in ids if sets[b] == sets[a]]
        assert links[a] == (min(same), len(same) - 1, sum(a in pair for pair in want))
    assert similar.near_duplicates(df.where("false"), "id", "t", "s").collect() == []
