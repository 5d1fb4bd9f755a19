"""Chains of evidence on small tables: links that do not resolve, first faults, first generations, empty tables."""

import hashlib

import duckdb
from pyspark.sql import functions as F

from loomtext.operators import evidence as E
from loomtext.plans import evidence_queries as Q

sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


def test_every_check_of_the_gate_fires(spark, sf):
    got = Q.entry_gate(spark, sf).groupBy("check").agg(F.countDistinct(F.regexp_extract("message", r"^[^:\d]*", 0)).alias("kinds")).collect()
    assert {r.check for r in got} == {"generation", "generation link", "revision", "review", "link", "evidence", "summary", "rejection", "preference"}
    assert {r.check: r.kinds for r in got}["generation"] >= 7


def test_links_name_what_is_missing_and_what_differs(spark):
    revisions = spark.createDataFrame([(1, ["r1", "r2", "no"], "c", "x"), (2, [], "c", "x"), (3, None, "c", None)], "row_idx int, refs array<string>, card string, style string")
    reviews = spark.createDataFrame([("r1", "c", "x"), ("r2", "d", None)], "record_id string, card string, style string")
    got = {(r.child.row_idx, r.ref): (r.resolved, r.lacking, r.unequal) for r in E.links(revisions, "refs", reviews, "record_id", ("card", "style"), ("row_idx",)).collect()}
    assert got == {(1, "r1"): (True, [], []), (1, "r2"): (True, ["style"], ["card"]), (1, "no"): (False, [], []), (2, None): (False, [], []), (3, None): (False, [], [])}


def test_rows_that_repeat_a_key(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (5, "a")], "row_idx int, k string")
    found, firsts = E.again(df, "k", "c", "again: ")
    assert sorted((r.row_idx, r.message) for r in found.collect()) == [(3, "again: a"), (5, "again: a")] and sorted(r.row_idx for r in firsts.collect()) == [1, 2]


def test_a_generation_of_another_style_counts_only_before_the_first_that_fits(spark):
    accepted = spark.createDataFrame([(1, "v1", "c", "p", "o", "s"), (2, "v2", "c", "p", "z", "s")], "row_idx int, revision_id string, card_id string, prompt_sha256 string, raw_output_sha256 string, style_contract_sha256 string")
    made = spark.createDataFrame([(1, "g1", "c", "p", "o", "t"), (2, "g2", "c", "p", "o", None), (3, "g3", "c", "p", "o", "t"), (4, "g4", "c", "p", "z", "t")], "row_idx int, row_id string, card_id string, prompt_sha256 string, raw_output_sha256 string, style_contract_sha256 string")
    got = sorted(r.message for r in E.generation_link_errors(accepted, made).collect())
    assert [m.split(": ")[1] for m in got] == ["v2", "g1 v1", "g4 v2"]


def test_flat_summary_and_its_faults(spark):
    recomputed = spark.createDataFrame([("accepted_revisions", "3"), ("edit_burden.mean_changed_chars", "1.5")], "field string, value string")
    good = {k: 3 for k in E.SUMMARY_FIELDS} | {"edit_burden": {"mean_changed_chars": 1.50, "median_changed_chars": 1.0}, "boundary": E.BOUNDARY}
    got = {r.message for r in E.summary_errors(good, recomputed).collect()}
    # fields that the recomputed table lacks differ; 3 = 3 and 1.5 = 1.50 do not
    assert not any("accepted_revisions" in m or "mean_changed" in m or "missing" in m for m in got) and any(m.startswith("edit_burden.median_changed_chars") for m in got)


def test_empty_records(spark, sf):
    reviews, revisions, rejection, preference, generations = (df.where("false") for df in Q._records(spark, sf))
    got = [r.message for r in E.entry_gate({}, reviews, revisions, rejection, preference, generations).where("check = 'empty'").collect()]
    assert len(got) == 3
    summary = dict(E.review_summary(reviews.withColumn("is_first", F.lit(True)), revisions, rejection, preference, spark.createDataFrame([], "output_id string, raw_output string")).collect())
    assert summary["reviewed_outputs"] == "0" and summary["author_acceptance_rate"] == "0.0" and summary["defect_density_per_10k_chars"] == "0.0"
    assert E.same_plot_preferences(revisions, reviews).collect() == []


def test_entry_gate_writes_long_texts_once(spark, sf, monkeypatch):
    """Only the stored generations hold texts; what is written and joined after them are digests and counts."""
    longest, kept = {}, E.stored

    def spy(df, name):
        out = kept(df, name)
        texts = [F.max(F.length(c)) for c in ("raw_output", "model_output", "revised_output") if c in out.columns]
        longest[name] = max((n or 0 for n in out.agg(*texts).first()), default=0) if texts else 0
        return out

    monkeypatch.setattr(E, "stored", spy)
    Q.entry_gate(spark, sf)
    assert {name for name, n in longest.items() if n > 64} == {"generations"} and "accepted" in longest


def test_the_gate_equals_its_sql_on_odd_texts_and_repeated_ids(spark, sf, tmp_path):
    """Texts that are empty or begin with tabs and line ends, and rows that repeat a doc_id."""
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.where("doc_id < 60")
    odd = ["", " \n", "\t\t\t\t\t", "\n\n\n\n\nabc def", "     x", "abc"]
    more = spark.createDataFrame([(60 + i, t, "en", "web", len(t)) for i, t in enumerate(odd * 6)], docs.schema)
    # the other row of an id is a copy, so that no order is left open
    again = docs.where("doc_id % 9 = 4")
    docs.unionByName(more).unionByName(again).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    c = duckdb.connect()
    for t in ("documents", "labels"):
        c.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    found = lambda rows: sorted(map(repr, rows))
    assert found(tuple(r) for r in Q.entry_gate(spark, str(tmp_path)).collect()) == found(c.execute(Q.SQL["entry_gate"]).fetchall())
