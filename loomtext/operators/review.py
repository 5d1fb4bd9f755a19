"""Reviewers' votes, paired evaluation, defects and edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules as R, text as T
from .rows import first_of

# Reviewers, severities, platforms and defect labels.
REVIEWERS = ("readthrough_structure", "male_genre_payoff", "platform_style_compliance")
SEVERITIES = ("none", "minor", "major", "blocker")
DEFECTS = ("generic_phrase", "explanation_voice", "summary_narration", "empty_intensity", "repeated_psychology", "dialogue_flatness", "payoff_blur", "hook_blur", "style_contract_drift", "plan_execution_regression")
ACCEPTED = ("accepted", "accepted_with_minor_edits")


def malformed(reviews: DataFrame, expected: DataFrame) -> DataFrame:
    """row_idx, error of review rows that do not count: first error of each."""
    known = expected.select("id").distinct().withColumn("known", F.lit(True))
    rows = reviews.join(known, "id", "left")
    error = (
        F.when(F.col("id").isNull() | F.col("reviewer").isNull() | F.col("pass").isNull() | F.col("severity").isNull(), "missing review fields")
        .when(~F.col("reviewer").isin(*REVIEWERS), F.concat(F.lit("unknown reviewer: "), "reviewer"))
        .when(~F.col("severity").isin(*SEVERITIES), F.concat(F.lit("unknown severity: "), "severity"))
        .when(F.exists("issues", lambda x: ~x.rlike(r"\A[a-z0-9_]{1,80}\z")), "issues must be safe code-like labels")
        .when(F.col("known").isNull(), F.concat(F.lit("unexpected review id: "), F.col("id").cast("string")))
    )
    return rows.withColumn("error", error).where("error is not null").select("row_idx", "id", "error")


def votes(expected: DataFrame, reviews: DataFrame) -> DataFrame:
    """A row an expected id: counts, gate, arbitration, issues and reviewers. The first review of each reviewer counts."""
    good = reviews.where(F.col("reviewer").isin(*REVIEWERS) & F.col("severity").isin(*SEVERITIES) & F.col("pass").isNotNull())
    good = good.where(~F.exists("issues", lambda x: ~x.rlike(r"\A[a-z0-9_]{1,80}\z")))
    first = first_of(good, ["id", "reviewer"], "row_idx")
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "issues"))), lambda x: x["issues"]))
    tally = first.groupBy("id").agg(
        F.count("*").alias("review_count"), F.count_if("pass").alias("pass_votes"), F.count_if(~F.col("pass")).alias("fail_votes"),
        F.count_if(F.col("severity") == "blocker").alias("blocker_votes"), ordered.alias("issues"), F.array_sort(F.collect_set("reviewer")).alias("reviewers"),
    )
    out = expected.select("id").join(tally, "id", "left")
    for c in ("review_count", "pass_votes", "fail_votes", "blocker_votes"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    none = F.array().cast("array<string>")
    out = out.withColumn("issues", F.coalesce("issues", none)).withColumn("reviewers", F.coalesce("reviewers", none))
    full = F.size("reviewers") == len(REVIEWERS)
    return out.withColumn("agent_gate_pass", full & (F.col("pass_votes") >= 2)).withColumn("requires_human_arbitration", F.col("blocker_votes") > 0)


def vote_decision(voted: DataFrame, bad: DataFrame) -> DataFrame:
    """One row: missing, blocked and arbitration counts, and the decision."""
    full = F.size("reviewers") == len(REVIEWERS)
    sums = voted.agg(
        F.count("*").alias("expected"), F.count_if(~full).alias("missing"), F.count_if(full & ~F.col("agent_gate_pass")).alias("blocked"),
        F.count_if("requires_human_arbitration").alias("arbitration"), F.coalesce(F.bool_or(F.col("pass_votes") == 2), F.lit(False)).alias("narrow"),
    )
    sums = sums.withColumn("one", F.lit(1)).join(bad.agg(F.count("*").alias("malformed"), F.lit(1).alias("one")), "one")  # one row each
    decision = F.expr(
        "case when malformed > 0 or missing > 0 then 'blocked_incomplete_agent_review' when arbitration > 0 then 'blocked_by_human_arbitration' "
        "when blocked > 0 then 'blocked_by_agent_review' when narrow then 'ready_for_human_spot_check' else 'ready_for_next_expansion' end"
    )
    return sums.select("expected", "missing", "blocked", "arbitration", "malformed", decision.alias("decision"))


def paired(baseline: DataFrame, candidate: DataFrame, judgments: DataFrame) -> DataFrame:
    """id, scores, winner, winner_source, regression. Inputs: id, hard_gate_pass, failure_types; id, winner."""
    side = lambda df, name: df.select("id", R.metric_score(F.col("hard_gate_pass"), F.col("failure_types")).alias(f"{name}_score"))
    both = side(baseline, "baseline").join(side(candidate, "candidate"), "id").join(judgments.select("id", F.col("winner").alias("judged")), "id", "left")
    by_score = F.when(F.col("candidate_score") > F.col("baseline_score"), "candidate").when(F.col("candidate_score") < F.col("baseline_score"), "baseline").otherwise("tie")
    return both.select("id", "baseline_score", "candidate_score", F.coalesce("judged", by_score).alias("winner"), F.when(F.col("judged").isNotNull(), "review").otherwise("metrics").alias("winner_source"), (F.col("candidate_score") < F.col("baseline_score")).alias("regression"))


def paired_summary(pairs: DataFrame) -> DataFrame:
    won = lambda who: F.count_if(F.col("winner") == who)
    return pairs.agg(F.count("*").alias("paired_rows"), won("candidate").alias("wins"), won("baseline").alias("losses"), won("tie").alias("ties"), F.count_if("regression").alias("regressions"))


def unpaired(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """id, missing_from of rows that one side lacks."""
    b, c = baseline.select("id"), candidate.select("id")
    return b.join(c, "id", "left_anti").withColumn("missing_from", F.lit("candidate")).unionByName(c.join(b, "id", "left_anti").withColumn("missing_from", F.lit("baseline")))


def defect_summary(defects: DataFrame) -> DataFrame:
    """Counts by label, by severity and in all, from one pass with grouping sets."""
    return defects.groupingSets([["label"], ["severity"], []], "label", "severity").agg(F.count("*").alias("n"))


def edit_burden(revisions: DataFrame, delta: Column) -> DataFrame:
    """changed chars in all; mean and median over accepted revisions; acceptance rate."""
    ok = F.col("revision_status").isin(*ACCEPTED)
    d = delta.cast("double")
    return revisions.agg(
        F.count("*").alias("revisions"), F.count_if(ok).alias("accepted"), F.coalesce(F.round(F.try_divide(F.count_if(ok), F.count("*")), 4), F.lit(0.0)).alias("acceptance_rate"),
        F.coalesce(F.sum(delta), F.lit(0)).cast("long").alias("changed_chars"), F.coalesce(F.round(F.avg(F.when(ok, d)), 4), F.lit(0.0)).alias("mean_changed"), F.coalesce(F.round(F.median(F.when(ok, d)), 4), F.lit(0.0)).alias("median_changed"),
    )
