"""Validation and decisions. A rule is a Column that is true where a row breaks it; violations are rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..sources.store import stored
from .rows import duplicates, missing


def violations(rows: DataFrame, entity: str, rules: list[tuple[Column, str]], order: str = "row_idx") -> DataFrame:
    """row_idx, entity_id, message of every broken rule, in one pass over the rows."""
    found = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(message)) for bad, message in rules]), lambda x: x.isNotNull())
    return rows.select(F.col(order).alias("row_idx"), F.col(entity).cast("string").alias("entity_id"), F.explode(found).alias("message"))


def first_violation(found: DataFrame) -> str | None:
    """What a fail-fast reader raises: the message of the first row that breaks a rule."""
    row = found.agg(F.min_by(F.struct("row_idx", "message"), "row_idx").alias("x")).first()
    return None if row.x is None else f"row {row.x.row_idx}: {row.x.message}"


def require(found: DataFrame) -> None:
    if message := first_violation(found):
        raise ValueError(message)


def union(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def references(rows: DataFrame, key: str, known: DataFrame, entity: str) -> DataFrame:
    """Duplicate and unknown ids, as violations."""
    twice = duplicates(rows, key).select(F.lit(None).cast("long").alias("row_idx"), F.col(key).cast("string").alias("entity_id"), F.lit(f"duplicate {entity} id").alias("message"))
    lost = missing(rows, known, key).distinct().select(F.lit(None).cast("long").alias("row_idx"), F.col(key).cast("string").alias("entity_id"), F.lit(f"unknown {entity} id").alias("message"))
    return twice.unionByName(lost)


def required(*fields: str) -> list[tuple[Column, str]]:
    return [(~T.filled(F.col(f).cast("string")), f"{f} must be a non-empty string") for f in fields]


def hashes(*fields: str) -> list[tuple[Column, str]]:
    return [(~T.is_sha256(F.col(f)), f"{f} must be a lowercase SHA-256") for f in fields]


def one_of(field: str, values) -> tuple[Column, str]:
    return ~F.coalesce(F.col(field).isin(*values), F.lit(False)), f"{field} must be one of: {', '.join(sorted(values))}"


def revision_rules() -> list[tuple[Column, str]]:
    # A revision's fields and states.
    text = ("revision_id", "card_id", "chapter_id", "style_contract_id", "model_output", "revised_output", "revision_author", "revised_at", "edit_summary", "acceptance_reason")
    return [*required(*text), *hashes("style_contract_sha256", "prompt_sha256", "raw_output_sha256"), one_of("revision_status", ("accepted", "accepted_with_minor_edits", "rejected", "needs_rewrite")), (F.coalesce(F.size("defect_record_ids"), F.lit(0)) == 0, "defect_record_ids must be a non-empty list")]


def defect_rules(raw: str = "raw_output") -> list[tuple[Column, str]]:
    from .review import DEFECTS

    start, end = F.col("evidence_start"), F.col("evidence_end")
    return [
        one_of("label", DEFECTS), one_of("severity", ("minor", "major", "blocker")), *required("evidence_text"), (F.col("suggested_fix").isNull(), "suggested_fix must be a string"),
        (F.coalesce(start < 0, F.lit(True)), "evidence_start must be an int >= 0"), (F.coalesce(end <= start, F.lit(True)), "evidence_end must be > evidence_start"),
        (~F.coalesce(T.evidence_holds(F.col(raw), F.col("evidence_text"), start, end), F.lit(False)), "evidence does not match the raw output"),
    ]


def generation_links(revisions: DataFrame, generations: DataFrame) -> DataFrame:
    """Revisions without a generation of the same card, prompt and raw output (and the same style, where it has one)."""
    g = generations.alias("g")
    keys = ["card_id", "prompt_sha256", "raw_output_sha256"]
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}") == F.col(f"g.{k}") for k in keys])
    style = F.col("g.style_contract_sha256").isNull() | (F.col("g.style_contract_sha256") == F.col("r.style_contract_sha256"))
    return revisions.alias("r").join(g, same & style, "left_anti")


def recompute_differs(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """field of values that differ; both are (field, value as text)."""
    return stored.alias("s").join(recomputed.alias("c"), "field", "full").where(~F.col("s.value").eqNullSafe(F.col("c.value"))).select("field", F.col("s.value").alias("stored"), F.col("c.value").alias("recomputed"))


def quality_budget(expected: DataFrame, generated: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row: counts of generations and metrics against expected ids, lengths, failures and the decision. Metrics are computed once."""
    ids = expected.select("id")
    metrics = stored(metrics.select("id", "hard_gate_pass", "char_count", "failure_types"), "metrics")
    one = lambda df: df.withColumn("one", F.lit(1))
    sums = metrics.agg(
        F.count("*").alias("metrics_rows"), F.count_if("hard_gate_pass").alias("hard_gate_pass"), F.coalesce(F.min("char_count"), F.lit(0)).alias("min_chars"), F.coalesce(F.max("char_count"), F.lit(0)).alias("max_chars"),
        *[F.count_if(F.array_contains("failure_types", k)).alias(k) for k in ("length_short", "length_long", "outline_leak")],
    )
    out = one(ids.agg(F.count("*").alias("expected_rows")))
    for df in (
        generated.agg(F.count("*").alias("generated_rows")), missing(ids, generated, "id").agg(F.count("*").alias("missing_generated")), duplicates(generated, "id").agg(F.count("*").alias("duplicate_generated")),
        missing(ids, metrics, "id").agg(F.count("*").alias("missing_metrics")), duplicates(metrics, "id").agg(F.count("*").alias("duplicate_metrics")), sums,
    ):
        out = out.join(one(df), "one")  # one row each
    decision = F.expr(
        "case when generated_rows <> expected_rows or missing_generated > 0 or duplicate_generated > 0 then 'blocked_incomplete_generation' "
        "when metrics_rows <> expected_rows or missing_metrics > 0 or duplicate_metrics > 0 then 'blocked_incomplete_metrics' "
        "when length_short > 0 then 'blocked_length_short' when length_long > 0 then 'blocked_length_long' when outline_leak > 0 then 'blocked_outline_leak' "
        "when expected_rows > 0 and hard_gate_pass = expected_rows then 'ready_for_full_50_long_eval' else 'needs_quality_review' end"
    )
    return out.withColumn("decision", decision).drop("one")


def readiness(counts: DataFrame, min_sft: int = 20, min_eval: int = 10) -> DataFrame:
    """decision, blockers of one row of counts: raw, split_rows, train, eval_split, cards, card_issues, leaks, sft, eval_cards, dry_run_exit."""
    rules = [
        ("blocked_missing_raw_text", F.col("raw") == 0),
        ("blocked_insufficient_chapters", (F.col("split_rows") == 0) | (F.col("train") == 0) | (F.col("eval_split") == 0) | ((F.col("sft") > 0) & (F.col("sft") < min_sft))),
        ("blocked_missing_chapter_cards", (F.col("cards") == 0) | (F.col("card_issues") > 0)),
        ("blocked_source_leakage", F.col("leaks") > 0),
        ("blocked_sft_empty", F.col("sft") == 0),
        ("blocked_eval_missing", F.col("eval_cards") < min_eval),
        ("blocked_stage2_dry_run_failed", F.coalesce(F.col("dry_run_exit") != 0, F.lit(True))),
    ]
    hit = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules]), lambda x: x.isNotNull())
    return counts.withColumn("blockers", hit).withColumn("decision", F.coalesce(F.get("blockers", F.lit(0)), F.lit("ready_for_stage4_smoke_training")))


def vram_cutoff(free_mib: Column) -> Column:
    """Length for the memory free: 8192 from 13 GiB, 6144 from 11 GiB, else null."""
    return F.when(free_mib >= 13 * 1024, 8192).when(free_mib >= 11 * 1024, 6144)
