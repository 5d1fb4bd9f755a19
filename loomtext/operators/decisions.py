"""Decisions that follow from several checks, what they recommend, and the inputs that scoring refuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from .evidence import again, say, where_broken

# Decisions and what to do about each.
RECOMMENDATIONS = {
    "blocked_incomplete_generation": "先修复推理完成率或降低 subset/budget。",
    "blocked_incomplete_metrics": "先补齐 scoring，再判断质量。",
    "blocked_length_short": "提高 long-generation budget，直到接近 2000-2500 中文汉字目标。",
    "blocked_length_long": "降低 budget 或增加停止策略，避免超过长度门槛。",
    "blocked_outline_leak": "抽查 outline leak 样本，优先修 prompt/output 格式。",
    "ready_for_full_50_long_eval": "可以进入 full 50 long eval，不要直接扩到 100。",
    "needs_quality_review": "需要人工复核失败类型后再决定下一步。",
    "ready_for_human_spot_check": "规则门和 agent gate 已通过，可进入人工抽查。",
    "ready_for_next_expansion": "规则门和 agent gate 已通过，可进入下一轮扩量。",
    "blocked_by_agent_review": "先处理 agent review 标记的质量问题，再进入下一步。",
    "blocked_by_human_arbitration": "等待人工仲裁样本处理后再继续。",
    "blocked_incomplete_agent_review": "补齐 agent review 结果后再判断扩量。",
    "rules_pass_agent_pending": "规则门已通过，等待 agent review 后再继续。",
}
READY, PENDING = "ready_for_full_50_long_eval", "rules_pass_agent_pending"
NEXT, STAY, ENOUGH = "可以进入下一阶段", "继续修数据和配置", 0.65
WINNERS = ("baseline", "candidate", "tie")


def combined_decision(rules: Column, agents: Column) -> Column:
    """The rules decide first; where they are content the agents do, if they have spoken."""
    return F.when(rules != READY, rules).otherwise(F.coalesce(agents, F.lit(PENDING)))


def recommendation(decision: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in RECOMMENDATIONS.items() for x in pair])[decision]


def next_stage(pass_rate: Column) -> Column:
    return F.when(pass_rate >= ENOUGH, NEXT).otherwise(STAY)


def output_text(raw: Column, output: Column, text: Column) -> Column:
    """The output of a row by presence: raw_output where it is there, even if empty, else output, else text, else ""."""
    return F.coalesce(raw, output, text, F.lit(""))


def filled_output(*fields: Column) -> Column:
    """The first of the fields that is not empty."""
    return F.coalesce(*[F.nullif(f, F.lit("")) for f in fields])


def scoring_inputs(outputs: DataFrame, cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row_idx, id, text of the first output of each known id; violations: repeated and unknown ids)."""
    rows = outputs.select("row_idx", F.col("id").cast("string").alias("id"), output_text(F.col("raw_output"), F.col("output"), F.col("text")).alias("text"))
    known = cards.select(F.col("id").cast("string").alias("id")).distinct()
    twice, firsts = again(rows, "id", "output", "duplicate output id: ")
    lost = rows.join(known, "id", "left_anti")
    unknown = where_broken(lost, "output", [(F.lit(True), say("output id not found in cards: ", F.col("id")))], F.col("id"))
    return firsts.join(known, "id", "left_semi").select("row_idx", "id", "text"), twice.unionByName(unknown)


def judgment_errors(judgments: DataFrame) -> DataFrame:
    """Judgments (row_idx, id, winner) that are no index: blank or repeated ids, unknown winners."""
    own = say("judgment row ", F.col("row_idx"), ": ")
    rules = [(~T.filled(F.col("id")), F.concat(own, F.lit("id must be a non-empty string"))), (~F.coalesce(F.col("winner").isin(*WINNERS), F.lit(False)), F.concat(own, F.lit(f"winner must be one of: {', '.join(WINNERS)}")))]
    twice, _ = again(judgments.where(T.filled(F.col("id"))), "id", "judgment", "duplicate judgment id: ")
    return where_broken(judgments, "judgment", rules, F.col("id")).unionByName(twice)


def generation_rows(outputs: DataFrame, model: str, params: dict[str, str], adapter: str = "", finish: str = "unknown") -> DataFrame:
    """Generation rows of outputs (id, raw_output, sanitized_output, generated_tokens, prompt, sanitizer_events); output repeats
    the raw one, and what was not sanitized stands for itself."""
    pairs = [F.lit(x) for pair in params.items() for x in pair]
    return outputs.select(
        F.col("id").cast("string").alias("id"), F.col("raw_output").alias("output"), "raw_output", F.coalesce("sanitized_output", "raw_output").alias("sanitized_output"), F.lit(model).alias("model"), F.lit(adapter).alias("adapter_dir"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("params"), F.lit(finish).alias("finish_reason"), F.coalesce("generated_tokens", F.lit(0)).alias("generated_tokens"), F.coalesce(F.sha2("prompt", 256), F.lit("")).alias("prompt_sha256"),
        F.coalesce("sanitizer_events", F.array().cast(outputs.schema["sanitizer_events"].dataType)).alias("sanitizer_events"),
    )
