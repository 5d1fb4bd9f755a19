"""Prompts and the data sets built from cards, chapters, outputs and revisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..profile import ZH, TextProfile
from .review import ACCEPTED
from .rows import last_of

# Prompt texts.
SYSTEM_PROMPT = "你是作者的正文执行器。严格执行章节卡，并保持指定作者风格。"
ORDER = "只输出正文，不输出提纲、小标题、解释、分析或提示语。"
NONE = "- 无"


def bullet_list(title: str, values: Column) -> Column:
    """A titled list; "none" if it is null or empty."""
    body = F.array_join(F.transform(values, lambda x: F.concat(F.lit("- "), x)), "\n")
    return F.concat(F.lit(f"【{title}】\n"), F.when(F.coalesce(F.size(values), F.lit(0)) == 0, NONE).otherwise(body))


def structure_list(items: Column) -> Column:
    one = lambda x: F.concat(F.lit("- "), x["step"].cast("string"), F.lit(". "), x["name"], F.lit("："), x["goal"], F.lit("（建议 "), x["estimated_chars"], F.lit("）"))
    return F.when(F.coalesce(F.size(items), F.lit(0)) == 0, f"【章节结构】\n{NONE}").otherwise(F.concat(F.lit("【章节结构】\n"), F.array_join(F.transform(items, one), "\n")))


def character_list(items: Column) -> Column:
    part = lambda x, k: F.coalesce(x[k], F.lit(""))
    one = lambda x: F.concat(F.lit("- "), part(x, "name"), F.lit("："), part(x, "state"), F.lit("；说话方式："), part(x, "speech_style"))
    return F.when(F.coalesce(F.size(items), F.lit(0)) == 0, f"【人物状态】\n{NONE}").otherwise(F.concat(F.lit("【人物状态】\n"), F.array_join(F.transform(items, one), "\n")))


def prompt(card: dict[str, Column]) -> Column:
    """A card's prompt: sections in order, null ones left out. Missing keys are empty."""
    get = lambda k: card.get(k, F.lit(""))
    return F.concat_ws(
        "\n", F.lit("【风格契约】"), get("style_contract"), F.lit("【前情摘要】"), get("previous_summary"), F.lit("【本章目标】"), get("chapter_goal"), F.lit("【冲突推进】"), get("conflict_beat"),
        F.lit("【爽点兑现】"), get("payoff_beat"), card.get("chapter_structure", F.lit(f"【章节结构】\n{NONE}")), card.get("character_states", F.lit(f"【人物状态】\n{NONE}")),
        bullet_list("必须出现", card.get("must_include", T.texts(()))), bullet_list("禁止事项", card.get("must_not_include", T.texts(()))), F.lit("【章末钩子】"), get("ending_hook"),
        F.lit("【目标字数】"), card.get("target_word_count", F.lit("2000-2500中文汉字")), F.lit("【输出要求】"), F.lit(ORDER),
    )


def chat(user: Column) -> Column:
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_PROMPT).alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def sft_rows(cards: DataFrame, chapters: DataFrame, instruction: str, p: TextProfile = ZH) -> DataFrame:
    """id, instruction, input, output of cards (id, prompt) whose chapter (id, text, split, quality_tag, row_idx; the last of an id) may be trained on.

    A prompt that holds a window of its own chapter is an error in the reference; here it is the column leak."""
    own = last_of(chapters, ["id"], "row_idx").where("split = 'train' and quality_tag = 'A'")
    rows = cards.join(own.select("id", F.col("text").alias("output")), "id")
    return rows.select("id", F.lit(instruction).alias("instruction"), F.col("prompt").alias("input"), "output", T.leak_fragment(F.col("output"), F.col("prompt"), p.leak_window, p).alias("leak"))


def preference_candidates(cards: DataFrame, outputs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Failed outputs with their prompts; reject_type is the first failure. A missing card or output is an empty one."""
    failed = metrics.where(F.size("failure_types") > 0)
    rows = failed.join(cards.select("id", "prompt"), "id", "left").join(outputs.select("id", "output"), "id", "left")
    return rows.select("id", F.coalesce("prompt", prompt({})).alias("prompt"), F.coalesce("output", F.lit("")).alias("rejected"), F.col("failure_types")[0].alias("reject_type"), F.lit("").alias("chosen"), F.lit("failed_eval").alias("source"))


def same_plot_pairs(revisions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Accepted revisions as (chosen, rejected) with the labels of the reviews they cite; unresolved is true if one is missing or of another card.

    revisions: revision_id, card_id, model_output, revised_output, revision_status, defect_record_ids.
    reviews: record_id, card_id, labels."""
    own = revisions.where(F.col("revision_status").isin(*ACCEPTED))
    cited = own.select("revision_id", F.col("card_id").alias("own_card"), F.explode("defect_record_ids").alias("record_id"))
    found = cited.join(reviews.select("record_id", "card_id", "labels"), "record_id", "left")
    labels = found.groupBy("revision_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("defect_labels"), F.bool_or(~F.col("card_id").eqNullSafe(F.col("own_card"))).alias("unresolved"))
    return own.join(labels, "revision_id").select("revision_id", "card_id", F.col("revised_output").alias("chosen"), F.col("model_output").alias("rejected"), "defect_labels", F.array_join("defect_labels", ",").alias("reject_type"), "unresolved")


def rejection_rows(revisions: DataFrame, cards: DataFrame, instruction: str) -> DataFrame:
    """Training rows of accepted revisions and their cards (card_id, prompt, split); error names what the reference raises."""
    rows = revisions.join(cards.select("card_id", "prompt", "split"), "card_id", "left")
    error = F.when(~F.col("revision_status").isin(*ACCEPTED), "revision_status must be accepted").when(F.col("prompt").isNull(), "matching formal card is required")
    return rows.select("revision_id", "card_id", F.lit(instruction).alias("instruction"), F.col("prompt").alias("input"), F.col("revised_output").alias("output"), F.coalesce("split", F.lit("unknown")).alias("source_split"), error.alias("error"))


def draft_cards(chapters: DataFrame, order: str, count: int, shortest: int, longest: int, template: list[tuple[str, str, float]]) -> DataFrame:
    """The first `count` trainable chapters of allowed length as draft cards; template: name, goal, share of the length."""
    if count < 0:
        raise ValueError("count must be >= 0")
    n = F.expr("try_cast(char_count as int)")
    rows = chapters.where((F.col("split") == "train") & (F.col("quality_tag") == "A") & n.between(shortest, longest)).orderBy(order).limit(count)
    beats = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.lit(goal).alias("goal"), T.beat_chars(n, share).cast("string").alias("estimated_chars")) for i, (name, goal, share) in enumerate(template, 1)])
    return rows.select("id", F.lit("draft-v2").alias("card_version"), F.lit("draft").alias("approval_status"), F.col("chapter_title").alias("source_title"), beats.alias("chapter_structure"), T.word_target(n).alias("target_word_count"), F.col("text").alias("source_text"))
