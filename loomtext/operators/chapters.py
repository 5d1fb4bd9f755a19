"""Raw text to chapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..profile import ZH, TextProfile
from ..sources.store import stored
from .scan import scanned

#: States between the parts of a work: plain text, inside a note, after a note that so far is its marker alone.
PLAIN, NOTE, BARE = 0, 1, 2


def _head(p: TextProfile) -> str:
    return p.heading.removeprefix("^").removesuffix("$")


def _goes_on(p: TextProfile) -> str:
    """Lines that continue a note: to the next blank line or heading."""
    return rf"(?:\n(?!\s*$)(?!{_head(p)}).*)*"


def _notes(p: TextProfile) -> str:
    return rf"(?md){p.note}\s*[:：]?.*{_goes_on(p)}"


def _bare(text: Column, p: TextProfile) -> Column:
    """Without notes and separator lines, line ends made equal; blank lines stay."""
    text = F.regexp_replace(F.regexp_replace(text, _notes(p), ""), r"(?md)^\s*[-=*_]{3,}\s*$", "")
    return F.regexp_replace(text, r"\r\n?", "\n")


def clean_raw_text(text: Column, p: TextProfile = ZH) -> Column:
    """Without author's notes (a note runs to the next blank line or heading) and separator lines."""
    return T.normalize_newlines(_bare(text, p))


def _after_carry(text: Column, p: TextProfile) -> list[Column]:
    """What is left of a part for each state it may begin in."""
    open_note = F.regexp_replace(text, rf"(?md)\A(?!\s*$)(?!{_head(p)}).*{_goes_on(p)}", "")
    return [text, open_note, F.regexp_replace(text, rf"(?md)\A\s*[:：]?.*{_goes_on(p)}", "")]


def _state_after(text: Column, p: TextProfile) -> Column:
    """The state at the end of a text that begins in plain text: whether its last note runs to the end."""
    last = F.try_element_at(F.regexp_extract_all(text, F.lit(_notes(p)), F.lit(0)), F.lit(-1))
    marker = p.note.removeprefix("^")
    return F.when(F.endswith(text, last), F.when(last.rlike(rf"\A{marker}\s*\z"), BARE).otherwise(NOTE)).otherwise(PLAIN)


def _summary(text: Column, p: TextProfile) -> tuple[Column, Column]:
    """For each state a part may begin in: the state after it, and its headings."""
    plain, noted, bare = _after_carry(text, p)
    ends = F.array(
        _state_after(plain, p), F.when((noted == "") & (text != ""), NOTE).otherwise(_state_after(noted, p)),
        F.when(text.rlike(r"\A\s*\z"), BARE).when(bare == "", NOTE).otherwise(_state_after(bare, p)),
    )
    return ends, F.array(*[F.regexp_count(_bare(x, p), F.lit(f"(?md){p.heading}")) for x in (plain, noted, bare)])


def split_chapters(works: DataFrame, ident: str, text: str, p: TextProfile = ZH, quality: str = "A", split: str = "train", part: str | None = None) -> DataFrame:
    """A row a chapter: id, work_id, chapter_title, text, char_count, quality_tag, split. What stands before the first heading is a preface.

    part: orders the rows of a work, whose texts are then read as one, joined by line ends; a chapter or a note may run
    over several of them; rows without a work are left out. Each part is split where it lies: how many headings and whether a note stand open before it
    follows from a segmented scan over one small row a part. Only the pieces of one chapter are brought together."""
    rows = works.select(F.col(ident).alias("work_id"), (F.col(part) if part else F.lit(0)).alias("part"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).where("work_id is not null")
    if part:
        ends, adds = _summary(F.col("text"), p)
        before = scanned(rows.select(F.col("work_id").alias("key"), F.col("part").alias("order"), ends.alias("ends"), adds.alias("adds")), 3)
        rows = rows.join(before.select(F.col("key").alias("work_id"), F.col("order").alias("part"), "state", F.col("total").alias("opened")), ["work_id", "part"])
    else:
        rows = rows.withColumn("state", F.lit(PLAIN)).withColumn("opened", F.lit(0))
    plain, noted, bare = _after_carry(F.col("text"), p)
    own = _bare(F.when(F.col("state") == BARE, bare).when(F.col("state") == NOTE, noted).otherwise(plain), p)
    pieces = F.split(own, f"(?md)(?={p.heading})", -1)
    pieces = rows.select("work_id", "part", "opened", pieces.alias("pieces")).withColumn("headed", F.regexp_count(F.get("pieces", F.lit(0)), F.lit(rf"(?md)\A{_head(p)}$")))
    pieces = pieces.select("work_id", "part", "opened", "headed", F.posexplode("pieces").alias("at", "piece"))
    section = (F.col("opened") + F.col("headed") + F.col("at")).cast("long")
    is_head = (F.col("headed") > 0) | (F.col("at") > 0)
    head = rf"(?d)\A{_head(p)}(?=\n|\z)"
    body = F.when(is_head, F.regexp_replace("piece", head, "")).otherwise(F.col("piece"))
    pieces = pieces.select("work_id", "part", section.alias("section"), F.when(is_head, T.strip(F.regexp_extract("piece", head, 1))).alias("title"), body.alias("body"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "body"))), lambda x: x["body"]), "\n")
    parts = pieces.groupBy("work_id", "section").agg(F.max("title").alias("title"), T.normalize_newlines(joined).alias("text"))
    parts = stored(parts, "sections")
    # one row a work, so that no window holds the chapters of a work
    about = parts.groupBy("work_id").agg(F.max("section").alias("sections"), F.max(F.when((F.col("section") == 0) & (F.col("text") != ""), 1).otherwise(0)).alias("preface"))
    parts = parts.join(stored(about, "works"), "work_id")
    parts = parts.where((F.col("section") > 0) | (F.col("text") != "") | (F.col("sections") == 0))
    number = F.when(F.col("section") > 0, F.col("section") + F.col("preface")).otherwise(1)
    name = F.when(F.col("section") > 0, F.col("title")).when(F.col("sections") == 0, p.untitled).otherwise(p.preface)
    return parts.select(
        F.concat(F.col("work_id").cast("string"), F.lit("_chapter_"), F.when(number < 10_000, F.lpad(number.cast("string"), 4, "0")).otherwise(number.cast("string"))).alias("id"), "work_id", name.alias("chapter_title"), "text",
        T.counted_chars(F.col("text"), p).alias("char_count"), F.lit(quality).alias("quality_tag"), F.lit(split).alias("split"),
    )
