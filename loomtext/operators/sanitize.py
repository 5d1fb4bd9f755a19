"""The line sanitizer: a state machine over lines, as window functions.

Blank lines and separators close a block of directives, directive lines open it, list items leave it, and a short
line that does not end like prose leaves it too (dropped if open, kept if not). So the state before a line is that of
the last line before it that set one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import rules as R, text as T
from ..profile import ZH, TextProfile


def classified(rows: DataFrame, ident: str, text: str, p: TextProfile = ZH) -> DataFrame:
    """id, line_number, line (stripped), reason (null: kept or blank), keep."""
    body = F.regexp_replace(F.col(text), r"\r\n?", "\n")
    lines = rows.select(F.col(ident).alias("id"), F.posexplode(F.split(body, "\n", -1)).alias("at", "raw"))
    lines = lines.select("id", (F.col("at") + 1).alias("line_number"), T.strip(F.col("raw")).alias("line"))
    line = F.col("line")
    marked = F.size(T.present(line, p.directive_markers)) > 0
    kind = (
        F.when(line == "", "blank").when(line.rlike(p.outline), "outline_heading").when(F.contains(line, F.lit("【")) | F.contains(line, F.lit("】")), "outline_bracket")
        .when(marked, "meta_directive").when(line.rlike(p.separator), "separator").when(line.rlike(p.list_item), "list_item")
        .when((F.length(line) <= 60) & ~line.rlike(f"[{p.prose_end}]$"), "short").otherwise("prose")
    )
    opened = F.when(F.col("kind").isin("outline_heading", "outline_bracket", "meta_directive"), True).when(F.col("kind").isin("blank", "separator", "prose"), False)
    before = Window.partitionBy("id").orderBy("line_number").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("kind", kind).withColumn("open", F.coalesce(F.last(opened, ignorenulls=True).over(before), F.lit(False)))
    reason = F.when(F.col("kind").isin("outline_heading", "outline_bracket", "meta_directive", "separator", "list_item"), F.col("kind")).when((F.col("kind") == "short") & F.col("open"), "meta_block_continuation")
    return lines.select("id", "line_number", "line", reason.alias("reason"), ((F.col("kind") != "blank") & reason.isNull()).alias("keep"))


def sanitize(rows: DataFrame, ident: str, text: str, p: TextProfile = ZH, most: int | None = 2500) -> DataFrame:
    """id, sanitized, events (array of line_number, reason, preview, in line order), capped."""
    lines = classified(rows, ident, text, p)
    order = Window.partitionBy("id").orderBy("line_number")
    blank = (F.col("line") == "").cast("int")
    seen = F.sum(blank).over(order)
    kept = lines.withColumn("blanks", seen).where("keep")
    gap = F.col("blanks") - F.lag("blanks").over(order)
    kept = kept.withColumn("piece", F.when(gap.isNull(), F.col("line")).when(gap > 0, F.concat(F.lit("\n\n"), "line")).otherwise(F.concat(F.lit("\n"), "line")))
    body = kept.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_number", "piece"))), lambda x: x["piece"]), "").alias("body"))
    dropped = lines.where("reason is not null").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("line_number", "reason", T.preview(F.col("line")).alias("preview")))).alias("events"))
    base = rows.select(F.col(ident).alias("id")).join(body, "id", "left").join(dropped, "id", "left").withColumn("body", F.coalesce("body", F.lit("")))
    final = R.cap_counted(F.col("body"), most, p) if most is not None else T.strip(F.col("body"))
    return base.select("id", final.alias("sanitized"), F.coalesce("events", F.expr("cast(array() as array<struct<line_number:int,reason:string,preview:string>>)")).alias("events"), (T.counted_chars(F.col("body"), p) > (most if most is not None else 1 << 30)).alias("capped"))
