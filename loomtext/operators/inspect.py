"""Inspection of cards of any shape: what is wrong with each, by class of issue; and what runs change against a baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..profile import ZH, TextProfile
from .builders import character_list, prompt, structure_list

# The fields that cards need, in the order in which they are looked at.
NEEDED = ("chapter_goal", "chapter_structure", "character_states", "must_include", "must_not_include", "target_word_count")
CARD = ("id", "style_contract", "previous_summary", "chapter_goal", "chapter_structure", "character_states", "must_include", "must_not_include", "ending_hook", "target_word_count")
LISTS = ("must_include", "must_not_include")
STRUCTURE, STATES = ("name", "goal", "estimated_chars"), ("name", "state", "speech_style")
ONLY_WARNED = tuple(f"empty required field: {f}" for f in LISTS)
SQL_ITEMS = "array<struct<step:int,name:string,goal:string,estimated_chars:string>>"


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT ... of a variant; null where it is absent."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _at(field: str, form: str = "variant", of: Column | None = None) -> Column:
    return F.try_variant_get(F.col("card") if of is None else of, f"$.{field}", form)


def _text(v: Column, field: str) -> Column:
    """A string at a path; null where it is absent or no string."""
    own = F.try_variant_get(v, f"$.{field}", "variant")
    return F.when(kind(own) == "STRING", F.try_variant_get(v, f"$.{field}", "string"))


def _items(field: str, test) -> Column:
    """The place (from 0) of the first element of a list that test finds wanting, or null."""
    found = F.transform(_at(field, "array<variant>"), lambda x, i: F.when(F.coalesce(test(x), F.lit(False)), i))
    return F.get(F.filter(found, lambda x: x.isNotNull()), F.lit(0))


def _absent(field: str) -> Column:
    return _at(field).isNull()


def _empty(field: str) -> Column:
    """Whether a field is "", null or []."""
    return F.is_variant_null(_at(field)) | (_at(field, "string") == "") | (F.size(_at(field, "array<variant>")) == 0)


def _blank(x: Column, field: str) -> Column:
    """What counts as no value of an item: absent, null, "", 0, false or an empty list."""
    own = F.try_variant_get(x, f"$.{field}", "variant")
    return own.isNull() | F.is_variant_null(own) | F.coalesce(F.try_variant_get(own, "$", "string").isin("", "0", "false"), F.lit(False)) | F.coalesce(F.size(F.try_variant_get(own, "$", "array<variant>")) == 0, F.lit(False))


def _list_error(field: str, fields: tuple[str, ...], number: str | None = None) -> Column:
    """The first fault of a list of objects, in the order of its elements."""

    def fault(x: Column, i: Column) -> Column:
        step = F.try_variant_get(x, f"$.{number}", "variant") if number else None
        out = F.when(kind(x) != "OBJECT", F.lit(" must be a dict"))
        out = out.when(~F.coalesce((kind(step) == "BIGINT") & (F.try_variant_get(step, "$", "long") >= 1), F.lit(False)), F.lit(f".{number} is required")) if number else out
        for f in fields:
            out = out.when(_blank(x, f), F.lit(f".{f} is required"))
        return F.concat(F.lit(f"{field}["), i.cast("string"), F.lit("]"), out)

    items = _at(field, "array<variant>")
    first = F.get(F.filter(F.transform(items, fault), lambda x: x.isNotNull()), F.lit(0))
    return F.when((kind(_at(field)) != "ARRAY") | (F.size(items) == 0), F.lit(f"{field} must be a non-empty list")).otherwise(first)


def card_error(required: tuple[str, ...] = CARD) -> Column:
    """What a reader of draft cards raises first, or null."""
    fields = [F.when(_absent(f), F.lit(f"missing required field: {f}")).when(F.coalesce(_empty(f), F.lit(False)) & F.lit(f not in ("chapter_structure", "character_states")), F.lit(f"empty required field: {f}")) for f in required]
    return F.coalesce(*fields, _list_error("chapter_structure", STRUCTURE, "step"), _list_error("character_states", STATES))


def _render_error() -> Column:
    """Why a card cannot be rendered: lists of another kind, items without what a line of them needs."""
    out = F.lit(None).cast("string")
    for f in reversed(LISTS):
        out = F.when(~_absent(f) & ~F.is_variant_null(_at(f)) & (kind(_at(f)) != "ARRAY"), F.lit(f"{f} cannot be rendered")).otherwise(out)
    for f in ("character_states", "chapter_structure"):
        bad = ~_absent(f) & ~F.is_variant_null(_at(f)) & ((kind(_at(f)) != "ARRAY") | F.exists(_at(f, "array<variant>"), lambda x: kind(x) != "OBJECT"))
        out = F.when(F.coalesce(bad, F.lit(False)), F.lit(f"{f} cannot be rendered")).otherwise(out)

    def step_bad(x: Column) -> Column:
        step = F.try_variant_get(x, "$.step", "variant")
        return ~F.coalesce((kind(step) == "BIGINT") & (F.try_variant_get(step, "$", "long") >= 1), F.lit(False))

    tests = [(step_bad, ".step must be a positive integer"), (lambda x: _blank(x, "name"), ".name is required"), (lambda x: _blank(x, "goal"), ".goal is required"), (lambda x: ~T.filled(_text(x, "estimated_chars")), ".estimated_chars must be a non-empty string")]
    places = [(_items("chapter_structure", test), words) for test, words in tests]
    # the earliest item wins, and in it the earliest rule
    first = F.array_min(F.array(*[F.struct(F.coalesce(place, F.lit(1 << 30)).alias("i"), F.lit(n).alias("n"), F.lit(words).alias("w")) for n, (place, words) in enumerate(places)]))
    of_items = F.when(first["i"] < (1 << 30), F.concat(F.lit("chapter_structure["), first["i"].cast("string"), F.lit("]"), first["w"]))
    return F.coalesce(out, of_items)


def _rendered() -> Column:
    text = lambda f, other="": F.when(_absent(f), F.lit(other)).otherwise(_text(F.col("card"), f))
    items = lambda f, form: F.coalesce(_at(f, form), F.array().cast(form))
    return prompt({
        **{f: text(f) for f in ("style_contract", "previous_summary", "chapter_goal", "conflict_beat", "payoff_beat", "ending_hook")}, "target_word_count": text("target_word_count", "2000-2500中文汉字"),
        "chapter_structure": structure_list(items("chapter_structure", SQL_ITEMS)), "character_states": character_list(items("character_states", "array<struct<name:string,state:string,speech_style:string>>")),
        "must_include": items("must_include", "array<string>"), "must_not_include": items("must_not_include", "array<string>"),
    })


def inspect_cards(lines: DataFrame, chapters: DataFrame | None = None, strict: bool = True, p: TextProfile = ZH) -> DataFrame:
    """issue, row_idx, card_id, message of JSON lines (row_idx, line) that may hold cards of any shape.

    Cards are variants, so no schema drops what it does not expect: a path that is absent, null or of another kind is
    told apart. strict: cards of chapters (with chapters: id) rather than of an evaluation. A card whose prompt holds a
    window of its source_text is a leak; one that cannot be rendered at all is another issue."""
    rows = lines.select("row_idx", F.try_parse_json("line").alias("card"))
    rows = rows.withColumn("shape", kind(F.col("card")))
    own = F.coalesce(F.nullif(_at("id", "string"), F.lit("")), F.lit("<missing id>"))
    rows = rows.withColumn("card_id", F.when(F.col("shape") == "OBJECT", own)).withColumn("why", F.when(F.col("shape") == "OBJECT", _render_error()))
    is_card = F.coalesce(F.col("shape") == "OBJECT", F.lit(False))
    one = lambda issue, bad, message: F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(issue).alias("issue"), message.alias("message")))
    name = lambda rest: F.concat("card_id", F.lit(": "), rest if isinstance(rest, Column) else F.lit(rest))
    found = [one("non_object_rows", ~is_card, F.concat(F.lit("row_"), F.col("row_idx").cast("string"), F.when(F.col("card").isNull(), ": not valid JSON").otherwise(": card row must be a JSON object")))]
    if strict:
        absent = F.filter(F.array(*[F.when(_absent(f), F.lit(f)) for f in NEEDED]), lambda x: x.isNotNull())
        found.append(one("missing_required_fields", is_card & (F.size(absent) > 0), F.concat("card_id", F.lit(": "), F.array_join(absent, ","))))
    for f, want, words in (("chapter_structure", "OBJECT", "dictionaries"), ("character_states", "OBJECT", "dictionaries"), *[(f, "STRING", "strings") for f in LISTS]):
        odd = (kind(_at(f)) != "ARRAY") | F.exists(_at(f, "array<variant>"), _other_than(want))
        found.append(one("schema_errors", is_card & ~_absent(f) & F.coalesce(odd, F.lit(True)), name(f"{f} must be a list of {words}")))
    if strict:
        error = card_error()
        label = F.when(_absent("id"), "<missing-id>").otherwise(F.coalesce(_at("id", "string"), F.lit("None")))
        found.append(one("schema_errors", is_card & ~error.isin(*ONLY_WARNED), F.concat(label, F.lit(": "), error)))
        found += [one("cards_with_empty_lists", is_card & (F.size(_at(f, "array<variant>")) == 0), name(f)) for f in LISTS]
    source = _text(F.col("card"), "source_text")
    leak = F.when(is_card & F.col("why").isNull(), T.leak_fragment(source, _rendered(), p.leak_window, p))
    rows = rows.withColumn("leak", leak)
    found += [one("source_leakage_errors", F.col("leak").isNotNull(), name(F.concat(F.lit("SFT input contains source_text fragment: "), "leak"))), one("render_errors", F.col("why").isNotNull(), name(F.col("why")))]
    out = rows.select("row_idx", "card_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).select("x.issue", "row_idx", "card_id", "x.message")
    if strict and chapters is not None:
        lost = rows.where(is_card).join(chapters.select(F.col("id").cast("string").alias("card_id")).distinct(), "card_id", "left_anti")
        out = out.unionByName(lost.select(F.lit("unmatched_chapter_ids").alias("issue"), "row_idx", "card_id", F.col("card_id").alias("message")))
    return out


def _other_than(want: str):
    return lambda x: F.coalesce(kind(x) != want, F.lit(True))


def run_changes(runs: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """run_id, baseline_id, changed (sorted keys whose values differ, null-safe), error of runs against their baselines.

    runs: run_id, baseline_id, params (map of texts) and, with files (path, sha256), artifacts (map path -> hash). A
    controlled experiment changes exactly one key: a key that only one side has counts as changed."""
    base = runs.select(F.col("run_id").alias("baseline_id"), F.col("params").alias("base"))
    both = runs.join(base, "baseline_id", "left")
    keys = F.array_union(F.map_keys("params"), F.map_keys("base"))
    changed = F.array_sort(F.filter(keys, lambda k: ~F.try_element_at("params", k).eqNullSafe(F.try_element_at("base", k)) | (F.map_contains_key("params", k) != F.map_contains_key("base", k))))
    out = both.withColumn("changed", F.when(F.col("base").isNotNull(), changed))
    error = F.when(F.col("base").isNull(), "baseline run not found").when(F.size("changed") == 0, "primary variable must change").when(F.size("changed") > 1, F.concat(F.lit("controlled variable changed: "), F.array_join("changed", ",")))
    if files is not None:
        named = runs.select("run_id", F.explode("artifacts").alias("path", "want")).join(files.select("path", "sha256"), "path", "left")
        bad = named.where(~F.col("want").eqNullSafe(F.col("sha256"))).groupBy("run_id").agg(F.min(F.when(F.col("sha256").isNull(), F.concat(F.lit("artifact file not found: "), "path")).otherwise(F.concat(F.lit("artifact sha256 mismatch: "), "path"))).alias("bad"))
        out = out.join(bad, "run_id", "left")
        error = F.coalesce(error, F.col("bad"))
    return out.select("run_id", "baseline_id", "changed", error.alias("error"))


def sft_errors(rows: DataFrame, path: str = "row") -> DataFrame:
    """row_idx, message of training rows (row_idx, instruction, input, output) that lack a filled text."""
    bad = F.filter(F.array(*[F.when(~T.filled(F.col(f)), F.lit(f)) for f in ("instruction", "input", "output")]), lambda x: x.isNotNull())
    return rows.where(F.size(bad) > 0).select("row_idx", F.concat(F.lit(f"{path}:"), F.col("row_idx").cast("string"), F.lit(" missing/invalid SFT fields: "), F.array_join(bad, ", ")).alias("message"))


def issue_counts(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found).groupBy("issue").agg(F.count("*").alias("n"))
