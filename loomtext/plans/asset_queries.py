"""Cards of any shape, runs against baselines, digests of tables and phases of logs, over tables derived from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import PHASES
from ..operators import decisions, inspect
from ..operators.digest import table_digest
from ..streaming import events as E
from .formal_queries import SPACED
from . import review_queries as reviews, text_queries as texts
from .text_queries import STRIP, _docs, gate_summary_by_lang

#: In every 31st document, by remainder: how its card differs from a good one. A field that is null is left out.
FIELDS = {
    "id": "\"d{n}\"", "style_contract": "\"plain\"", "previous_summary": "\"before\"", "chapter_goal": "\"goal\"", "chapter_structure": "[{\"step\":1,\"name\":\"open\",\"goal\":\"set\",\"estimated_chars\":\"500\"}]", "character_states": "[{\"name\":\"A\",\"state\":\"calm\",\"speech_style\":\"short\"}]",
    "must_include": "[\"the\"]", "must_not_include": "[\"x\"]", "ending_hook": "\"hook\"", "target_word_count": "\"2000\"",
}
ODD = {
    4: {"chapter_goal": None}, 5: {"must_include": "\"x\""}, 6: {"must_include": "[1]"}, 7: {"chapter_structure": "[1]"}, 8: {"must_include": "[]"}, 9: {"must_not_include": "[]", "target_word_count": None}, 10: {"ending_hook": "\"\""},
    11: {"chapter_structure": "[{\"step\":1,\"name\":\"open\",\"goal\":\"set\",\"estimated_chars\":\"500\"},{\"step\":\"2\",\"name\":\"\",\"goal\":\"set\",\"estimated_chars\":\"500\"}]"}, 13: {"id": "\"zz{n}\""}, 14: {"id": None}, 15: {"character_states": "[]"}, 16: {"previous_summary": "null"},
    17: {"chapter_structure": "[{\"step\":1,\"name\":\"open\",\"estimated_chars\":5}]"}, 18: {"character_states": "{\"name\":\"A\"}"},
}
WHOLE = {1: "[1]", 2: "\"text\"", 3: "oops{{"}


def _line(k: int) -> str:
    """A card as text, with {n} for the document's number; {goal} stands where a goal may hold its source."""
    if k in WHOLE:
        return WHOLE[k].replace("{{", "{")
    fields = FIELDS | ODD.get(k, {})
    return "{" + ",".join(f'"{f}":{v}' for f, v in fields.items() if v is not None)


def card_inspection(spark, d):
    docs = _docs(spark, d)
    n, k = F.col("doc_id").cast("string"), F.col("doc_id") % 31
    start = F.element_at(F.array(*[F.lit(_line(i)) for i in range(31)]), (k + 1).cast("int"))
    start = F.replace(start, F.lit("{n}"), n)
    source = F.regexp_replace(F.to_json(F.struct(F.col("text").alias("source_text"))), r"^\{", ",")
    # in every 12th of 31 the goal is a piece of the text itself
    start = F.when(k == 12, F.replace(start, F.lit('"chapter_goal":"goal"'), F.concat(F.lit('"chapter_goal":"goal '), F.regexp_extract("text", r"[\p{L} ]{24,60}", 0), F.lit('"')))).otherwise(start)
    lines = docs.select((F.col("doc_id") + 1).alias("row_idx"), F.when(k.isin(*WHOLE), start).otherwise(F.concat(start, source)).alias("line"))
    return inspect.inspect_cards(lines, docs.select(F.concat(F.lit("d"), n).alias("id")), True, SPACED)


def run_changes(spark, d):
    """Document n is a run whose baseline is document n - 1; its hash is the artifact, wrong in every 19th."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("quality").cast("string").alias("quality"))
    n = F.col("doc_id")
    own = docs.join(labels, "doc_id", "left").withColumn("path", F.concat(F.lit("f"), n.cast("string"))).withColumn("sha", F.sha2("text", 256))
    params = F.map_from_arrays(F.when(n % 7 == 0, F.array(F.lit("lang"), F.lit("quality"))).otherwise(F.array(F.lit("lang"), F.lit("quality"), F.lit("extra"))), F.when(n % 7 == 0, F.array("lang", "quality")).otherwise(F.array(F.col("lang"), F.col("quality"), F.lit(None).cast("string"))))
    runs = own.select(n.alias("run_id"), (n - 1).alias("baseline_id"), params.alias("params"), F.create_map("path", F.when(n % 19 == 1, F.lit("0" * 64)).otherwise(F.col("sha"))).alias("artifacts"))
    files = own.where("doc_id % 23 <> 2").select("path", F.col("sha").alias("sha256"))
    out = inspect.run_changes(runs, files)
    return out.select("run_id", "baseline_id", F.array_join("changed", ",").alias("changed"), "error")


def dataset_digest(spark, d):
    return table_digest(_docs(spark, d, "doc_id", "text", "lang", "source"))


def _log(spark, d):
    """Turns of conversations as log lines: what a turn says decides which marker stands before it."""
    c = spark.read.parquet(f"{d}/conversations.parquet")
    marks = [m for _, marks in PHASES for m in marks] + ["epoch", "loss", "Loading tokenizer and peft model"]
    at = F.octet_length("text") % len(marks) + 1
    return c.select(F.col("conv_id").cast("string").alias("run"), "turn", F.concat_ws(" ", F.element_at(F.array(*[F.lit(m) for m in marks]), at.cast("int")), "text").alias("line"))


def phase_first_seen(spark, d):
    out = E.phases_first(_log(spark, d), "turn")
    return out.select("run", "phase", F.col("order").alias("turn"), F.sha2("line", 256).alias("line_sha256"))


def scoring_inputs(spark, d):
    """Outputs whose text stands in one of three fields; some repeat an id, some name none of the cards. A row an output
    that is scored, and a row a violation."""
    n = F.col("doc_id")
    ident = F.when(n % 17 == 1, n - 1).when(n % 19 == 2, -n).otherwise(n)
    rows = _docs(spark, d).select((n + 1).alias("row_idx"), ident.alias("id"), F.when(n % 3 == 0, F.col("text")).alias("raw_output"), F.when(n % 3 <= 1, F.concat(F.lit("o"), "text")).alias("output"), F.when(n % 9 != 2, F.concat(F.lit("t"), "text")).alias("text"))
    good, bad = decisions.scoring_inputs(rows, _docs(spark, d, "doc_id").withColumnRenamed("doc_id", "id"))
    return good.select("row_idx", "id", F.sha2("text", 256).alias("sha256"), F.lit(None).cast("string").alias("message")).unionByName(bad.select("row_idx", F.col("entity_id").alias("id"), F.lit(None).cast("string").alias("sha256"), "message"))


def combined_decision(spark, d):
    """The decision of the rules over all outputs, that of the reviewers, and what follows from both."""
    one = lambda df: df.withColumn("one", F.lit(1))
    both = one(reviews.quality_budget(spark, d).select(F.col("decision").alias("rules"))).join(one(reviews.arbitration_decision(spark, d).select(F.col("decision").alias("agents"))), "one")
    cases = both.select(F.explode(F.array(F.struct("rules", "agents"), F.struct(F.lit(decisions.READY).alias("rules"), "agents"), F.struct(F.lit(decisions.READY).alias("rules"), F.lit(None).cast("string").alias("agents")))).alias("x")).select("x.*")
    return cases.withColumn("decision", decisions.combined_decision(F.col("rules"), F.col("agents"))).withColumn("recommendation", decisions.recommendation(F.col("decision")))


def stage_by_lang(spark, d):
    return gate_summary_by_lang(spark, d).select("lang", "pass_rate", decisions.next_stage(F.col("pass_rate")).alias("decision"))


def judgment_errors(spark, d):
    """Labels as judgments: quality decides the winner, some are no winner, some repeat an id, some have none."""
    n = F.col("doc_id")
    rows = spark.read.parquet(f"{d}/labels.parquet").select((n + 1).alias("row_idx"), F.when(n % 13 == 0, " ").otherwise((F.when(n % 11 == 0, n - n % 2).otherwise(n)).cast("string")).alias("id"), F.when(n % 7 == 0, "both").when(F.col("quality") == 1, "candidate").otherwise("tie").alias("winner"))
    return decisions.judgment_errors(rows)


# ---- the same in SQL

_MARKS = [m for _, marks in PHASES for m in marks] + ["epoch", "loss", "Loading tokenizer and peft model"]
_FRAGMENT = "flatten([[substr(r, i, 24) for i in range(1, length(r) - 22)] for r in regexp_extract_all(text, '[\\p{L} ]{24,}')])"


def _issues() -> list[tuple[int, str, str]]:
    """(remainder, issue, message with {n}) of the planted faults; the leaks are found by their windows."""
    out = [(k, "non_object_rows", "row_{row}: " + ("not valid JSON" if k == 3 else "card row must be a JSON object")) for k in WHOLE]
    lists = lambda f, what: f"{{id}}: {f} must be a list of {what}"
    out += [(4, "missing_required_fields", "{id}: chapter_goal"), (4, "schema_errors", "d{n}: missing required field: chapter_goal"), (5, "schema_errors", lists("must_include", "strings")), (5, "render_errors", "{id}: must_include cannot be rendered"), (6, "schema_errors", lists("must_include", "strings")),
            (7, "schema_errors", lists("chapter_structure", "dictionaries")), (7, "schema_errors", "d{n}: chapter_structure[0] must be a dict"), (7, "render_errors", "{id}: chapter_structure cannot be rendered"), (8, "cards_with_empty_lists", "{id}: must_include"), (9, "cards_with_empty_lists", "{id}: must_not_include"),
            (9, "missing_required_fields", "{id}: target_word_count"), (10, "schema_errors", "d{n}: empty required field: ending_hook"), (11, "schema_errors", "d{n}: chapter_structure[1].step is required"), (11, "render_errors", "{id}: chapter_structure[1].step must be a positive integer"), (13, "unmatched_chapter_ids", "zz{n}"),
            (14, "unmatched_chapter_ids", "<missing id>"), (14, "schema_errors", "<missing-id>: missing required field: id"), (15, "schema_errors", "d{n}: character_states must be a non-empty list"), (16, "schema_errors", "d{n}: empty required field: previous_summary"), (17, "schema_errors", "d{n}: chapter_structure[0].goal is required"),
            (17, "render_errors", "{id}: chapter_structure[0].goal is required"), (18, "schema_errors", lists("character_states", "dictionaries")), (18, "schema_errors", "d{n}: character_states must be a non-empty list"), (18, "render_errors", "{id}: character_states cannot be rendered")]
    return out


SQL = {
    "card_inspection": f"""with k as (select doc_id, doc_id % 31 as k, doc_id + 1 as row_idx, case doc_id % 31 when 1 then null when 2 then null when 3 then null when 13 then 'zz' || doc_id when 14 then '<missing id>' else 'd' || doc_id end as card_id, regexp_extract(text, '[\\p{{L}} ]{{24,60}}') as piece, {_FRAGMENT} as g from documents),
p as (select * from (values {", ".join(f"({k}, '{i}', '{m}')" for k, i, m in _issues())}) as p(k, issue, message))
select issue, row_idx, card_id, replace(replace(replace(message, '{{n}}', doc_id::varchar), '{{row}}', row_idx::varchar), '{{id}}', coalesce(card_id, '')) as message from k join p using (k)
union all select 'source_leakage_errors', row_idx, card_id, card_id || ': SFT input contains source_text fragment: ' || list_filter(g, lambda w: contains('goal ' || piece, w))[1] from k where k = 12 and piece <> ''""",
    "run_changes": """with o as (select doc_id as n, lang, quality::varchar as quality, sha256(text) as sha from documents left join labels using (doc_id)),
b as (select o.n, o.sha, p.n is null as none, list_filter([case when (o.n % 7 = 0) <> (p.n % 7 = 0) then 'extra' end, case when o.lang is distinct from p.lang then 'lang' end, case when o.quality is distinct from p.quality then 'quality' end], lambda x: x is not null) as changed from o left join o p on p.n = o.n - 1)
select n as run_id, n - 1 as baseline_id, case when none then null else array_to_string(changed, ',') end as changed, case when none then 'baseline run not found' when len(changed) = 0 then 'primary variable must change' when len(changed) > 1 then 'controlled variable changed: ' || array_to_string(changed, ',')
 when n % 23 = 2 then 'artifact file not found: f' || n when n % 19 = 1 then 'artifact sha256 mismatch: f' || n end as error from b""",
    "dataset_digest": """with r as (select sha256('{"doc_id":' || doc_id || ',"lang":' || to_json(lang)::varchar || ',"source":' || to_json(source)::varchar || ',"text":' || to_json(text)::varchar || '}') as d from documents), c as (select d, count(*) as n from r group by d),
s as (select greatest(0, ceil(log(greatest(1, count(*) / 256)) / log(16) - 1e-9))::int as depth, sum(n)::bigint as rows from c),
l3 as (select left(d, depth) as pre, sha256(string_agg(d || ':' || n, ',' order by d || ':' || n)) as d from c, s group by 1), l2 as (select left(pre, 2) as pre, case when any_value(depth) > 2 then sha256(string_agg(pre || ':' || d, ',' order by pre || ':' || d)) else any_value(d) end as d from l3, s group by 1),
l1 as (select left(pre, 1) as pre, case when any_value(depth) > 1 then sha256(string_agg(pre || ':' || d, ',' order by pre || ':' || d)) else any_value(d) end as d from l2, s group by 1), l0 as (select case when any_value(depth) > 0 then sha256(string_agg(pre || ':' || d, ',' order by pre || ':' || d)) else any_value(d) end as d from l1, s)
select rows, d as digest from l0, s""",
    "phase_first_seen": f"""with l as (select conv_id::varchar as run, turn, (({_MARKS})[octet_length(encode(text)) % {len(_MARKS)} + 1] || ' ' || text) as line0 from conversations), s as (select run, turn, {STRIP.format('line0')} as line from l),
h as (select run, turn, line, unnest(list_filter([{", ".join("case when " + " or ".join(f"contains(lower(line), '{m}')" for m in marks) + f" then '{name}' end" for name, marks in PHASES)}], lambda x: x is not null)) as phase from s)
select run, phase, min(turn) as turn, sha256(arg_min(line, (turn, line))) as line_sha256 from h group by run, phase""",
    "scoring_inputs": """with o as (select doc_id + 1 as row_idx, (case when doc_id % 17 = 1 then doc_id - 1 when doc_id % 19 = 2 then -doc_id else doc_id end) as id, case when doc_id % 3 = 0 then text when doc_id % 3 = 1 then 'o' || text when doc_id % 9 <> 2 then 't' || text else '' end as text from documents),
k as (select *, min(row_idx) over (partition by id) as first_row, id in (select doc_id from documents) as known from o)
select row_idx, id::varchar as id, sha256(text) as sha256, null::varchar as message from k where row_idx = first_row and known union all select row_idx, id::varchar, null, 'duplicate output id: ' || id from k where row_idx > first_row
union all select row_idx, id::varchar, null, 'output id not found in cards: ' || id from k where not known""",
    "combined_decision": f"""with a as (select decision as rules from ({reviews.SQL["quality_budget"]})), b as (select decision as agents from ({reviews.SQL["arbitration_decision"]})),
c as (select rules, agents from a, b union all select '{decisions.READY}', agents from b union all select '{decisions.READY}', null), d as (select *, case when rules <> '{decisions.READY}' then rules else coalesce(agents, '{decisions.PENDING}') end as decision from c)
select *, case decision {" ".join(f"when '{k}' then '{v}'" for k, v in decisions.RECOMMENDATIONS.items())} end as recommendation from d""",
    "stage_by_lang": f"select lang, pass_rate, case when pass_rate >= 0.65 then '{decisions.NEXT}' else '{decisions.STAY}' end as decision from ({texts.SQL['gate_summary_by_lang']})",
    "judgment_errors": """with j as (select doc_id + 1 as row_idx, case when doc_id % 13 = 0 then ' ' else (case when doc_id % 11 = 0 then doc_id - doc_id % 2 else doc_id end)::varchar end as id, case when doc_id % 7 = 0 then 'both' when quality = 1 then 'candidate' else 'tie' end as winner from labels),
f as (select *, min(row_idx) over (partition by id) as first_row from j)
select 'judgment' as "check", row_idx, id as entity_id, 'judgment row ' || row_idx || ': id must be a non-empty string' as message from j where id = ' ' union all select 'judgment', row_idx, id, 'judgment row ' || row_idx || ': winner must be one of: baseline, candidate, tie' from j where winner = 'both'
union all select 'judgment', row_idx, id, 'duplicate judgment id: ' || id from f where id <> ' ' and row_idx > first_row""",
}
QUERIES = {name: globals()[name] for name in SQL}
