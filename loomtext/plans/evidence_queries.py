"""Chains of evidence over documents: document n is a generated output oN, its review rN, its revision vN and the rows
built from it. Every kind of record carries each of its faults in a share of its rows, so every check has work."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import evidence as E
from ..operators.review import DEFECTS
from ..profile import LATIN as P
from .formal_queries import APPROVED, _cards

SUMMARY = {"reviewed_outputs": 0, "revision_records": 5, "accepted_revisions": True, "defects": {"total_defects": 1, "by_label": {"no_such_label": 2}}, "edit_burden": {"mean_changed_chars": 0.0}, "non_train_rejection_sampling_rows": 3, "boundary": "open"}


def _base(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").alias("n"), "text", "source")
    labels = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("n"), "quality")
    return docs.join(labels, "n", "left").withColumn("sha", F.sha2("text", 256)).withColumn("style", F.sha2("source", 256)).withColumn("row_idx", F.col("n") + 1)


def _name(prefix: str, n=None):
    return F.concat(F.lit(prefix), (F.col("n") if n is None else n).cast("string"))


def _planted(modulus: int, good, **bad):
    """good, but for the rows whose number leaves the remainder k: there bad['_k']."""
    out = F
    for k, v in bad.items():
        out = out.when(F.col("n") % modulus == int(k[1:]), v if not isinstance(v, (str, type(None))) else F.lit(v))
    return out.otherwise(good)


X = hashlib.sha256(b"x").hexdigest()


def _generations(spark, d):
    g = lambda good, **bad: _planted(61, good, **bad)
    n = F.col("n")
    return _base(spark, d).select(
        "row_idx", g(_name("o"), _1=None, _9=_name("o", n - 1)).alias("source_output_id"), F.lit(None).cast("string").alias("id"), g(_name("c"), _12=None).alias("card_id"), g(F.sha2(_name("p"), 256), _2=None, _3="X").alias("prompt_sha256"),
        g(F.col("text"), _4=None).alias("raw_output"), F.lit(None).cast("string").alias("output"), g(F.when(n % 2 == 0, F.col("sha")), _5=X, _6="bad").alias("raw_output_sha256"), F.when(n % 61 != 7, n).alias("seed"), g(F.col("style"), _8="zz", _10=None, _11=X).alias("style_contract_sha256"),
    )


def _reviews(spark, d):
    r = lambda good, **bad: _planted(67, good, **bad)
    n = F.col("n")
    label = F.element_at(T.texts(DEFECTS), (n % 10 + 1).cast("int"))
    defect = F.struct(r(label, _4="ugly").alias("label"), F.when(n % 2 == 0, "minor").otherwise("major").alias("severity"), r(F.left("text", F.lit(5)), _5="?????").alias("evidence_text"), F.lit(0).alias("evidence_start"), F.lit(5).alias("evidence_end"), F.lit("").alias("suggested_fix"))
    defects = F.when(n % 67 == 7, F.array().cast("array<struct<label:string,severity:string,evidence_text:string,evidence_start:int,evidence_end:int,suggested_fix:string>>")).otherwise(F.array(defect))
    return _base(spark, d).select(
        "row_idx", r(_name("r"), _2=_name("r", n - 1)).alias("record_id"), F.lit(1).alias("schema_version"), r(_name("c"), _10="cx").alias("card_id"), r(_name("h"), _8="hx").alias("chapter_id"), r(F.lit("style-1"), _9="style-2").alias("style_contract_id"), r(F.col("style"), _11=X).alias("style_contract_sha256"),
        r(_name("o"), _1="nowhere").alias("source_output_id"), r(F.col("sha"), _3=X).alias("raw_output_sha256"), F.when(n % 3 == 0, "author").otherwise("bot").alias("reviewer"), F.when(n % 4 == 0, "blind_review").alias("review_source"), F.lit("t").alias("reviewed_at"), defects.alias("defects"),
        r(F.lit("accepted"), _6="fine").alias("overall_acceptance"), F.lit("").alias("notes"),
    )


def _revisions(spark, d):
    v = lambda good, **bad: _planted(71, good, **bad)
    n = F.col("n")
    cited = F.when(n % 5 == 0, F.array(_name("r"), _name("r", n + 1))).otherwise(F.array(_name("r")))
    return _base(spark, d).select(
        "row_idx", v(_name("v"), _1=_name("v", n - 1)).alias("revision_id"), F.lit(1).alias("schema_version"), _name("c").alias("card_id"), _name("h").alias("chapter_id"), F.lit("style-1").alias("style_contract_id"), v(F.col("style"), _7=" ").alias("style_contract_sha256"),
        v(F.sha2(_name("p"), 256), _4=X).alias("prompt_sha256"), v(F.col("sha"), _2=X).alias("raw_output_sha256"), F.col("text").alias("model_output"), v(F.concat("text", F.lit(" more")), _5=" ").alias("revised_output"),
        F.when(F.coalesce("quality", F.lit(1)) == 1, F.when(n % 2 == 0, "accepted").otherwise("accepted_with_minor_edits")).otherwise("rejected").alias("revision_status"), F.lit("a").alias("revision_author"), F.lit("t").alias("revised_at"), F.lit("e").alias("edit_summary"),
        v(cited, _3=F.array(_name("gone")), _6=F.array(F.lit(" ")), _8=F.array().cast("array<string>")).alias("defect_record_ids"), F.lit("ok").alias("acceptance_reason"),
    )


def _rejection(spark, d):
    x = lambda good, **bad: _planted(73, good, **bad)
    return _base(spark, d).select(
        "row_idx", F.lit("write").alias("instruction"), x(F.lit("prompt"), _4=" ").alias("input"), x(F.concat("text", F.lit(" more")), _3="other").alias("output"), x(_name("v"), _2="unknown").alias("revision_id"), _name("c").alias("card_id"), x(_name("h"), _5="hx").alias("chapter_id"),
        F.col("style").alias("style_contract_sha256"), F.col("sha").alias("raw_output_sha256"), x(F.lit("train"), _1="sealed", _6=None).alias("source_split"),
    )


def _preference(spark, d):
    x = lambda good, **bad: _planted(79, good, **bad)
    n = F.col("n")
    label = F.element_at(T.texts(DEFECTS), (n % 10 + 1).cast("int"))
    return _base(spark, d).where("n % 5 <> 0").select(
        "row_idx", x(_name("v"), _2="unknown").alias("id"), F.sha2(_name("p"), 256).alias("prompt_sha256"), _name("c").alias("card_id"), _name("h").alias("chapter_id"), F.col("style").alias("style_contract_sha256"), x(F.concat("text", F.lit(" more")), _5="other").alias("chosen"), F.col("text").alias("rejected"),
        F.array(_name("r")).alias("defect_record_ids"), x(F.array(label), _3=F.array(F.lit("hook_blur"), F.lit("payoff_blur")), _4=F.array().cast("array<string>")).alias("defect_labels"), x(label, _6="none").alias("reject_type"), x(F.lit(E.SOURCE), _1="elsewhere").alias("source"),
    )


def review_index_errors(spark, d):
    return E.review_index_errors(_reviews(spark, d))


def provenance_links(spark, d):
    """Each citation of a review by a revision: what does not resolve, and the columns in which both differ."""
    reviews = _reviews(spark, d).where("record_id is not null")
    _, index = E.again(reviews, "record_id", "index", "")
    out = E.links(_revisions(spark, d), "defect_record_ids", index, "record_id", E.PROVENANCE, ("row_idx", "revision_id"))
    return out.select("child.row_idx", F.col("place").cast("long").alias("place"), "ref", "resolved", F.array_join("lacking", ",").alias("lacking"), F.array_join("unequal", ",").alias("unequal"))


def same_plot_preferences(spark, d):
    out = E.same_plot_preferences(_revisions(spark, d), _reviews(spark, d))
    return out.select("row_idx", "id", "card_id", F.sha2("chosen", 256).alias("chosen"), F.sha2("rejected", 256).alias("rejected"), F.array_join("defect_record_ids", ",").alias("record_ids"), "reject_type", "source", "error")


def rejection_sampling(spark, d):
    """Revisions of formal cards under one contract, each of the five columns unequal in some."""
    cards = _cards(spark, d, APPROVED)
    own = _base(spark, d)
    v = lambda good, **bad: _planted(71, good, **bad)
    prompts = cards.withColumn("error", E.first_error(E.card_rules(cards))).select("row_idx", "card_id", "chapter_id", F.when(F.col("error").isNull(), F.sha2(E.formal_prompt(APPROVED), 256)).alias("own_prompt"))
    rows = own.join(prompts, "row_idx").select(
        "row_idx", _name("v").alias("revision_id"), F.lit(1).alias("schema_version"), v(F.col("card_id"), _1="card-none").alias("card_id"), v(F.col("chapter_id"), _2="hx").alias("chapter_id"), v(F.lit("style-1"), _3="style-2").alias("style_contract_id"), v(F.lit(APPROVED["contract_sha256"]), _4=X).alias("style_contract_sha256"),
        v(F.coalesce("own_prompt", F.lit(X)), _5=X).alias("prompt_sha256"), v(F.col("sha"), _6=X).alias("raw_output_sha256"), F.col("text").alias("model_output"), F.concat("text", F.lit(" more")).alias("revised_output"), F.when(F.coalesce("quality", F.lit(1)) == 1, "accepted").otherwise("rejected").alias("revision_status"),
        F.lit("a").alias("revision_author"), F.lit("t").alias("revised_at"), F.lit("e").alias("edit_summary"), F.array(_name("r")).alias("defect_record_ids"), F.lit("ok").alias("acceptance_reason"),
    )
    out = E.rejection_sampling_rows(rows, cards, APPROVED)
    return out.select("row_idx", "revision_id", "card_id", "chapter_id", F.when(F.col("error").isNull(), F.sha2("input", 256)).alias("input_sha256"), F.sha2("output", 256).alias("output_sha256"), "source_split", "error")


def _records(spark, d):
    return _reviews(spark, d), _revisions(spark, d), _rejection(spark, d), _preference(spark, d), _generations(spark, d)


def entry_gate(spark, d):
    return E.entry_gate(SUMMARY, *_records(spark, d), P)


def review_summary(spark, d):
    """The summary over records that hold: an output reviewed twice counts its characters once."""
    reviews, revisions, rejection, preference, generations = _records(spark, d)
    made, _ = E.checked_generations(generations, P)
    revised, _ = E.checked_revisions(revisions, P)
    reviewed, _ = E.checked_reviews(reviews, made)
    twice = reviewed.unionByName(reviewed.where("row_idx % 7 = 0"))
    return E.review_summary(twice, revised, rejection, preference, made, P)


# ---- the same in SQL

_LABELS = str(list(DEFECTS))
_STATES = "('accepted', 'accepted_with_minor_edits', 'rejected', 'needs_rewrite')"
_ACCEPTED = "('accepted', 'accepted_with_minor_edits')"
_COUNT = r"length(regexp_replace({}, '[^\p{{L}}]', '', 'g'))"
_HEX = "regexp_full_match({}, '[0-9a-f]{{64}}')"
RECORDS = f"""d as (select doc_id as n, doc_id + 1 as row_idx, text, sha256(text) as sha, sha256(source) as style, coalesce(quality, 1) = 1 as good from documents left join labels using (doc_id)),
gen as (select row_idx, n, case n % 61 when 1 then null when 9 then 'o' || (n - 1) else 'o' || n end as output_id, case when n % 61 = 12 then null else 'c' || n end as card, case n % 61 when 2 then null when 3 then 'X' else sha256('p' || n) end as prompt_sha256,
  case when n % 61 = 4 then null else text end as raw, case when n % 61 = 5 then sha256('x') when n % 61 = 6 then 'bad' when n % 2 = 0 then sha end as given, case when n % 61 <> 7 then n end as seed, case n % 61 when 8 then 'zz' when 10 then null when 11 then sha256('x') else style end as style from d),
gx as (select *, coalesce(output_id, card, 'row-' || row_idx) as row_id, coalesce(card, output_id) as card_id, list_filter([case when n % 61 = 6 then 'invalid raw_output_sha256' end, case when n % 61 = 5 then 'raw_output_sha256 mismatch' end, case when output_id is null then 'missing output id' end,
  case when n % 61 = 3 then 'invalid prompt_sha256' end, case when n % 61 = 2 then 'missing prompt_sha256' end, case when raw is null then 'missing raw output' end, case when seed is null then 'missing integer seed' end, case when n % 61 = 8 then 'invalid style_contract_sha256' end], lambda x: x is not null) as bad from gen),
gv as (select *, min(row_idx) over (partition by output_id) as first_row, sha256(raw) as raw_sha from gx where len(bad) = 0), made as (select * from gv where row_idx = first_row),
rev as (select row_idx, n, case when n % 67 = 2 then 'r' || (n - 1) else 'r' || n end as record_id, case when n % 67 = 10 then 'cx' else 'c' || n end as card_id, case when n % 67 = 8 then 'hx' else 'h' || n end as chapter_id, case when n % 67 = 9 then 'style-2' else 'style-1' end as contract_id,
  case when n % 67 = 11 then sha256('x') else style end as style, case when n % 67 = 1 then 'nowhere' else 'o' || n end as output_id, case when n % 67 = 3 then sha256('x') else sha end as raw_sha, case when n % 3 = 0 then 'author' else 'bot' end as reviewer, case when n % 4 = 0 then 'blind_review' end as review_source,
  case when n % 67 = 7 then null when n % 67 = 4 then 'ugly' else ({_LABELS})[n % 10 + 1] end as label, case when n % 2 = 0 then 'minor' else 'major' end as severity, case when n % 67 = 5 then '?????' else left(text, 5) end as evidence, case when n % 67 = 6 then 'fine' else 'accepted' end as acceptance from d),
rx as (select rev.*, case when made.raw is null then 'raw output not found for source_output_id: ' || rev.output_id when acceptance = 'fine' then 'overall_acceptance must be one of: accepted, accepted_with_minor_edits, needs_rewrite, rejected' when rev.raw_sha <> made.raw_sha then 'raw_output_sha256 mismatch'
  when label = 'ugly' then 'defects[0].label must be one of: {", ".join(sorted(DEFECTS))}' when label is not null and trim(evidence) = '' then 'defects[0].evidence_text must be a non-empty string' when label is not null and left(made.raw, 5) <> evidence then 'defects[0].evidence span does not match evidence_text' end as error from rev left join made on made.output_id = rev.output_id),
rv as (select *, row_number() over (partition by record_id order by row_idx) as nth from rx where error is null), ri as (select * from rv where nth = 1),
vis as (select row_idx, n, case when n % 71 = 1 then 'v' || (n - 1) else 'v' || n end as revision_id, 'c' || n as card_id, 'h' || n as chapter_id, 'style-1' as contract_id, case when n % 71 = 7 then ' ' else style end as style, case when n % 71 = 4 then sha256('x') else sha256('p' || n) end as prompt_sha256,
  case when n % 71 = 2 then sha256('x') else sha end as raw_sha, text as model_output, case when n % 71 = 5 then ' ' else text || ' more' end as revised_output, case when good then case when n % 2 = 0 then 'accepted' else 'accepted_with_minor_edits' end else 'rejected' end as status,
  case n % 71 when 3 then ['gone' || n] when 6 then [' '] when 8 then [] else case when n % 5 = 0 then ['r' || n, 'r' || (n + 1)] else ['r' || n] end end as refs, sha from d),
vx as (select *, case when trim(model_output) = '' then 'model_output must be a non-empty string' when n % 71 = 5 then 'revised_output must be a non-empty string' when n % 71 = 7 then 'style_contract_sha256 must be a 64-character lowercase hex string' when raw_sha <> sha then 'raw_output_sha256 mismatch' when n % 71 = 6 then 'defect_record_ids must contain non-empty strings' end as error from vis),
vv as (select * from vx where error is null), acc as (select *, row_number() over (partition by revision_id order by row_idx) as nth from vv where status in {_ACCEPTED}), uni as (select * from acc where nth = 1),
rej as (select row_idx, n, case when n % 73 = 4 then ' ' else 'prompt' end as input, case when n % 73 = 3 then 'other' else text || ' more' end as output, case when n % 73 = 2 then 'unknown' else 'v' || n end as revision_id, 'c' || n as card_id, case when n % 73 = 5 then 'hx' else 'h' || n end as chapter_id, style, sha as raw_sha, case n % 73 when 1 then 'sealed' when 6 then null else 'train' end as split from d),
prf as (select row_idx, n, case when n % 79 = 2 then 'unknown' else 'v' || n end as id, sha256('p' || n) as prompt_sha256, 'c' || n as card_id, 'h' || n as chapter_id, style, case when n % 79 = 5 then 'other' else text || ' more' end as chosen, text as rejected, ['r' || n] as refs,
  case n % 79 when 3 then ['hook_blur', 'payoff_blur'] when 4 then [] else [({_LABELS})[n % 10 + 1]] end as labels, case when n % 79 = 6 then 'none' else ({_LABELS})[n % 10 + 1] end as reject_type, case when n % 79 = 1 then 'elsewhere' else '{E.SOURCE}' end as source from d where n % 5 <> 0)"""


def _pairs(rows, sep=",") -> str:
    return "list_filter([" + ", ".join(f"case when {bad} then {message} end" for bad, message in rows) + "], lambda x: x is not null)"


_PROV = {"card_id": "card_id", "chapter_id": "chapter_id", "style_contract_id": "contract_id", "style_contract_sha256": "style", "raw_output_sha256": "raw_sha"}
_UNEQUAL = lambda a, b: _pairs([(f"{a}.{c} is distinct from {b}.{c}", f"'{f}'") for f, c in _PROV.items()])
_SUMMARY = f"""
xr as (select count(*) as n, count(label) as defects, count(*) filter (where label = 'plan_execution_regression') as regress from z), xc as (select coalesce(sum({_COUNT.format('raw')}), 0)::bigint as chars from made where output_id in (select output_id from z)),
xd as (select status in {_ACCEPTED} as ok, abs({_COUNT.format('model_output')} - {_COUNT.format('revised_output')}) as delta from vv),
xb as (select count(*) as n, count(*) filter (where ok) as accepted, coalesce(sum(delta), 0)::bigint as delta, coalesce(round(avg(delta) filter (where ok), 4), 0.0) as mean, coalesce(round(median(delta) filter (where ok), 4), 0.0)::double as median from xd),
own as (select 'reviewed_outputs' as field, n::varchar as value from xr union all select 'reviewed_output_chars', chars::varchar from xc union all select 'defects.total_defects', defects::varchar from xr union all select 'defect_density_per_10k_chars', (case when chars = 0 then 0.0 else round(defects / chars * 10000, 4) end)::varchar from xr, xc
union all select 'revision_records', n::varchar from xb union all select 'accepted_revisions', accepted::varchar from xb union all select 'author_acceptance_rate', round(accepted / n, 4)::varchar from xb union all select 'changed_char_delta', delta::varchar from xb union all select 'edit_burden.mean_changed_chars', mean::varchar from xb
union all select 'edit_burden.median_changed_chars', median::varchar from xb union all select 'rejection_sampling_sft_rows', count(*)::varchar from rej union all select 'non_train_rejection_sampling_rows', count(*)::varchar from rej where split is distinct from 'train' union all select 'preference_candidate_rows', count(*)::varchar from prf
union all select 'plan_execution_regressions', regress::varchar from xr union all select 'defects.by_label.' || label, count(*)::varchar from z where label is not null group by label union all select 'defects.by_severity.' || severity, count(*)::varchar from z where label is not null group by severity
union all select 'candidate_split_counts.' || coalesce(split, 'unknown'), count(*)::varchar from rej group by 1 , coalesce(split, 'unknown') union all select 'review_source_counts.' || coalesce(review_source, reviewer), count(*)::varchar from z group by coalesce(review_source, reviewer) union all select 'boundary', '{E.BOUNDARY}')""".replace("group by 1 , coalesce", "group by coalesce")
_LINKS = f"""lk as (select row_idx, revision_id, unnest(case when len(refs) = 0 then [null] else refs end) as ref, generate_subscripts(case when len(refs) = 0 then [null] else refs end, 1) - 1 as place, card_id, chapter_id, contract_id, style, raw_sha from {{of}}),
lx as (select l.row_idx, l.revision_id, l.place, l.ref, r.record_id is not null as resolved, r.label, r.reviewer, r.review_source, r.acceptance, case when r.record_id is null then [] else {_UNEQUAL('l', 'r')} end as unequal from lk l left join {{to}} r on r.record_id = l.ref)"""
_FIRST_REVIEWS = "fr as (select * from rev qualify row_number() over (partition by record_id order by row_idx) = 1)"
_REJ_OF = {"revision_id": "revision_id", "card_id": "card_id", "chapter_id": "chapter_id", "style_contract_sha256": "style", "raw_output_sha256": "raw_sha"}


def _gate_sql() -> str:
    given = [(k, str(v)) for k, v in E.flat(SUMMARY)]
    fixed = [f"summary is missing required field: {k}" for k in E.SUMMARY_FIELDS if k not in SUMMARY] + [f"{k} must be greater than 0" for k in ("reviewed_outputs", "reviewed_output_chars", "accepted_revisions", "rejection_sampling_sft_rows", "preference_candidate_rows")]
    fixed += ["edit_burden is missing required field: median_changed_chars", f"boundary must equal {E.BOUNDARY}", "non-train rejection-sampling rows block the entry: 3"]
    counted = str(("reviewed_outputs", "revision_records", "accepted_revisions", "rejection_sampling_sft_rows", "preference_candidate_rows", *E.RECOMPUTED))
    rej = [("trim(r.input) = ''", "'rejection-sampling row missing required field: ' || r.revision_id || ' input'"), ("r.split is null", "'rejection-sampling row missing required field: ' || r.revision_id || ' source_split'"), ("trim(r.output) = ''", "'rejection-sampling row missing required field: ' || r.revision_id || ' output'"),
           ("r.split is distinct from 'train'", "'rejection-sampling row source_split must be train: ' || r.revision_id"), ("u.row_idx is null", "'rejection-sampling row not linked to accepted revision: ' || r.revision_id"),
           *[(f"u.row_idx is not null and r.{c} <> u.{c}", f"'rejection-sampling row mismatch accepted revision: ' || r.revision_id || ' {f}'") for f, c in _REJ_OF.items()], ("u.row_idx is not null and r.output <> u.revised_output", "'rejection-sampling row mismatch accepted revision: ' || r.revision_id || ' output'")]
    prf = [("trim(p.rejected) = ''", "'preference row missing required field: ' || p.id || ' rejected'"), ("len(p.labels) = 0", "'preference row requires non-empty defect_labels: ' || p.id"), ("p.source = 'elsewhere'", f"'preference row source must be {E.SOURCE}: ' || p.id"), ("u.row_idx is null", "'preference row not linked to accepted revision: ' || p.id"),
           *[(f"u.row_idx is not null and p.{a} <> u.{b}", f"'preference row mismatch accepted revision: ' || p.id || ' {f}'") for f, a, b in (("id", "id", "revision_id"), ("prompt_sha256", "prompt_sha256", "prompt_sha256"), ("card_id", "card_id", "card_id"), ("chapter_id", "chapter_id", "chapter_id"), ("style_contract_sha256", "style", "style"), ("chosen", "chosen", "revised_output"), ("rejected", "rejected", "model_output"), ("defect_record_ids", "refs", "refs"))],
           ("u.row_idx is not null and len(p.labels) > 0 and p.labels <> c.labels", "'preference row defect_labels do not match referenced review defects: ' || p.id"), ("u.row_idx is not null and len(c.labels) > 0 and p.reject_type <> array_to_string(c.labels, ',')", "'preference row reject_type does not match referenced review defects: ' || p.id")]
    return f"""with {RECORDS}, z as (select * from rv), {_SUMMARY}, {_LINKS.format(of="acc", to="ri")},
ct as (select row_idx, revision_id, list_sort(list_distinct(list_filter(list(label), lambda x: x is not null))) as labels, coalesce(bool_or((coalesce(review_source, '') in ('author', 'human', 'blind_review') or reviewer in ('author', 'human', 'blind_review')) and acceptance in {_ACCEPTED}), false) as human from lx group by row_idx, revision_id),
given as (select * from (values {", ".join(f"('{k}', '{v}')" for k, v in given)}) as g(field, value)),
fit as (select a.row_idx, a.revision_id, a.style, a.card_id, a.prompt_sha256, a.raw_sha, min(m.row_idx) filter (where m.style is null or m.style = a.style) as first_fit from acc a left join made m on m.card_id = a.card_id and m.prompt_sha256 = a.prompt_sha256 and m.raw_sha = a.raw_sha group by all)
select 'generation' as "check", row_idx, row_id as entity_id, 'generation record ' || unnest(bad) || ': ' || row_id as message from gx
union all select 'generation', row_idx, output_id, 'duplicate generation output id: ' || output_id from gv where row_idx > first_row
union all select 'revision', row_idx, revision_id, 'accepted revision missing generation link field: ' || revision_id || ' style_contract_sha256' from vx where status in {_ACCEPTED} and trim(style) = ''
union all select 'revision', row_idx, revision_id, 'revision record invalid: ' || revision_id || ' ' || error from vx where error is not null
union all select 'revision', row_idx, revision_id, 'duplicate accepted revision id: ' || revision_id from acc where nth > 1
union all select 'review', row_idx, record_id, 'review record invalid: ' || record_id || ' ' || error from rx where error is not null
union all select 'review', row_idx, record_id, 'duplicate review record id: ' || record_id from rv where nth > 1
union all select 'link', row_idx, revision_id, 'accepted revision referenced review missing: ' || revision_id || ' ' || ref from lx where ref is not null and not resolved
union all select 'link', row_idx, revision_id, 'accepted revision referenced review provenance mismatch: ' || revision_id || ' ' || ref || ' ' || f from (select *, unnest(unequal) as f from lx)
union all select 'evidence', row_idx, revision_id, 'accepted revision referenced reviews have no defect labels: ' || revision_id from ct where coalesce(len(labels), 0) = 0
union all select 'evidence', row_idx, revision_id, 'accepted revision lacks author, human, or blind-review evidence: ' || revision_id from ct where not human
union all select 'summary', null, null, unnest({fixed})
union all select 'summary', null, null, coalesce(g.field, o.field) || ' does not match the recomputed summary: summary=' || coalesce(g.value, 'None') || ' actual=' || coalesce(o.value, 'None') from given g full join own o using (field)
 where string_split(coalesce(g.field, o.field), '.')[1] in {counted} and not coalesce(try_cast(g.value as double) = try_cast(o.value as double), g.value is not distinct from o.value)
union all select 'rejection', row_idx, entity_id, unnest(found) from (select r.row_idx, r.revision_id as entity_id, {_pairs(rej)} as found from rej r left join uni u using (revision_id))
union all select 'preference', row_idx, entity_id, unnest(found) from (select p.row_idx, p.id as entity_id, {_pairs(prf)} as found from prf p left join uni u on u.revision_id = p.id left join ct c on c.row_idx = u.row_idx)
union all select 'generation link', row_idx, revision_id, 'accepted revision lacks a generation record of the same card, prompt and raw output: ' || revision_id from fit where first_fit is null
union all select 'generation link', f.row_idx, revision_id, 'generation record style_contract_sha256 mismatch accepted revision: ' || m.row_id || ' ' || revision_id from fit f join made m on m.card_id = f.card_id and m.prompt_sha256 = f.prompt_sha256 and m.raw_sha = f.raw_sha where m.style <> f.style and m.row_idx < coalesce(first_fit, m.row_idx + 1)"""


def _sampling_sql() -> str:
    from .formal_queries import _cards_sql

    return f"""with {_cards_sql(APPROVED, True)}, own as (select c.*, text, sha256(text) as sha, coalesce(quality, 1) = 1 as good, case when error is not null then 'card ' || card_id || ': ' || error when card_status = 'draft' then 'card ' || card_id || ': formal card status must be approved or frozen' end as fault from c join documents using (doc_id) left join labels using (doc_id)),
one as (select * from own qualify row_number() over (partition by card_id order by row_idx) = 1),
v as (select row_idx, doc_id as n, case when doc_id % 71 = 1 then 'card-none' else card_id end as card_id, case when doc_id % 71 = 2 then 'hx' else chapter_id end as chapter_id, case when doc_id % 71 = 5 or error is not null then sha256('x') else sha256(prompt) end as prompt_sha256, text, sha, good from own)
select v.row_idx, 'v' || n as revision_id, v.card_id, v.chapter_id, case when e is null then sha256(prompt) end as input_sha256, sha256(text || ' more') as output_sha256, coalesce(split, 'unknown') as source_split, e as error
from (select v.*, o.prompt, o.split, case when trim(v.text) = '' then 'model_output must be a non-empty string' when v.n % 71 = 6 then 'raw_output_sha256 mismatch' when not v.good then 'revision_status must be accepted for rejection sampling: v' || n when o.card_id is null then 'matching formal card is required for revision: ' || v.card_id when o.fault is not null then o.fault when v.chapter_id <> o.chapter_id then 'revision chapter_id mismatch'
 when n % 71 = 3 then 'revision style_contract_id mismatch' when n % 71 = 4 then 'revision style_contract_sha256 mismatch' when v.prompt_sha256 <> sha256(o.prompt) then 'revision prompt_sha256 mismatch' end as e from v left join one o on o.card_id = v.card_id) v"""


SQL = {
    "review_index_errors": f"""with {RECORDS} select 'index' as "check", row_idx, record_id as entity_id, 'defect label is not recognized: ugly' as message from rev where label = 'ugly'
union all select 'index', row_idx, record_id, 'duplicate review record id: ' || record_id from (select *, min(row_idx) over (partition by record_id) as first_row from rev) where row_idx > first_row""",
    "provenance_links": f"with {RECORDS}, {_FIRST_REVIEWS}, {_LINKS.format(of='vis', to='fr')} select row_idx, case when ref is null then null else place end as place, ref, resolved, '' as lacking, array_to_string(unequal, ',') as unequal from lx",
    "same_plot_preferences": f"""with {RECORDS}, {_FIRST_REVIEWS}, va as (select * from vx where status in {_ACCEPTED}), {_LINKS.format(of='va', to='fr')},
s as (select row_idx, list_sort(list_distinct(list_filter(list(label), lambda x: x is not null))) as labels, arg_min(case when ref is null then null when not resolved then 'defect record not found: ' || ref when len(unequal) > 0 then 'review record provenance mismatch: ' || ref || ' ' || unequal[1] end, case when ref is not null and (not resolved or len(unequal) > 0) then place end) as linked from lx group by row_idx)
select va.row_idx, revision_id as id, card_id, sha256(revised_output) as chosen, sha256(model_output) as rejected, array_to_string(refs, ',') as record_ids, array_to_string(coalesce(labels, []), ',') as reject_type, '{E.SOURCE}' as source, coalesce(error, linked, case when coalesce(len(labels), 0) = 0 then 'defect labels not found for revision: ' || revision_id end) as error from va join s using (row_idx)""",
    "rejection_sampling": _sampling_sql(),
    "entry_gate": _gate_sql(),
    "review_summary": f"with {RECORDS}, z as (select * from rv union all select * from rv where row_idx % 7 = 0), {_SUMMARY} select field, value from own",
}
QUERIES = {name: globals()[name] for name in SQL}
