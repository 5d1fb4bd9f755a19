"""Text metrics and scoring rules over documents, in the Latin profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rules as R, text as T
from ..operators import rows, split
from ..profile import LATIN as P

#: Words that the cards ask for and forbid.
MUST, MUST_NOT, HOOK = ("the",), ("stupid", "scum"), "of the"


def _docs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select(*(columns or ("doc_id", "text")))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Documents as outputs, all with the same card."""
    return R.scored(rows.spread(_docs(spark, d, "doc_id", "lang", "source", "text")), ["doc_id", "lang", "source"], "text", T.texts(MUST), T.texts(MUST_NOT), F.lit(""), F.lit(HOOK), P)


def char_counts(spark, d):
    return _docs(spark, d).select("doc_id", T.counted_chars(F.col("text"), P).cast("long").alias("n_chars_counted"))


def normalized_paragraphs(spark, d):
    lengths = T.paragraph_lengths(F.col("text"), P)
    return _docs(spark, d).select("doc_id", F.size(lengths).cast("long").alias("n_paragraphs"), F.array_join(F.transform(lengths, lambda x: x.cast("string")), ",").alias("lengths"), F.sha2(T.normalize_newlines(F.col("text")), 256).alias("normal_sha256"))


def dialogue_ratio(spark, d):
    return _docs(spark, d).select("doc_id", F.round(T.dialogue_ratio(F.col("text"), P), 6).alias("ratio"))


def ngram_repetition(spark, d):
    return rows.spread(_docs(spark, d)).select("doc_id", F.round(T.repeated_ngram_ratio(F.col("text"), 4, P), 6).alias("ratio"))


def sentence_stats(spark, d):
    n = T.sentence_lengths(F.col("text"), P)
    return _docs(spark, d).select("doc_id", F.size(n).cast("long").alias("n_sentences"), F.coalesce(F.array_max(n), F.lit(0)).cast("long").alias("longest"), F.aggregate(n, F.lit(0), lambda a, x: a + x).cast("long").alias("total"))


def phrase_hits(spark, d):
    docs = _docs(spark, d)
    counts = docs.agg(F.sum(T.counted_chars(F.col("text"), P)).alias("chars"), *[F.sum(T.count_of(F.col("text"), x)).alias(f"c{i}") for i, x in enumerate(P.trace_phrases)])
    each = counts.select("chars", F.explode(F.array(*[F.struct(F.lit(x).alias("phrase"), F.col(f"c{i}").alias("hits")) for i, x in enumerate(P.trace_phrases)])).alias("x"))
    return each.select("x.phrase", "x.hits", F.round(F.col("x.hits") * 10000 / F.col("chars"), 4).alias("per_10k"))


def punctuation_density(spark, d):
    docs = _docs(spark, d, "lang", "text")
    sums = docs.groupBy("lang").agg(F.sum(T.counted_chars(F.col("text"), P)).alias("chars"), *[F.sum(T.count_of(F.col("text"), x)).alias(f"c{i}") for i, x in enumerate(P.punctuation)])
    each = sums.select("lang", "chars", F.explode(F.array(*[F.struct(F.lit(x).alias("mark"), F.col(f"c{i}").alias("hits")) for i, x in enumerate(P.punctuation)])).alias("x"))
    return each.select("lang", "x.mark", F.round(F.coalesce(F.try_divide("x.hits", "chars"), F.lit(0.0)), 6).alias("density"))


def style_distribution(spark, d):
    docs = rows.spread(_docs(spark, d, "lang", "text")).select("lang", T.counted_chars(F.col("text"), P).alias("n"), T.dialogue_ratio(F.col("text"), P).alias("talk"))
    of = lambda c: [F.round(F.min(c), 4).cast("double").alias(f"{c}_min"), F.round(F.max(c), 4).cast("double").alias(f"{c}_max"), F.round(F.avg(c), 4).alias(f"{c}_avg"), F.round(F.expr(f"percentile({c}, 0.5)"), 4).alias(f"{c}_p50"), F.round(F.expr(f"percentile({c}, 0.9)"), 4).alias(f"{c}_p90")]
    return docs.groupBy("lang").agg(*of("n"), *of("talk"))


def clean_length_filter(spark, d):
    return _docs(spark, d, "doc_id", "n_chars").where(F.col("n_chars").between(500, 5000))


def exact_dedup_first(spark, d):
    return rows.clean(_docs(spark, d, "doc_id", "text", "n_chars"), "text", "n_chars", "doc_id", 0, 1 << 60).select("doc_id")


def grouped_split(spark, d):
    docs = _docs(spark, d).withColumn("none", F.lit(None).cast("string"))
    return split.grouped_split(docs, "none", "text", 40, 40).select("doc_id", "split", "group_id")


def split_counts(spark, d):
    docs = _docs(spark, d, "doc_id", "source", "text").withColumn("none", F.lit(None).cast("string"))
    return split.grouped_split(docs, "none", "text", 40, 40).groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("group_id").alias("groups"))


def text_hashes(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2("text", 256).alias("sha256"), F.left(F.sha1("text"), F.lit(8)).alias("sha1_8"))


def score_outputs(spark, d):
    return scored(spark, d).select(
        "doc_id", F.col("char_count").cast("long").alias("char_count"), "must_include_coverage", F.array_join("forbidden_hits", ",").alias("forbidden"), F.array_join("ai_trace_matches", ",").alias("trace"),
        "repeated_ngram_ratio", F.array_join("failure_types", ",").alias("failures"), "hard_gate_pass",
    )


def gate_summary_by_lang(spark, d):
    return scored(spark, d).groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(F.col("hard_gate_pass").cast("int")), 4).alias("pass_rate"), F.round(F.avg("char_count"), 2).alias("avg_chars"))


def failure_histogram(spark, d):
    return scored(spark, d).select(F.explode("failure_types").alias("failure")).groupBy("failure").agg(F.count("*").alias("n"))


def worst_samples(spark, d):
    return rows.worst(scored(spark, d), "doc_id").select("doc_id", "hard_gate_pass", F.col("char_count").cast("long").alias("char_count"))


def preference_top20(spark, d):
    return rows.preference_top(scored(spark, d), "doc_id").select("doc_id", F.size("failure_types").cast("long").alias("n_failures"))


def quality_subset(spark, d):
    metrics = scored(spark, d)
    return rows.quality_subset(metrics.select("doc_id"), metrics, "doc_id", "doc_id", 25).select("doc_id", F.col("priority").cast("long").alias("priority"))


def semantic_repetition(spark, d):
    found = T.repeated_runs(F.col("text"), P)
    return rows.spread(_docs(spark, d)).select("doc_id", F.size(found).cast("long").alias("n_repeated"), F.array_join(F.array_sort(found), ",").alias("repeated"))


def term_coverage(spark, d):
    return _docs(spark, d).select("doc_id", F.round(T.term_coverage(F.lit("the anan thtion, der und les"), F.col("text"), P), 6).alias("coverage"))


# ---- the same in SQL

LETTERS = r"regexp_replace(text, '[^\p{L}]', '', 'g')"
N_LETTERS = f"length({LETTERS})"
STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
NORMAL = STRIP.format(r"regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g')")
PARAGRAPHS = f"list_filter(list_transform(string_split({NORMAL}, chr(10)), lambda x: {STRIP.format('x')}), lambda x: x <> '')"
TALKS = "contains(x, '\"') or starts_with(x, '-')"
GRAMS = "[substr(own, i, {n}) for i in range(1, greatest(1, length(own) - {n} + 2))]"
COUNT_OF = "((length(text) - length(replace(text, '{0}', ''))) // {1})"


def hits(phrases, text="text"):
    return "list_filter([" + ", ".join(f"'{x}'" for x in phrases) + f"], lambda x: contains({text}, x))"


SCORED = rf"""
scored as (
  with a as (select doc_id, lang, source, text, {LETTERS} as own, {STRIP.format('text')} as stripped from documents),
  b as (select *, length(own) as char_count, {GRAMS.format(n=4)} as grams,
        flatten([case when length(r) < 8 then [r] else list_concat([substr(r, i, 8) for i in range(1, length(r) - 6)], [right(r, 7)]) end for r in regexp_extract_all(text, '\p{{L}}{{5,}}')]) as eights from a),
  c as (select *, case when length(own) < 4 then 0.0 else (len(grams) - len(list_distinct(grams))) / len(grams) end as rep,
        len(list_filter(map_values(cast(histogram as map(varchar, ubigint))), lambda n: n >= 3)) > 0 as again,
        {hits(MUST)} as have, {hits(MUST_NOT)} as bad, {hits(P.trace_phrases)} as trace from (select *, list_aggregate(eights, 'histogram') as histogram from b)),
  e as (select *, len(have) / {len(MUST)} as covered, right(text, 200) as tail from c)
  select doc_id, lang, source, char_count, covered, bad, trace, rep, list_filter([
    case when char_count < {P.shortest} then 'length_short' end, case when char_count > {P.longest} then 'length_long' end,
    case when len({hits(P.outline_markers)}) > 0 then 'outline_leak' end, case when covered < 1 then 'must_include_missing' end,
    case when len(bad) > 0 then 'forbidden_violation' end, case when rep > {P.repetition} then 'repetition' end, case when len(trace) > 0 then 'ai_trace' end,
    case when len({hits(P.disclaimer_markers)}) > 0 then 'disclaimer_residue' end,
    case when {' or '.join(COUNT_OF.format(x, len(x)) + ' >= 2' for x in P.generic_phrases)} then 'generic_ai_phrase' end,
    case when regexp_matches(text, '(^|\n)\s*(>|#{{1,6}}\s+|[-*]\s+|\d+[.、]\s+)') then 'markdown_residue' end,
    case when len({hits(P.meta_markers)}) > 0 then 'meta_evaluation_residue' end,
    case when char_count >= {P.padded} and again then 'padding_to_length' end, case when again then 'semantic_repetition' end,
    case when stripped <> '' and not regexp_matches(stripped, '[.!?)]$') then 'unnatural_ending' end,
    case when len({hits(('of', 'the'), 'tail')}) / 2 < {P.coverage} then 'weak_ending_hook' end], lambda x: x is not null) as failures
  from e),
metrics as (select *, len(list_filter(failures, lambda x: x not in ('ai_trace', 'generic_ai_phrase'))) = 0 as passed from scored)
"""

SPLIT = """
g as (select doc_id, sha256(text) as own from documents),
k as (select 'text:' || own as key, sha256('20260625' || chr(10) || 'text:' || own || chr(10) || string_agg(own, chr(10))) as sha, own from g group by own),
r as (select *, row_number() over (order by sha, key) as place from k),
s as (select g.doc_id, case when place <= 40 then 'validation' when place <= 80 then 'sealed' else 'train' end as split, 'group-' || left(sha, 16) as group_id from g join r using (own))
"""

SQL = {
    "char_counts": f"select doc_id, {N_LETTERS} as n_chars_counted from documents",
    "normalized_paragraphs": rf"select doc_id, len(p) as n_paragraphs, array_to_string([cast(length(regexp_replace(x, '[^\p{{L}}]', '', 'g')) as varchar) for x in p], ',') as lengths, sha256(normal) as normal_sha256 from (select doc_id, {PARAGRAPHS} as p, {NORMAL} as normal from documents)",
    "dialogue_ratio": f"select doc_id, round(case when len(p) = 0 then 0.0 else len(list_filter(p, lambda x: {TALKS})) / len(p) end, 6) as ratio from (select doc_id, {PARAGRAPHS} as p from documents)",
    "ngram_repetition": f"select doc_id, round(case when length(own) < 4 then 0.0 else (len(g) - len(list_distinct(g))) / len(g) end, 6) as ratio from (select doc_id, own, {GRAMS.format(n=4)} as g from (select doc_id, {LETTERS} as own from documents))",
    "sentence_stats": r"select doc_id, len(n) as n_sentences, coalesce(list_max(n), 0) as longest, coalesce(cast(list_sum(n) as bigint), 0) as total from (select doc_id, list_filter([length(regexp_replace(s, '[^\p{L}]', '', 'g')) for s in regexp_extract_all(replace(text, chr(10), ''), '[^.!?]+[.!?]?')], lambda x: x > 0) as n from documents)",
    "phrase_hits": " union all ".join(f"select '{x}' as phrase, cast(sum({COUNT_OF.format(x, len(x))}) as bigint) as hits, round(sum({COUNT_OF.format(x, len(x))}) * 10000 / sum({N_LETTERS}), 4) as per_10k from documents" for x in P.trace_phrases),
    "punctuation_density": " union all ".join(f"select lang, '{x}' as mark, round(coalesce(sum({COUNT_OF.format(x, 1)}) / nullif(sum({N_LETTERS}), 0), 0.0), 6) as density from documents group by lang" for x in P.punctuation),
    "style_distribution": "select lang, " + ", ".join(f"round({f}, 4) as {c}_{n}" for c in ("n", "talk") for n, f in (("min", f"cast(min({c}) as double)"), ("max", f"cast(max({c}) as double)"), ("avg", f"avg({c})"), ("p50", f"quantile_cont({c}, 0.5)"), ("p90", f"quantile_cont({c}, 0.9)")))
    + f" from (select lang, n, case when len(p) = 0 then 0.0 else len(list_filter(p, lambda x: {TALKS})) / len(p) end as talk from (select lang, {N_LETTERS} as n, {PARAGRAPHS} as p from documents)) group by lang",
    "clean_length_filter": "select doc_id, n_chars from documents where n_chars between 500 and 5000",
    "exact_dedup_first": "select min(doc_id) as doc_id from documents group by text",
    "grouped_split": f"with {SPLIT} select * from s",
    "split_counts": f"with {SPLIT} select split, count(*) as n, count(distinct group_id) as groups from s group by split",
    "text_hashes": "select doc_id, sha256(text) as sha256, left(sha1(text), 8) as sha1_8 from documents",
    "score_outputs": f"with {SCORED} select doc_id, char_count, round(covered, 4) as must_include_coverage, array_to_string(bad, ',') as forbidden, array_to_string(trace, ',') as trace, round(rep, 4) as repeated_ngram_ratio, array_to_string(failures, ',') as failures, passed as hard_gate_pass from metrics",
    "gate_summary_by_lang": f"with {SCORED} select lang, count(*) as n, round(avg(cast(passed as int)), 4) as pass_rate, round(avg(char_count), 2) as avg_chars from metrics group by lang",
    "failure_histogram": f"with {SCORED} select failure, count(*) as n from (select unnest(failures) as failure from metrics) group by failure",
    "worst_samples": f"with {SCORED} select doc_id, passed as hard_gate_pass, char_count from metrics order by passed, char_count, doc_id limit 10",
    "preference_top20": f"with {SCORED} select doc_id, len(failures) as n_failures from metrics where len(failures) > 0 order by passed, len(failures) desc, doc_id limit 20",
    "quality_subset": f"with {SCORED} select doc_id, cast(case when list_contains(failures, 'outline_leak') then 0 when len(failures) > 0 then 1 else 2 end as bigint) as priority from metrics order by priority, doc_id limit 25",
    "semantic_repetition": r"select doc_id, len(r) as n_repeated, array_to_string(list_sort(r), ',') as repeated from (select doc_id, list_filter(map_keys(h), lambda k: h[k] >= 3) as r from (select doc_id, coalesce(list_aggregate(flatten([case when length(r) < 8 then [r] else list_concat([substr(r, i, 8) for i in range(1, length(r) - 6)], [right(r, 7)]) end for r in regexp_extract_all(text, '\p{L}{5,}')]), 'histogram'), map()) as h from documents))",
    "term_coverage": "select doc_id, round(len(list_filter(t, lambda x: contains(text, x))) / len(t), 6) as coverage from documents, (select list_distinct(list_concat(['the', 'anan', 'der', 'und', 'les'], list_concat([substr('thtion', i, 2) for i in range(1, 6)], list_concat([substr('thtion', i, 3) for i in range(1, 5)], [substr('thtion', i, 4) for i in range(1, 4)])))) as t)",
}

QUERIES = {name: globals()[name] for name in SQL}
