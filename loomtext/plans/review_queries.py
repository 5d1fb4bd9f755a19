"""Similarity, sanitizing, chapters, votes, pairs, builders and gates over the driver's tables, in the Latin profile."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import rules as R, text as T
from ..operators import builders, chapters, gates, review, rows, sanitize, similar
from ..profile import LATIN as P
from .text_queries import COUNT_OF, LETTERS, SCORED, SPLIT, STRIP, _docs, grouped_split, hits, scored  # noqa: F401

K = P.leak_window
#: For leaks a run of counted characters may hold spaces: single words are shorter than the window.
SPACED = replace(P, counted=r"\p{L} ")


def near_duplicates(spark, d):
    classes = similar.near_duplicate_classes(rows.spread(_docs(spark, d)), "doc_id", "text", 0.82, 12, P)
    return similar.across(*classes, grouped_split(spark, d).select(F.col("doc_id").alias("id"), "split"))


def near_duplicate_links(spark, d):
    """All documents, every fourth of them set aside."""
    docs = rows.spread(_docs(spark, d)).withColumn("split", F.when(F.col("doc_id") % 4 == 3, "sealed").otherwise("train"))
    return similar.near_duplicate_links(docs, "doc_id", "text", "split", 0.82, 12, P).withColumnRenamed("id", "doc_id")


def leakage_vs_benchmark(spark, d):
    bench = spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", F.col("text").alias("item"))
    return similar.leakage(bench, "item_id", "item", rows.spread(_docs(spark, d)), "doc_id", "text", SPACED)


def sanitize_lines(spark, d):
    out = sanitize.sanitize(rows.spread(_docs(spark, d)), "doc_id", "text", P, None)
    return out.select(F.col("id").alias("doc_id"), F.sha2("sanitized", 256).alias("sha256"), F.array_join(F.transform("events", lambda e: F.concat(e["line_number"].cast("string"), F.lit(":"), e["reason"])), ",").alias("events"))


def length_cap(spark, d):
    return _docs(spark, d).select("doc_id", F.sha2(R.cap_counted(F.col("text"), 500, P), 256).alias("sha256"))


def _parts(spark, d):
    """Works of a source and language, a document a part. Every third document begins a chapter (French works have
    none); some end in a note, which runs on into the next document, some in its marker alone."""
    docs = _docs(spark, d, "doc_id", "source", "lang", "text")
    n = F.col("doc_id")
    head = F.when((n % 3 == 0) & (F.col("lang") != "fr"), F.concat(F.lit("Chapter "), n.cast("string"), F.lit("\n"))).otherwise("")
    tail = F.when(n % 7 == 2, "\nAuthor's note: thanks").when(n % 11 == 4, "\nAuthor's note").when(n % 5 == 1, "\n\n----\n").otherwise("")
    return docs.select(F.concat("source", F.lit("-"), "lang").alias("work"), "doc_id", F.concat(head, "text", tail).alias("text"))


def chapter_split(spark, d):
    out = chapters.split_chapters(_parts(spark, d), "work", "text", P, part="doc_id")
    return out.select("id", "chapter_title", F.col("char_count").cast("long").alias("char_count"), F.sha2("text", 256).alias("sha256"))


# Reviews: an event is a review of its user by its type.
WHO = {"click": "readthrough_structure", "view": "male_genre_payoff", "purchase": "platform_style_compliance"}


def _reviews(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", "value")
    who = F.create_map(*[F.lit(x) for pair in WHO.items() for x in pair])[F.col("event_type")]
    severity = F.when(F.col("value") >= 300, "blocker").when(F.col("value") < 20, "minor").otherwise("none")
    issue = F.when(F.col("value") < 20, F.array(F.lit("low_value"))).otherwise(F.array().cast("array<string>"))
    return e.select(F.col("event_id").alias("row_idx"), F.col("user_id").alias("id"), F.coalesce(who, "event_type").alias("reviewer"), (F.col("value") >= 50).alias("pass"), severity.alias("severity"), issue.alias("issues"))


def _votes(spark, d):
    all_ = _reviews(spark, d)
    return review.votes(all_.select("id").distinct(), all_)


def vote_aggregate(spark, d):
    n = lambda c: F.col(c).cast("long").alias(c)
    return _votes(spark, d).select("id", n("review_count"), n("pass_votes"), n("fail_votes"), n("blocker_votes"), F.array_join("issues", ",").alias("issues"), F.array_join("reviewers", ",").alias("reviewers"), "agent_gate_pass", "requires_human_arbitration")


def issue_counts(spark, d):
    return _votes(spark, d).select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def arbitration_decision(spark, d):
    all_ = _reviews(spark, d)
    ids = all_.select("id").distinct()
    return review.vote_decision(review.votes(ids, all_), review.malformed(all_, ids))


def malformed_reviews(spark, d):
    all_ = _reviews(spark, d)
    return review.malformed(all_, all_.select("id").distinct()).groupBy("error").agg(F.count("*").alias("n"))


def _sides(spark, d):
    """The shorter half of documents (even ids) against the others, matched by id // 2."""
    m = scored(spark, d).select((F.col("doc_id") / 2).cast("long").alias("id"), (F.col("doc_id") % 2).alias("side"), "hard_gate_pass", "failure_types")
    labels = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "candidate").otherwise("baseline").alias("winner"))
    return m.where("side = 0").drop("side"), m.where("side = 1").drop("side"), labels


def paired_eval(spark, d):
    return review.paired_summary(review.paired(*_sides(spark, d)))


def paired_regressions(spark, d):
    return review.paired(*_sides(spark, d)).where("regression").select("id", F.col("baseline_score").cast("long").alias("baseline_score"), F.col("candidate_score").cast("long").alias("candidate_score"), "winner", "winner_source")


def unpaired_ids(spark, d):
    a = _docs(spark, d).select(F.col("doc_id").alias("id"))
    b = spark.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("id"))
    return review.unpaired(a, b)


def preference_candidates(spark, d):
    m = scored(spark, d).select(F.col("doc_id").alias("id"), "failure_types")
    docs = _docs(spark, d).select(F.col("doc_id").alias("id"), F.col("text").alias("output"))
    cards = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("item_id").alias("id"), F.col("text").alias("prompt"))
    out = builders.preference_candidates(cards, docs, m)
    return out.select("id", F.sha2("prompt", 256).alias("prompt_sha256"), F.sha2("rejected", 256).alias("rejected_sha256"), "reject_type", "chosen", "source")


def _revisions(spark, d):
    """Documents as revisions of the document before; accepted where the label is good; each cites itself and the document before."""
    docs = _docs(spark, d)
    before = docs.select((F.col("doc_id") + 1).alias("doc_id"), F.col("text").alias("model_output"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    status = F.when(F.col("quality") == 1, "accepted").otherwise("rejected")
    return docs.join(before, "doc_id").join(labels, "doc_id").select(F.col("doc_id").alias("revision_id"), F.floor(F.col("doc_id") / 2).alias("card_id"), "model_output", F.col("text").alias("revised_output"), status.alias("revision_status"), F.array("doc_id", F.col("doc_id") - 1).alias("defect_record_ids"))


def same_plot_pairs(spark, d):
    m = scored(spark, d).select(F.col("doc_id").alias("record_id"), F.floor(F.col("doc_id") / 2).alias("card_id"), F.col("failure_types").alias("labels"))
    out = builders.same_plot_pairs(_revisions(spark, d), m)
    return out.select("revision_id", F.sha2("chosen", 256).alias("chosen"), F.sha2("rejected", 256).alias("rejected"), "reject_type", "unresolved")


def edit_burden(spark, d):
    delta = F.abs(T.counted_chars(F.col("model_output"), P) - T.counted_chars(F.col("revised_output"), P))
    return review.edit_burden(_revisions(spark, d), delta)


def sft_rows(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet")
    own = _docs(spark, d).join(labels, "doc_id", "left").join(grouped_split(spark, d).select("doc_id", "split"), "doc_id")
    own = own.select(F.col("doc_id").alias("id"), "text", "split", F.when(F.col("quality") == 1, "A").when(F.col("quality") == 0, "B").otherwise("U").alias("quality_tag"), F.col("doc_id").alias("row_idx"))
    cards = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("item_id").alias("id"), F.col("text").alias("prompt"))
    out = builders.sft_rows(cards, own, "write", SPACED)
    return out.select("id", "instruction", F.sha2("input", 256).alias("input_sha256"), F.sha2("output", 256).alias("output_sha256"), "leak")


def prompt_render(spark, d):
    bench = spark.read.parquet(f"{d}/benchmark.parquet")
    text = builders.prompt({"chapter_goal": F.col("text"), "must_include": T.texts(("the", "and")), "previous_summary": F.lit(None).cast("string")})
    return bench.select("item_id", F.sha2(text, 256).alias("prompt_sha256"))


def evidence_spans(spark, d):
    start = T.evidence_start(F.col("text"), F.lit("All rights reserved"))
    out = _docs(spark, d).select("doc_id", "text", start.alias("s")).where("s is not null").withColumn("e", F.col("s") + 19)
    return out.select("doc_id", F.col("s").cast("long").alias("evidence_start"), F.col("e").cast("long").alias("evidence_end"), T.evidence_holds(F.col("text"), F.lit("All rights reserved"), F.col("s"), F.col("e")).alias("holds"))


def defect_summary(spark, d):
    m = scored(spark, d).select(F.explode("failure_types").alias("label"), F.when(F.col("hard_gate_pass"), "minor").otherwise("major").alias("severity"))
    return review.defect_summary(m)


def missing_ids(spark, d):
    return rows.missing(_docs(spark, d), spark.read.parquet(f"{d}/labels.parquet"), "doc_id")


def duplicate_ids(spark, d):
    return rows.duplicates(spark.read.parquet(f"{d}/conversations.parquet"), "conv_id")


def quality_budget(spark, d):
    docs = _docs(spark, d).select(F.col("doc_id").alias("id"))
    m = scored(spark, d).withColumnRenamed("doc_id", "id")
    out = gates.quality_budget(docs, docs, m)
    return out.select([F.col(c).cast("long").alias(c) if t != "string" else F.col(c) for c, t in out.dtypes])


def error_classifier(spark, d):
    c = spark.read.parquet(f"{d}/conversations.parquet")
    log = F.concat_ws(" ", F.element_at(F.array(*[F.lit(x) for x in LOGS]), (F.col("conv_id") % len(LOGS) + 1).cast("int")), "text")
    kind = R.training_error(log, F.when(F.col("turn") == 0, 1).when(F.col("turn") == 1, 0))
    return c.select(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


LOGS = ("CUDA out of memory", "Permission denied: adapter", "permission denied", "process killed", "loading tokenizer", "unknown error", "JSONDecodeError", "fine")


def event_tail(spark, d):
    return rows.tail(spark.read.parquet(f"{d}/events.parquet").select("event_id", "event_type"), "event_id", 25)


def provenance_semi_join(spark, d):
    """Documents as revisions, documents of good quality as generations; toxic ones name no style."""
    docs = _docs(spark, d, "doc_id", "source", "lang", "text")
    good = spark.read.parquet(f"{d}/labels.parquet").where("quality = 1").select("doc_id", "toxic")
    sha = F.sha2("text", 256)
    r = docs.select("doc_id", F.col("lang").alias("card_id"), sha.alias("prompt_sha256"), sha.alias("raw_output_sha256"), F.col("source").alias("style_contract_sha256"))
    g = docs.join(good, "doc_id").select(F.col("lang").alias("card_id"), sha.alias("prompt_sha256"), sha.alias("raw_output_sha256"), F.when(F.col("toxic") == 0, F.col("source")).alias("style_contract_sha256"))
    return gates.generation_links(r, g).select("doc_id")


def reviewer_cross(spark, d):
    """Each benchmark item with each of the three reviewers: the fixed reviewers are an array, so nothing is joined."""
    return spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", F.explode(T.texts(review.REVIEWERS)).alias("reviewer"))


def issue_label_normalise(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", T.issue_label(F.col("url")).alias("label"))


def revision_violations(spark, d):
    r = _revisions(spark, d).select(F.col("revision_id").alias("row_idx"), "revision_id", "model_output", "revised_output", "revision_status", F.sha2("model_output", 256).alias("raw_output_sha256"), F.left(F.sha2("model_output", 256), F.when(F.col("revision_id") % 4 == 0, 60).otherwise(64)).alias("prompt_sha256"))
    rules = [*gates.required("model_output", "revised_output"), *gates.hashes("raw_output_sha256", "prompt_sha256"), gates.one_of("revision_status", review.ACCEPTED)]
    return gates.violations(r, "revision_id", rules).groupBy("message").agg(F.count("*").alias("n"))


def readiness(spark, d):
    """Documents as raw texts, split rows and SFT outputs, benchmark items as cards of equal id; dry run as in the log of conversation 0."""
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    bench = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("item_id").alias("doc_id"))
    split_rows = grouped_split(spark, d).select("doc_id", "split").join(labels, "doc_id", "left").join(bench.withColumn("carded", F.lit(True)), "doc_id", "left")
    trainable = (F.col("split") == "train") & (F.col("quality") == 1)
    n = split_rows.agg(
        F.count("*").alias("raw"), F.count("*").alias("split_rows"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") != "train").alias("eval_split"), F.count_if("carded").alias("cards"),
        F.count_if(F.col("carded") & ~F.coalesce(trainable, F.lit(False))).alias("card_issues"), F.count_if(F.col("carded") & trainable).alias("sft"), F.count_if(F.col("carded") & (F.col("split") != "train")).alias("eval_cards"), F.lit(1).alias("one"),
    )
    leaks = leakage_vs_benchmark(spark, d).where("item_id = doc_id").agg(F.count("*").alias("leaks"), F.lit(1).alias("one"))
    exit_code = spark.read.parquet(f"{d}/conversations.parquet").where("conv_id = 0").agg(F.coalesce(F.min("turn"), F.lit(1)).alias("dry_run_exit"), F.lit(1).alias("one"))
    return gates.readiness(n.join(leaks, "one").join(exit_code, "one").drop("one")).select("decision", F.array_join("blockers", ",").alias("blockers"), "raw", "train", "cards", "card_issues", "sft", "eval_cards", "leaks")


# ---- the same in SQL

WINDOWS = "flatten([[substr(r, i, {k}) for i in range(1, length(r) - {k} + 2)] for r in regexp_extract_all({text}, '[\\p{{L}} ]{{{k},}}')])"
REVIEWS = """
reviews as (select event_id as row_idx, user_id as id, case event_type when 'click' then 'readthrough_structure' when 'view' then 'male_genre_payoff' when 'purchase' then 'platform_style_compliance' else event_type end as reviewer,
  value >= 50 as pass, case when value >= 300 then 'blocker' when value < 20 then 'minor' else 'none' end as severity, case when value < 20 then 'low_value' end as issue from events),
firsts as (select * from reviews where event_type_ok qualify row_number() over (partition by id, reviewer order by row_idx) = 1),
votes as (select i.id, count(f.row_idx) as review_count, count(*) filter (where pass) as pass_votes, count(*) filter (where not pass) as fail_votes, count(*) filter (where severity = 'blocker') as blocker_votes,
  coalesce(string_agg(issue, ',' order by row_idx) filter (where issue is not null), '') as issues, coalesce(string_agg(reviewer, ',' order by reviewer), '') as reviewers, count(distinct reviewer) as n_reviewers
  from (select distinct id from reviews) i left join firsts f using (id) group by i.id)
""".replace("event_type_ok", "reviewer in ('readthrough_structure', 'male_genre_payoff', 'platform_style_compliance')")
PAIRED = f"""
with {SCORED}, sides as (select doc_id // 2 as id, doc_id % 2 as side, case when passed then 10 else 0 end - len(failures) as score from metrics),
p as (select a.id, a.score as b, b.score as c, l.quality from sides a join sides b on a.id = b.id and a.side = 0 and b.side = 1 left join labels l on l.doc_id = a.id),
q as (select id, b as baseline_score, c as candidate_score, case when quality = 1 then 'candidate' when quality is not null then 'baseline' when c > b then 'candidate' when c < b then 'baseline' else 'tie' end as winner, case when quality is not null then 'review' else 'metrics' end as winner_source, c < b as regression from p)
"""
REVISIONS = "r as (select a.doc_id, b.text as model_output, a.text as revised_output, l.quality = 1 as ok from documents a join documents b on b.doc_id = a.doc_id - 1 join labels l on l.doc_id = a.doc_id)"
COUNTED = r"length(regexp_replace({}, '[^\p{{L}}]', '', 'g'))"


def _first_mark(text, rules, other):
    return "case " + " ".join(f"when {' or '.join(f'contains(lower({text}), ' + chr(39) + m + chr(39) + ')' for m in marks)} then '{name}'" for name, marks in rules) + f" else {other} end"


SQL = {
    "near_duplicates": f"""with {SPLIT}, a as (select doc_id, {LETTERS} as own from documents), w as (select doc_id, list_distinct(case when own = '' then [] when length(own) <= 12 then [own] else [substr(own, i, 12) for i in range(1, length(own) - 10)] end) as g from a),
e as (select doc_id, len(g) as n, unnest(g) as x from w), o as (select l.doc_id as left_id, r.doc_id as right_id, l.n as ln, r.n as rn, count(*) as common from e l join e r on l.x = r.x and l.doc_id < r.doc_id and least(l.n, r.n) >= 0.8 * greatest(l.n, r.n) group by all)
select left_id, right_id, round(common / (ln + rn - common), 4) as overlap from o join s a on a.doc_id = left_id join s b on b.doc_id = right_id where a.split <> b.split and round(common / (ln + rn - common), 4) >= 0.82""",
    "near_duplicate_links": f"""with a as (select doc_id, {LETTERS} as own from documents), w as (select doc_id, doc_id % 4 = 3 as sealed, list_sort(list_distinct(case when length(own) <= 12 then [own] else [substr(own, i, 12) for i in range(1, length(own) - 10)] end)) as g from a where own <> ''),
k as (select min(doc_id) as class_id, g, count(*) as rows from w group by g), m as (select w.doc_id, w.sealed, k.class_id, rows from w join k on k.g = w.g),
e as (select class_id, len(g) as n, unnest(g) as x from k), o as (select l.class_id as a, r.class_id as b, l.n as ln, r.n as rn, count(*) as common from e l join e r on l.x = r.x and l.class_id < r.class_id and least(l.n, r.n) >= 0.8 * greatest(l.n, r.n) group by all),
p as (select a, b from o where round(common / (ln + rn - common), 4) >= 0.82), q as (select a, b from p union all select b, a from p union all select class_id, class_id from k),
t as (select q.a as class_id, count(*) as in_reach, count(*) filter (where m.sealed) as sealed_in_reach, count(distinct q.b) - 1 as n_links from q join m on m.class_id = q.b group by q.a)
select doc_id, class_id, rows - 1 as n_copies, n_links, case when sealed then in_reach - sealed_in_reach else sealed_in_reach end as n_across from m join t using (class_id)""",
    "leakage_vs_benchmark": f"""with h as (select item_id, unnest(list_distinct({WINDOWS.format(k=K, text='text')})) as w from benchmark), d as (select doc_id, {WINDOWS.format(k=K, text='text')} as g from documents),
e as (select doc_id, unnest(g) as w, generate_subscripts(g, 1) as pos from d) select item_id, doc_id, arg_min(w, pos) as fragment from h join e using (w) group by item_id, doc_id""",
    "sanitize_lines": f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as pos from documents),
k as (select doc_id, pos, {STRIP.format('raw')} as line from l),
c as (select *, case when line = '' then 'blank' when regexp_matches(line, '【[^】]{{1,80}}】') then 'outline_heading' when contains(line, '【') or contains(line, '】') then 'outline_bracket' when len({hits(P.directive_markers, 'line')}) > 0 then 'meta_directive'
 when regexp_matches(line, '^[-—_]{{3,}}$') then 'separator' when regexp_matches(line, '^(?:[-*]\\s+|\\d+[.、]\\s*)') then 'list_item' when length(line) <= 60 and not regexp_matches(line, '[.!?)]$') then 'short' else 'prose' end as kind from k),
o as (select *, coalesce(last_value(case when kind in ('outline_heading', 'outline_bracket', 'meta_directive') then true when kind in ('blank', 'separator', 'prose') then false end ignore nulls) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), false) as open, sum(cast(line = '' as int)) over (partition by doc_id order by pos) as blanks from c),
r as (select *, case when kind in ('outline_heading', 'outline_bracket', 'meta_directive', 'separator', 'list_item') then kind when kind = 'short' and open then 'meta_block_continuation' end as reason from o),
b as (select doc_id, pos, line, blanks - lag(blanks) over (partition by doc_id order by pos) as gap from r where reason is null and kind <> 'blank'),
t as (select doc_id, string_agg(case when gap is null then line when gap > 0 then chr(10) || chr(10) || line else chr(10) || line end, '' order by pos) as body from b group by doc_id),
v as (select doc_id, string_agg(pos || ':' || reason, ',' order by pos) as events from r where reason is not null group by doc_id)
select doc_id, sha256(coalesce(body, '')) as sha256, coalesce(events, '') as events from documents left join t using (doc_id) left join v using (doc_id)""",
    "length_cap": rf"""with a as (select doc_id, text, regexp_extract_all(text, '(?s)[^\p{{L}}]*\p{{L}}') as pieces from documents), b as (select *, array_to_string(list_slice(pieces, 1, 500), '') as head from a),
c as (select *, regexp_replace(head || regexp_extract(substr(text, length(head) + 1), '(?s)^[^\p{{L}}]*'), '\s+$', '') as cut from b), e as (select *, regexp_extract(cut, '(?s)^(.*[.!?])', 1) as sentence from c)
select doc_id, sha256({STRIP.format(f"case when len(pieces) <= 500 then text when sentence <> '' and {COUNTED.format('sentence')} >= {P.cap_floor} then sentence else cut end")}) as sha256 from e""",
    "chapter_split": f"""with d as (select source || '-' || lang as work, doc_id, case when doc_id % 3 = 0 and lang <> 'fr' then 'Chapter ' || doc_id || chr(10) else '' end || text || case when doc_id % 7 = 2 then chr(10) || 'Author''s note: thanks' when doc_id % 11 = 4 then chr(10) || 'Author''s note' when doc_id % 5 = 1 then chr(10) || chr(10) || '----' || chr(10) else '' end as text from documents),
l as (select work, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from d),
o as (select *, row_number() over (partition by work order by doc_id, pos) as i, case when regexp_matches(line, '^\\s*$') then 'B' when regexp_matches(line, '^[ \\t]*Chapter [0-9]+') then 'H' when regexp_matches(line, '^[ \\t]*Author''s note\\s*$') then 'M' when regexp_matches(line, '^[ \\t]*Author''s note') then 'N' else 'T' end as kind from l),
s as (select work, list_reduce(list_concat(['0'], list(kind order by i)), lambda a, c: a || case right(a, 1) when '0' then case c when 'N' then '1' when 'M' then '2' else '0' end when '1' then case when c in ('B', 'H') then '0' else '1' end else case c when 'B' then '2' else '1' end end) as states from o group by work),
k as (select work, i, substr(states, i, 1) as state, case when kind in ('M', 'N') or regexp_matches(line, '^\\s*[-=*_]{{3,}}\\s*$') then '' else line end as line, kind from o join s using (work) where substr(states, i, 1) = '0' or (substr(states, i, 1) = '1' and kind in ('B', 'H'))),
c as (select *, count(*) filter (where kind = 'H') over (partition by work order by i) as section from k),
t as (select work, section, max(case when kind = 'H' then {STRIP.format('line')} end) as title, {STRIP.format("regexp_replace(regexp_replace(coalesce(string_agg(line, chr(10) order by i) filter (where kind <> 'H'), ''), '[ \\t]+\\n', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")} as text from c group by work, section),
z as (select *, max(section) over (partition by work) as sections, max(case when section = 0 and text <> '' then 1 else 0 end) over (partition by work) as preface from t)
select work || '_chapter_' || lpad((case when section > 0 then section + preface else 1 end)::varchar, 4, '0') as id, case when section > 0 then title when sections = 0 then 'Untitled' else 'Preface' end as chapter_title, length({LETTERS}) as char_count, sha256(text) as sha256 from z where section > 0 or text <> '' or sections = 0""",
    "vote_aggregate": f"with {REVIEWS} select id, review_count, pass_votes, fail_votes, blocker_votes, issues, reviewers, n_reviewers = 3 and pass_votes >= 2 as agent_gate_pass, blocker_votes > 0 as requires_human_arbitration from votes",
    "issue_counts": f"with {REVIEWS} select issue, count(*) as n from firsts where issue is not null group by issue",
    "arbitration_decision": f"""with {REVIEWS}, x as (select count(*) as expected, count(*) filter (where n_reviewers < 3) as missing, count(*) filter (where n_reviewers = 3 and pass_votes < 2) as blocked, count(*) filter (where blocker_votes > 0) as arbitration, coalesce(bool_or(pass_votes = 2), false) as narrow from votes),
y as (select count(*) as malformed from reviews where reviewer not in ('readthrough_structure', 'male_genre_payoff', 'platform_style_compliance'))
select expected, missing, blocked, arbitration, malformed, case when malformed > 0 or missing > 0 then 'blocked_incomplete_agent_review' when arbitration > 0 then 'blocked_by_human_arbitration' when blocked > 0 then 'blocked_by_agent_review' when narrow then 'ready_for_human_spot_check' else 'ready_for_next_expansion' end as decision from x, y""",
    "malformed_reviews": f"with {REVIEWS} select 'unknown reviewer: ' || reviewer as error, count(*) as n from reviews where reviewer not in ('readthrough_structure', 'male_genre_payoff', 'platform_style_compliance') group by 1",
    "paired_eval": PAIRED + "select count(*) as paired_rows, count(*) filter (where winner = 'candidate') as wins, count(*) filter (where winner = 'baseline') as losses, count(*) filter (where winner = 'tie') as ties, count(*) filter (where regression) as regressions from q",
    "paired_regressions": PAIRED + "select id, baseline_score, candidate_score, winner, winner_source from q where regression",
    "unpaired_ids": "select doc_id as id, 'candidate' as missing_from from documents where doc_id not in (select doc_id from labels) union all select doc_id, 'baseline' from labels where doc_id not in (select doc_id from documents)",
    "preference_candidates": f"with {SCORED} select m.doc_id as id, sha256(coalesce(b.text, '__EMPTY__')) as prompt_sha256, sha256(d.text) as rejected_sha256, failures[1] as reject_type, '' as chosen, 'failed_eval' as source from metrics m join documents d using (doc_id) left join benchmark b on b.item_id = m.doc_id where len(failures) > 0",
    "same_plot_pairs": f"with {SCORED}, {REVISIONS}, f as (select r.doc_id, list_sort(list_distinct(list_concat(a.failures, b.failures))) as labels from r join metrics a on a.doc_id = r.doc_id join metrics b on b.doc_id = r.doc_id - 1) select r.doc_id as revision_id, sha256(revised_output) as chosen, sha256(model_output) as rejected, array_to_string(labels, ',') as reject_type, r.doc_id // 2 <> (r.doc_id - 1) // 2 as unresolved from r join f using (doc_id) where ok",
    "edit_burden": f"with {REVISIONS}, x as (select ok, abs({COUNTED.format('model_output')} - {COUNTED.format('revised_output')}) as d from r) select count(*) as revisions, count(*) filter (where ok) as accepted, coalesce(round(count(*) filter (where ok) / count(*), 4), 0.0) as acceptance_rate, cast(sum(d) as bigint) as changed_chars, coalesce(round(avg(d) filter (where ok), 4), 0.0) as mean_changed, coalesce(round(median(d) filter (where ok), 4), 0.0) as median_changed from x",
    "sft_rows": f"with {SPLIT}, c as (select b.item_id as id, b.text as prompt, d.text as output from benchmark b join documents d on d.doc_id = b.item_id join labels l on l.doc_id = d.doc_id join s on s.doc_id = d.doc_id where l.quality = 1 and s.split = 'train') select id, 'write' as instruction, sha256(prompt) as input_sha256, sha256(output) as output_sha256, list_filter({WINDOWS.format(k=K, text='output')}, lambda w: contains(prompt, w))[1] as leak from c",
    "prompt_render": "select item_id, sha256('【风格契约】' || chr(10) || '' || chr(10) || '【前情摘要】' || chr(10) || '【本章目标】' || chr(10) || text || chr(10) || '__TAIL__') as prompt_sha256 from benchmark",
    "evidence_spans": "select doc_id, instr(text, 'All rights reserved') - 1 as evidence_start, instr(text, 'All rights reserved') + 18 as evidence_end, true as holds from documents where contains(text, 'All rights reserved')",
    "defect_summary": f"with {SCORED}, x as (select unnest(failures) as label, case when passed then 'minor' else 'major' end as severity from metrics) select label, severity, count(*) as n from x group by grouping sets ((label), (severity), ())",
    "missing_ids": "select doc_id from documents where doc_id not in (select doc_id from labels)",
    "duplicate_ids": "select conv_id, count(*) as n from conversations group by conv_id having count(*) > 1",
    "quality_budget": f"with {SCORED}, x as (select count(*) as expected_rows, count(*) as generated_rows, 0 as missing_generated, 0 as duplicate_generated, 0 as missing_metrics, 0 as duplicate_metrics, count(*) as metrics_rows, count(*) filter (where passed) as hard_gate_pass, min(char_count) as min_chars, max(char_count) as max_chars, count(*) filter (where list_contains(failures, 'length_short')) as length_short, count(*) filter (where list_contains(failures, 'length_long')) as length_long, count(*) filter (where list_contains(failures, 'outline_leak')) as outline_leak from metrics) select *, case when length_short > 0 then 'blocked_length_short' when length_long > 0 then 'blocked_length_long' when outline_leak > 0 then 'blocked_outline_leak' when expected_rows > 0 and hard_gate_pass = expected_rows then 'ready_for_full_50_long_eval' else 'needs_quality_review' end as decision from x",
    "event_tail": "select event_id, event_type from events order by event_id desc limit 25",
    "provenance_semi_join": "select r.doc_id from documents r where not exists (select 1 from documents g join labels l using (doc_id) where l.quality = 1 and g.lang = r.lang and g.text = r.text and (l.toxic = 1 or g.source = r.source))",
    "reviewer_cross": "select item_id, unnest(['readthrough_structure', 'male_genre_payoff', 'platform_style_compliance']) as reviewer from benchmark",
    "issue_label_normalise": "select page_id, nullif(left(regexp_replace(regexp_replace(regexp_replace(lower(url), '[^a-z0-9_]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g'), 80), '') as label from pages",
    "revision_violations": f"with {REVISIONS} select 'prompt_sha256 must be a lowercase SHA-256' as message, count(*) as n from r where doc_id % 4 = 0 having count(*) > 0 union all select 'revision_status must be one of: accepted, accepted_with_minor_edits', count(*) from r where not ok having count(*) > 0 union all select 'model_output must be a non-empty string', count(*) from r where trim(model_output) = '' having count(*) > 0 union all select 'revised_output must be a non-empty string', count(*) from r where trim(revised_output) = '' having count(*) > 0",
    "readiness": f"""with {SPLIT}, h as (select item_id, unnest(list_distinct({WINDOWS.format(k=K, text='text')})) as w from benchmark), d as (select doc_id, {WINDOWS.format(k=K, text='text')} as g from documents where doc_id in (select item_id from benchmark)),
e as (select doc_id, unnest(g) as w from d), x as (select s.split, l.quality = 1 and s.split = 'train' as ok, b.item_id is not null as carded from s left join labels l using (doc_id) left join benchmark b on b.item_id = s.doc_id),
n as (select count(*) as raw, count(*) filter (where split = 'train') as train, count(*) filter (where split <> 'train') as eval_split, count(*) filter (where carded) as cards, count(*) filter (where carded and not coalesce(ok, false)) as card_issues,
 count(*) filter (where carded and ok) as sft, count(*) filter (where carded and split <> 'train') as eval_cards, (select count(distinct doc_id) from h join e using (w) where doc_id = item_id) as leaks, (select coalesce(min(turn), 1) from conversations where conv_id = 0) as code from x),
kk as (select *, list_filter([case when raw = 0 then 'blocked_missing_raw_text' end, case when raw = 0 or train = 0 or eval_split = 0 or (sft > 0 and sft < 20) then 'blocked_insufficient_chapters' end, case when cards = 0 or card_issues > 0 then 'blocked_missing_chapter_cards' end,
 case when leaks > 0 then 'blocked_source_leakage' end, case when sft = 0 then 'blocked_sft_empty' end, case when eval_cards < 10 then 'blocked_eval_missing' end, case when code <> 0 then 'blocked_stage2_dry_run_failed' end], lambda v: v is not null) as hit from n)
select coalesce(hit[1], 'ready_for_stage4_smoke_training') as decision, array_to_string(hit, ',') as blockers, raw, train, cards, card_issues, sft, eval_cards, leaks from kk""",
    "error_classifier": "with x as (select lower(concat_ws(' ', (" + str(list(LOGS)) + ")[conv_id % 8 + 1], text)) as log, case turn when 0 then 1 when 1 then 0 end as code from conversations) select case when code = 0 then 'none' when " + " when ".join(
        " or ".join(f"contains(log, '{m}')" for m in marks) + f" then '{kind}'"
        for kind, marks in (
            ("cuda_oom", ("cuda out of memory", "cublas_status_alloc_failed")), ("bnb_load_error", ("bitsandbytes", "4-bit", "4bit")), ("tokenizer_error", ("tokenizer", "autoconfig")), ("llamafactory_error", ("llamafactory", "unrecognized arguments", "invalid choice")),
            ("dataset_error", ("dataset", "filenotfounderror", "jsondecodeerror", "data_sft", "data/", "data\\", ".jsonl", "input/", "input\\")),
        )
    ) + " when contains(log, 'permission denied') and (contains(log, 'adapter') or contains(log, 'output_dir') or contains(log, 'save_pretrained')) then 'adapter_save_error' when contains(log, 'permission denied') and code <> 0 then 'process_killed' when contains(log, 'permission denied') then 'none' when contains(log, 'killed') or contains(log, 'terminated') then 'process_killed' when contains(log, 'device lost') or contains(log, 'cuda driver') or contains(log, 'unknown error') then 'driver_reset' when contains(log, 'adapter_model') or contains(log, 'save_pretrained') then 'adapter_save_error' when code <> 0 then 'process_killed' else 'none' end as kind, count(*) as n from x group by kind",
}


def _literals() -> None:
    """Put the rendered parts of prompts that are the same for every row into the SQL."""
    tail = "\n".join([
        "【冲突推进】", "", "【爽点兑现】", "", "【章节结构】\n- 无", "【人物状态】\n- 无", "【必须出现】\n- the\n- and", "【禁止事项】\n- 无", "【章末钩子】", "", "【目标字数】", "2000-2500中文汉字", "【输出要求】", builders.ORDER,
    ])
    empty = "\n".join([
        "【风格契约】", "", "【前情摘要】", "", "【本章目标】", "", "【冲突推进】", "", "【爽点兑现】", "", "【章节结构】\n- 无", "【人物状态】\n- 无", "【必须出现】\n- 无", "【禁止事项】\n- 无", "【章末钩子】", "", "【目标字数】", "2000-2500中文汉字", "【输出要求】", builders.ORDER,
    ])
    SQL["prompt_render"] = SQL["prompt_render"].replace("__TAIL__", tail)
    SQL["preference_candidates"] = SQL["preference_candidates"].replace("__EMPTY__", empty)


_literals()
QUERIES = {name: globals()[name] for name in SQL}
