"""The queries of this package and, where SQL can state them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .op1_substring_dedup import op1_substring_dedup
from .op5_quality_rules import op5_quality_rules
from .op6_suffix_array import op6_suffix_array
from .op9_line_dedup import op9_line_dedup
from .op8_ngram_join import op8_ngram_join
from .op7_mixing import op7_mixing
from .op4_decontamination import op4_decontamination
from .op10_url_filter import op10_url_filter
from .op2_suffix_tree import op2_suffix_tree
from .op3_language_crf import op3_language_crf
from .op11_resampling import op11_resampling
from .op12_clustering import op12_clustering
from .op13_simhash import op13_simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_array": op6_suffix_array,
    "op9_line_dedup": op9_line_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op7_mixing": op7_mixing,
    "op4_decontamination": op4_decontamination,
    "op10_url_filter": op10_url_filter,
    "op2_suffix_tree": op2_suffix_tree,
    "op3_language_crf": op3_language_crf,
    "op11_resampling": op11_resampling,
    "op12_clustering": op12_clustering,
    "op13_simhash": op13_simhash,
}


# The columns of op2, op5, op7 and op10 that do not depend on a model, as queries of their own: SQL can state these.


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_suffix_tree(spark, sf_dir).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 4).alias("target"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("rule_verdict"))


QUERIES |= {"lm_base_scores": lm_base_scores, "quality_counts": quality_counts, "mix_targets": mix_targets, "url_rules": url_rules}

WORD = r"[^\x20\x09-\x0D]+"
#: zlib's CRC-32 of doc_id as text, bit by bit.
CRC = """xor(list_reduce(list_concat([4294967295::ubigint], [ascii(x)::ubigint for x in string_split(doc_id::varchar, '')]),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::ubigint for i in range(8)]), lambda x, z: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint)"""
SQL: dict[str, str] = {
    "op1_substring_dedup": rf"""with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents),
w as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos, len(words) as n, words from d),
win as (select doc_id, pos, sha256(array_to_string(list_slice(words, pos, pos + 49), ' ')) as h from w where pos + 49 <= n),
hit as (select doc_id, pos, min(doc_id) over (partition by h) < doc_id as again from win),
mark as (select w.doc_id, w.pos, w.word, max(case when again then w.pos end) over (partition by w.doc_id order by w.pos rows between 49 preceding and current row) is not null as gone from w left join hit on hit.doc_id = w.doc_id and hit.pos = w.pos),
k as (select doc_id, count(*) filter (where gone) as n_removed, string_agg(word, ' ' order by pos) filter (where not gone) as kept from mark group by doc_id)
select d.doc_id, len(words) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)""",
    "op6_suffix_array": r"""with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
b as (select doc_id, unnest(regexp_extract_all(h, '..')) as byte, generate_subscripts(regexp_extract_all(h, '..'), 1) as pos, length(h) // 2 as n from d),
win as (select doc_id, pos, case when pos + 49 <= n then string_agg(byte, '') over (partition by doc_id order by pos rows between current row and 49 following) end as s, byte from b),
hit as (select doc_id, pos, byte, s is not null and min(doc_id) over (partition by s) < doc_id as again from win),
mark as (select doc_id, pos, byte, max(case when again then pos end) over (partition by doc_id order by pos rows between 49 preceding and current row) is not null as gone from hit),
run as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by pos), false) as opens from mark),
k as (select doc_id, count(*) as n_bytes, count(*) filter (where gone) as n_removed, count(*) filter (where opens) as n_spans, string_agg(byte, '' order by pos) filter (where not gone) as kept from run group by doc_id)
select d.doc_id, coalesce(n_bytes, 0) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256 from d left join k using (doc_id)""",
    "lm_base_scores": rf"""with d as (select doc_id, {CRC} % 5 = 1 as held_out, list_concat(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), [null::varchar]) as tokens from documents),
t as (select doc_id, held_out, coalesce(word, '') as token from (select doc_id, held_out, unnest(tokens) as word from d)),
c as (select token, count(*) as c from t where not held_out group by token), s as (select coalesce(sum(c), 0)::bigint as n, count(*) as v from c)
select t.doc_id, held_out, count(*) as n_tokens, count(c) as n_known, any_value(n) as train_tokens, round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 4) as base_score from t left join c using (token), s group by t.doc_id, held_out""",
    "quality_counts": rf"""with d as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents),
w as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos, len(words) as n, words from d),
win as (select doc_id, pos, array_to_string(list_slice(words, pos, pos + 7), ' ') as g from w where pos + 7 <= n),
hit as (select doc_id, pos from (select *, count(*) over (partition by doc_id, g) as times from win) where times > 1),
mark as (select w.doc_id, w.pos, max(hit.pos) over (partition by w.doc_id order by w.pos rows between 7 preceding and current row) is not null as again from w left join hit on hit.doc_id = w.doc_id and hit.pos = w.pos),
r as (select doc_id, count(*) filter (where again) as n_repeat_words from mark group by doc_id),
l as (select doc_id, unnest(string_split(text, chr(10))) as line from d), u as (select doc_id, count(*) - count(distinct line) as n_dup_lines from l where regexp_matches(line, '{WORD}') group by doc_id)
select d.doc_id, len(words) as n_words, coalesce(list_sum([length(x) for x in words]), 0)::bigint as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
coalesce(n_repeat_words, 0) as n_repeat_words, len(words) < 20 or 100 * coalesce(n_repeat_words, 0) > 30 * len(words) as base_failed from d left join r using (doc_id) left join u using (doc_id)""",
    "mix_targets": rf"""with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size from documents),
s as (select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from d group by source),
o as (select *, 3 * source_size / weight as full_at, sum(source_size) over () as total, sum(3 * source_size) over w - 3 * source_size as above, sum(weight) over () - sum(weight) over w + weight as open from s window w as (order by 3 * source_size / weight, source nulls last rows unbounded preceding)),
level as (select min_by((total - above) / open, full_at) as height from o where full_at >= (total - above) / open)
select doc_id, size, source_size, round(least(3 * source_size, weight * height), 4) as target from d join s on d.source is not distinct from s.source, level""",
    "url_rules": r"""with p as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') as path from p),
r as (select * from (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) as r(verdict, h, p)),
m as (select page_id, arg_max(r.h || r.p, length(r.h || r.p)) as rule, arg_max(verdict, length(r.h || r.p)) as rule_verdict from h join r on (host = r.h or ends_with(host, '.' || r.h)) and starts_with(path, r.p) group by page_id)
select h.page_id, host, path, rule, rule_verdict from h left join m using (page_id)""",
}

RUNS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


SQL["op11_resampling"] = f"""with d as (select doc_id as id, false as target, regexp_extract_all({_lower("text")}, '{RUNS}') as words from documents union all select item_id, true, regexp_extract_all({_lower("text")}, '{RUNS}') from benchmark),
w as (select id, target, unnest(words) as a, generate_subscripts(words, 1) as pos from d),
l as (select *, lead(a) over p as b, lead(a, 2) over p as c from w window p as (partition by target, id order by pos)),
f as (select target, id, a as gram from l union all select target, id, a || ' ' || b from l where b is not null union all select target, id, a || ' ' || b || ' ' || c from l where c is not null),
per as (select target, id, gram, count(*) as n from f group by all),
crc as (select list(v order by i) as t from (select i, list_reduce(list_concat([i::ubigint], [0::ubigint for z in range(8)]), lambda x, z: xor(x >> 1, 3988292384::ubigint * (x & 1))) as v from (select unnest(range(256)) as i))),
g as (select gram, xor(list_reduce(list_concat([4294967295::ubigint], [('0x' || x)::ubigint for x in regexp_extract_all(hex(encode(gram)), '..')]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::int + 1])), 4294967295::ubigint) % 10000 as bucket from (select distinct gram from per), crc),
b as (select bucket, coalesce(sum(n) filter (where not target), 0)::double as s, coalesce(sum(n) filter (where target), 0)::double as t from per join g using (gram) group by bucket),
gain as (select bucket, floor(1000 * ln((t + 1) * (sum(s) over () + 10000) / ((s + 1) * (sum(t) over () + 10000))))::bigint as gain from b),
m as (select id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight from per join g using (gram) join gain using (bucket) where not target group by id),
k as (select d.id as doc_id, len(words) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || d.id::varchar)[1:8])::ubigint + 0.5) / 4294967296)))::bigint as score from d left join m using (id) where not target),
r as (select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as able from k where n_words >= 20)
select k.doc_id, n_features, weight, score, case when rank <= 5 * able // 100 then rank end as rank from k left join r using (doc_id)"""


def _lloyd_sql(rounds: int = 3) -> str:
    nearest = "select v.vec_id, arg_min(k, (d, k)) as k, min(d) as d from (select v.vec_id, c.k, list_sum([power(list_extract(v.x, i) - list_extract(c.c, i), 2) for i in range(1, 65)]) as d from v, c{n} c) v group by v.vec_id"
    steps = ["""v as (select vec_id, [floor(64 * y::double) for y in embedding] as x from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda y: y is not null and isfinite(y))) = 64)""",
             "c0 as (select row_number() over (order by sha256('1:' || vec_id::varchar)) - 1 as k, x as c from v order by sha256('1:' || vec_id::varchar) limit 16)"]
    for n in range(rounds):
        steps.append(f"a{n} as ({nearest.format(n=n)})")
        steps.append(f"m{n} as (select k, list(y order by i) as c from (select k, i, floor(sum(x[i]) / count(*)) as y from (select k, x, unnest(range(1, 65)) as i from a{n} join v using (vec_id)) group by k, i) group by k)")
        steps.append(f"c{n + 1} as (select c.k, coalesce(m.c, c.c) as c from c{n} c left join m{n} m using (k))")
    steps.append(f"z as ({nearest.format(n=rounds)})")
    return f"""with {", ".join(steps)}
select vec_id, k::int as cluster, d::bigint as distance, (sum(d) over (partition by k))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia, sha256(array_to_string([y::bigint for y in c], ',')) as centroid_sha256 from z join c{rounds} using (k)"""


SQL["op12_clustering"] = _lloyd_sql()


def _xxh64_sql(seed: int = 42) -> str:
    """XXH64 of b (a list of bytes), in 128-bit integers. The five primes are fixed values of the hash."""
    p1, p2, p3, p4, p5 = (f"{v}::uhugeint" for v in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
    cut = lambda x: f"(({x}) & 18446744073709551615::uhugeint)"
    turn = lambda x, r: f"({cut(f'({x}) * {1 << r}::uhugeint')} + (({x}) >> {64 - r}))"
    mul = lambda x, y: cut(f"({x}) * {y}")
    word = lambda at, n: "(" + " + ".join(f"b[{at} + {j + 1}] * {1 << 8 * j}::uhugeint" for j in range(n)) + ")"
    fold = lambda start, items, step: f"list_reduce(list_concat([{start}], {items}), lambda h, k: {step})"
    lane = lambda start, i: fold(start, f"[{word(f'32 * s + {8 * i}', 8)} for s in range(n // 32)]", mul(turn_once(cut(f"h + {mul('k', p2)}"), 31), p1))
    turn_once = lambda x, r: f"list_extract([{turn('y', r)} for y in [{x}]], 1)"
    rounds = lambda v: mul(turn_once(mul(v, p2), 31), p1)
    starts = [cut(f"{seed}::uhugeint + {p1} + {p2}"), cut(f"{seed}::uhugeint + {p2}"), f"{seed}::uhugeint", cut(f"{seed}::uhugeint + 18446744073709551616::uhugeint - {p1}")]
    merged = cut(" + ".join(turn(f"v{i + 1}", r) for i, r in enumerate((1, 7, 12, 18))))
    for i in range(4):
        merged = cut(f"{mul(f'xor({merged}, {rounds(f'v{i + 1}')})', p1)} + {p4}")
    return f"""x1 as (select b, n, {", ".join(f"{lane(v, i)} as v{i + 1}" for i, v in enumerate(starts))} from x0),
x2 as (select b, n, {cut(f"(case when n >= 32 then {merged} else {seed}::uhugeint + {p5} end) + n::uhugeint")} as h from x1),
x3 as (select b, n, {fold("h", f"[{word('n // 32 * 32 + 8 * s', 8)} for s in range(n % 32 // 8)]", cut(f"{mul(turn_once(f'xor(h, {rounds("k")})', 27), p1)} + {p4}"))} as h from x2),
x4 as (select b, n, case when n % 8 >= 4 then {cut(f"{mul(turn_once(f'xor(h, {mul(word("n // 8 * 8", 4), p1)})', 23), p2)} + {p3}")} else h end as h from x3),
x5 as (select b, {fold("h", "b[n // 4 * 4 + 1:]", mul(turn_once(f"xor(h, {mul('k', p5)})", 11), p1))} as h from x4),
x6 as (select b, {mul("xor(h, h >> 33)", p2)} as h from x5), x7 as (select b, {mul("xor(h, h >> 29)", p3)} as h from x6), x8 as (select b, xor(h, h >> 32) as h from x7)"""


SQL["op13_simhash"] = f"""with recursive d as (select doc_id, regexp_extract_all({_lower("text")}, '{WORD}') as words from documents),
w as (select doc_id, len(words) as size, unnest(words) as a, generate_subscripts(words, 1) as pos, words from d),
l as (select *, lead(a) over p as b, lead(a, 2) over p as c, lead(a, 3) over p as e from w window p as (partition by doc_id order by pos)),
s as (select doc_id, case when size < 4 then array_to_string(words, ' ') else a || ' ' || b || ' ' || c || ' ' || e end as gram from l where pos = 1 or e is not null),
x0 as (select b, len(b) as n from (select distinct [('0x' || x)::uhugeint for x in regexp_extract_all(hex(encode(gram)), '..')] as b from s)),
{_xxh64_sql()},
h as (select doc_id, x8.h from (select doc_id, [('0x' || x)::uhugeint for x in regexp_extract_all(hex(encode(gram)), '..')] as b from s) join x8 using (b)),
o as (select doc_id, i, 2 * count(*) filter (where ((h >> i::uhugeint) & 1::uhugeint) = 1) > count(*) as bit from (select doc_id, h, unnest(range(64)) as i from h) group by doc_id, i),
q as (select doc_id, (list_reduce(list_concat([0::uhugeint], list(1::uhugeint << i::uhugeint) filter (where bit)), lambda x, y: x + y)) as fp from o group by doc_id),
p as (select d.doc_id, coalesce(fp, 0)::ubigint as fp from d left join q using (doc_id)), n as (select fp, min(doc_id) as first from p group by fp),
e as (select x.fp as a, y.fp as b from n x, n y where bit_count(xor(x.fp, y.fp)::bit) <= 4),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
k as (select a as fp, min(first) as component_id from r join n on n.fp = r.b group by a)
select doc_id, lower(lpad(hex(fp), 16, '0')) as fingerprint, component_id from p join k using (fp)"""
