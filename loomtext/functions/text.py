"""Text metrics as Column expressions of a text and a profile."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from ..profile import ZH, TextProfile

#: White space of Unicode: what strip() removes.
EDGES = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(EDGES))


def texts(values) -> Column:
    """An array of literal strings, empty too."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def counted_chars(text: Column, p: TextProfile = ZH) -> Column:
    return F.regexp_count(text, F.lit(f"[{p.counted}]"))


def normalize_newlines(text: Column) -> Column:
    text = F.regexp_replace(text, r"\r\n?", "\n")
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def paragraphs(text: Column, p: TextProfile = ZH) -> Column:
    parts = F.split(normalize_newlines(text), p.paragraph.replace("\n", r"\n"), -1)
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def paragraph_lengths(text: Column, p: TextProfile = ZH) -> Column:
    return F.transform(paragraphs(text, p), lambda x: counted_chars(x, p))


def dialogue_ratio(text: Column, p: TextProfile = ZH) -> Column:
    """Share of paragraphs that hold or begin with a dialogue mark; 0 without paragraphs."""
    parts = paragraphs(text, p)

    def speaks(x: Column) -> Column:
        out = F.lit(False)
        for mark in p.dialogue_anywhere:
            out = out | F.contains(x, F.lit(mark))
        for mark in p.dialogue_start:
            out = out | F.startswith(x, F.lit(mark))
        return out

    return F.when(F.size(parts) == 0, 0.0).otherwise(F.size(F.filter(parts, speaks)) / F.size(parts))


def counted_only(text: Column, p: TextProfile = ZH) -> Column:
    return F.regexp_replace(text, f"[^{p.counted}]", "")


def windows(text: Column, n: int) -> Column:
    """All n-character windows; a lookahead walks the text once where substring() would walk it for each window."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def _ranks(text: str) -> tuple[np.ndarray, int]:
    """Of each code point its place, from 1 on, among the distinct ones of the text; and how many there are."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    seen = np.zeros(int(code.max(initial=0)) + 1, np.uint64)
    seen[code] = 1
    return (np.cumsum(seen, dtype=np.uint64) * seen)[code], int(seen.sum())


def _packed(rank: np.ndarray, letters: int, n: int) -> np.ndarray:
    """A number for each window of n: equal windows have equal numbers, others do not."""
    out, width, most = rank, 1, letters
    while width < n:
        step = min(width, n - width)
        if (most + 1) ** 2 >> 64:  # two numbers no longer fit into one: places among the distinct ones instead
            distinct, out = np.unique(out, return_inverse=True)
            most, out = len(distinct), out.astype(np.uint64) + np.uint64(1)
        out = out[: len(out) - step] * np.uint64(most + 1) + out[step:]
        width, most = width + step, (most + 1) ** 2 - 1
    return out


def _repeated_share(n: int):
    @F.arrow_udf(DoubleType())
    def share(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            if text is None:
                out.append(None)
                continue
            rank, letters = _ranks(text)
            many = len(rank) - n + 1
            if many < 1:
                out.append(0.0)
                continue
            own = np.sort(_packed(rank, letters, n))
            out.append((many - 1 - int(np.count_nonzero(own[1:] != own[:-1]))) / many)
        return pa.array(out, pa.float64())

    return share


def repeated_share(own: Column, n: int) -> Column:
    """Share of the n-character windows that repeat an earlier one; 0 if shorter than n. Windows are numbers, not strings."""
    return _repeated_share(n)(own)


def repeated_ngram_ratio(text: Column, n: int = 4, p: TextProfile = ZH) -> Column:
    """Sum of (count - 1) over repeated n-grams of the counted characters, over all; 0 if shorter than n."""
    return repeated_share(counted_only(text, p), n)


def shingles(text: Column, k: int = 12, p: TextProfile = ZH) -> Column:
    """The set of k-windows of the counted characters; the whole if no longer than k; none if empty."""
    own = counted_only(text, p)
    return F.when(own == "", F.array().cast("array<string>")).when(F.length(own) <= k, F.array(own)).otherwise(F.array_distinct(windows(own, k)))


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.round(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)), 4))


def sentence_lengths(text: Column, p: TextProfile = ZH) -> Column:
    """Counted characters of each sentence that has any; line ends do not part sentences."""
    found = F.regexp_extract_all(F.replace(text, F.lit("\n"), F.lit("")), F.lit(f"[^{p.sentence_end}]+[{p.sentence_end}]?"), F.lit(0))
    return F.filter(F.transform(found, lambda x: counted_chars(x, p)), lambda n: n > 0)


def present(text: Column, phrases) -> Column:
    """Which phrases occur, in the order of the list."""
    return F.filter(texts(phrases) if not isinstance(phrases, Column) else phrases, lambda x: F.contains(text, x))


def count_of(text: Column, phrase) -> Column:
    """Occurrences of a literal that do not overlap."""
    literal = F.lit(phrase)
    return F.floor((F.length(text) - F.length(F.replace(text, literal, F.lit("")))) / F.length(literal)).cast("int")


def coverage(text: Column, required: Column) -> Column:
    """Share of the required items that occur; an empty item never does; 1 without items."""
    return F.when(F.coalesce(F.size(required), F.lit(0)) == 0, 1.0).otherwise(F.size(F.filter(required, lambda x: (x != "") & F.contains(text, x))) / F.size(required))


def runs(text: Column, p: TextProfile = ZH, least: int = 1) -> Column:
    """Maximal runs of counted characters."""
    return F.regexp_extract_all(text, F.lit(f"[{p.counted}]{{{least},}}"), F.lit(0))


def _thrice(text: str) -> list[str]:
    """Of runs that each end in \\0: the elements (see repeated_runs) that occur three times, in order."""
    rank, letters = _ranks(text)
    end = np.flatnonzero(rank == 1)  # \\0 is the least code point
    begin = np.concatenate([[0], end[:-1] + 1])
    begin, end = begin[end - begin >= 5], end[end - begin >= 5]
    size = end - begin
    many = np.where(size < 8, 1, size - 6)  # windows of 8 and the last 7, or the whole
    run = np.repeat(np.arange(len(end)), many)
    start = begin[run] + np.arange(len(run)) - (np.cumsum(many) - many)[run]
    # letters that a number of 64 bits holds; from then on places among the distinct numbers stand for what came before
    bits, each = (8, 8) if letters < 1 << 8 else (16, 2) if letters < 1 << 16 else (21, 1)
    rank = np.concatenate([rank, np.ones(7, np.uint64)])
    held, out = np.ones(len(start), bool), np.zeros(len(start), np.uint64)
    for i in range(8):
        held = held & (rank[start + i] > 1)  # nothing beyond the run's end
        if i and i % each == 0:
            out = np.unique(out, return_inverse=True)[1].astype(np.uint64)
        out = (out << np.uint64(bits)) + np.where(held, rank[start + i], np.uint64(0))
    own = np.sort(out)
    hot = own[2:][own[2:] == own[:-2]]
    if not len(hot):
        return []
    at = np.flatnonzero(np.isin(out, hot))
    return list(dict.fromkeys(text[a : min(a + 8, e)] for a, e in zip(start[at].tolist(), end[run[at]].tolist())))


@F.arrow_udf(ArrayType(StringType()))
def thrice(runs: pa.Array) -> pa.Array:
    return pa.array([None if r is None else _thrice(r + "\0") for r in runs.to_pylist()], pa.list_(pa.string()))


def marked_runs(text: Column, p: TextProfile = ZH) -> Column:
    """The runs of counted characters, parted by \\0, which is never counted."""
    return F.regexp_replace(text, f"[^{p.counted}]+", "\0")


def repeated_runs(text: Column, p: TextProfile = ZH) -> Column:
    """What occurs three times among the 8-windows inside runs of 5 or more, in the order of its first: a run of less than
    8 counts whole; a run of 8 or more also brings its last 7 characters. Windows are numbers, only those found are strings."""
    return thrice(marked_runs(text, p))


def source_terms(text: Column, p: TextProfile = ZH) -> Column:
    """Runs of 2 to 4 whole; of longer ones all 2-, 3- and 4-grams; sorted."""
    def terms(r: Column) -> Column:
        return F.when(F.length(r) <= 4, F.array(r)).otherwise(F.concat(windows(r, 2), windows(r, 3), windows(r, 4)))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(runs(text, p, 2), terms))))


def term_coverage(source: Column, text: Column, p: TextProfile = ZH) -> Column:
    terms = source_terms(source, p)
    return F.when(F.size(terms) == 0, 1.0).otherwise(F.size(F.filter(terms, lambda t: F.contains(text, t))) / F.size(terms))


def leak_fragment(source: Column, rendered: Column, k: int = 12, p: TextProfile = ZH) -> Column:
    """The first k-window of a run of source that occurs in rendered, or null.

    A window holds counted characters only, so where it occurs it is a window of a run there, too."""
    all_windows = lambda text: F.flatten(F.transform(runs(text, p, k), lambda r: windows(r, k)))
    return F.get(F.array_intersect(all_windows(source), all_windows(rendered)), F.lit(0))


def preview(text: Column) -> Column:
    """Stripped, line ends shown, at most 80 characters."""
    line = F.replace(strip(text), F.lit("\n"), F.lit("\\n"))
    return F.when(F.length(line) > 80, F.concat(F.left(line, F.lit(77)), F.lit("..."))).otherwise(line)


def evidence_start(raw: Column, evidence: Column) -> Column:
    """0-based first position of evidence in raw, or null."""
    return F.nullif(F.position(evidence, raw), F.lit(0)) - 1


def evidence_holds(raw: Column, text: Column, start: Column, end: Column) -> Column:
    return (F.substring(raw, start + 1, end - start) == text) & (end > start) & (start >= 0)


def issue_label(label: Column) -> Column:
    """Lower case, other than [a-z0-9_] to one underscore, no edge underscores, 80 characters at most; empty to null."""
    out = F.regexp_replace(F.regexp_replace(F.lower(label), "[^a-z0-9_]+", "_"), "_+", "_")
    return F.nullif(F.left(F.regexp_replace(out, "^_+|_+$", ""), F.lit(80)), F.lit(""))


def is_sha256(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\A[0-9a-f]{64}\z"), F.lit(False))


def filled(text: Column) -> Column:
    """Whether there is more than white space."""
    return F.coalesce(strip(text) != "", F.lit(False))


def word_target(chars: Column) -> Column:
    return F.when(chars <= 2500, "2000-2500中文汉字").when(chars <= 3000, "2500-3000中文汉字").otherwise("3000-4000中文汉字")


def beat_chars(chars: Column, ratio: float) -> Column:
    """Half-even to the nearest 50."""
    return (F.bround(chars * F.lit(ratio) / 50) * 50).cast("int")


def abstract_only(goal: Column, *concrete: Column) -> Column:
    """Whether a goal is nothing but stock advice and no field is concrete."""
    # The stock advice.
    advice = ("节奏紧凑", "写得爽一点", "减少 AI 味")
    plain = lambda x: strip(F.replace(F.replace(x, F.lit(" "), F.lit("")), F.lit("AI"), F.lit("ai")))
    phrases = F.filter(F.transform(F.split(F.translate(goal, "，。", ",,"), ","), plain), lambda x: x != "")
    stock = F.transform(texts(advice), plain)
    some = F.lit(False)
    for c in concrete:
        some = some | F.coalesce(c, F.lit(False))
    return (F.size(phrases) > 0) & F.forall(phrases, lambda x: F.array_contains(stock, x)) & ~some


def work_id(path: Column) -> Column:
    """Of a relative path: its parts made safe, joined by __, then eight digits of the SHA-1 of the path without its suffix."""
    bare = F.regexp_replace(path, r"(?<=[^/])\.[^./]+$", "")
    safe = lambda x: F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", "_"), r"[^0-9A-Za-z_\-\x{4e00}-\x{9fff}]+", "_"), "^_+|_+$", "")
    parts = F.transform(F.split(bare, "/"), lambda x: F.coalesce(F.nullif(safe(x), F.lit("")), F.lit("part")))
    name = F.coalesce(F.nullif(F.regexp_replace(F.array_join(parts, "__"), "^_+|_+$", ""), F.lit("")), F.lit("work"))
    return F.concat(name, F.lit("__"), F.left(F.sha1(bare), F.lit(8)))
