"""The scoring rules: a text and its card give metrics, failure types and a hard gate, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..profile import ZH, TextProfile
from . import text as T

#: Failures that leave the gate open.
SOFT = ("ai_trace", "generic_ai_phrase")
#: After a line end, also one put before the text: a search for one character costs far less than one for an alternative.
MARKDOWN = r"\n\s*(>|#{1,6}\s+|[-*]\s+|\d+[.、]\s+)"


def _named(*rules: tuple[Column, str]) -> Column:
    """The names of the rules that hold, in order."""
    return F.filter(F.array(*[F.when(hit, F.lit(name)) for hit, name in rules]), lambda x: x.isNotNull())


def quality_issues(text: Column, payoff: Column, hook: Column, p: TextProfile = ZH, chars: Column | None = None, repeated: Column | None = None) -> Column:
    """Sorted names of the quality rules that fire. chars, repeated: columns that already hold these, if any."""
    end = T.strip(text)
    chars = T.counted_chars(text, p) if chars is None else chars
    repeats = F.size(T.repeated_runs(text, p) if repeated is None else repeated) > 0
    payoff, hook = T.strip(F.coalesce(payoff, F.lit(""))), T.strip(F.coalesce(hook, F.lit("")))
    generic = F.lit(False)
    for phrase in p.generic_phrases:
        generic = generic | (T.count_of(text, phrase) >= 2)
    tail = F.when(F.length(text) > p.hook_tail, F.right(text, F.lit(p.hook_tail))).otherwise(text)
    return _named(  # in alphabetical order
        (F.size(T.present(text, p.disclaimer_markers)) > 0, "disclaimer_residue"),
        (generic, "generic_ai_phrase"),
        (F.concat(F.lit("\n"), text).rlike(MARKDOWN), "markdown_residue"),
        (F.size(T.present(text, p.meta_markers)) > 0, "meta_evaluation_residue"),
        ((payoff != "") & (T.term_coverage(payoff, text, p) < p.coverage), "no_visible_payoff"),
        ((chars >= p.padded) & repeats, "padding_to_length"),
        (repeats, "semantic_repetition"),
        ((end != "") & ~end.rlike(f"[{p.prose_end}]$"), "unnatural_ending"),
        ((hook != "") & (T.term_coverage(hook, tail, p) < p.coverage), "weak_ending_hook"),
    )


def scored(rows: DataFrame, keep: list[str], text: str, must: Column, must_not: Column, payoff: Column, hook: Column, p: TextProfile = ZH) -> DataFrame:
    """keep and the metrics of each output, in one projection after another: what several rules need is computed once.

    The last step is a generator over one element, through which no filter on a metric can be pushed: a filter there
    would have the rules evaluated twice. Filters on the kept columns still reach the scan."""
    t, none = F.col("_text"), F.array().cast("array<string>")
    must, must_not, payoff, hook = (c.alias(n) for c, n in ((must, "_must"), (must_not, "_not"), (payoff, "_payoff"), (hook, "_hook")))
    own = rows.select(*keep, F.col(text).alias("_text"), T.marked_runs(F.col(text), p).alias("_runs"), must, must_not, payoff, hook)
    own = own.withColumn("_own", F.replace("_runs", F.lit("\0"), F.lit("")))
    base = own.select(
        *keep, "_text", "_must", "_payoff", "_hook", F.length("_own").alias("_chars"), T.repeated_share(F.col("_own"), 4).alias("_repetition"), T.coverage(t, F.col("_must")).alias("_covered"),
        F.filter(F.coalesce("_not", none), lambda x: (x != "") & F.contains(t, x)).alias("_forbidden"), T.present(t, p.trace_phrases).alias("_trace"), T.thrice(F.col("_runs")).alias("_repeated"),
    )
    first = _named(
        (F.col("_chars") < p.shortest, "length_short"),
        (F.col("_chars") > p.longest, "length_long"),
        (F.size(T.present(t, p.outline_markers)) > 0, "outline_leak"),
        (F.col("_covered") < 1.0, "must_include_missing"),
        (F.size("_forbidden") > 0, "forbidden_violation"),
        (F.col("_repetition") > p.repetition, "repetition"),
        (F.size("_trace") > 0, "ai_trace"),
    )
    judged = base.withColumn("_failures", F.concat(first, quality_issues(t, F.col("_payoff"), F.col("_hook"), p, F.col("_chars"), F.col("_repeated"))))
    metrics = {
        "char_count": F.col("_chars"), "must_include_coverage": F.round("_covered", 4), "forbidden_hits": F.col("_forbidden"), "ai_trace_count": F.size("_trace"), "ai_trace_matches": F.col("_trace"),
        "repeated_ngram_ratio": F.round("_repetition", 4), "failure_types": F.col("_failures"), "hard_gate_pass": F.size(F.array_except("_failures", T.texts(SOFT))) == 0,
        "repeated_runs": F.slice("_repeated", 1, 5),
    }
    return judged.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in metrics.items()]))))


def metric_score(passed: Column, failures: Column) -> Column:
    """10 for a pass, less one a failure; no list of failures counts as one."""
    return F.when(F.coalesce(passed, F.lit(False)), 10).otherwise(0) - F.coalesce(F.size(failures), F.lit(1))


def cap_counted(text: Column, most: int = 2500, p: TextProfile = ZH) -> Column:
    """The text cut before counted character most + 1, then back to the last sentence end if enough remains.

    Each counted character with what stands before it is one piece, so no long bounded repeat is needed."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s)([^{p.counted}]*[{p.counted}])"), F.lit(1))
    at = F.aggregate(F.slice(pieces, 1, most), F.lit(0), lambda n, x: n + F.length(x))
    rest = F.regexp_extract(F.substring(text, at + 1, F.length(text)), f"(?s)^[^{p.counted}]*", 0)
    cut = F.regexp_replace(F.concat(F.left(text, at), rest), r"(?U)\s+$", "")
    sentence = F.regexp_extract(cut, f"(?s)^(.*[{p.sentence_end}])", 1)
    backed = F.when((sentence != "") & (T.counted_chars(sentence, p) >= p.cap_floor), sentence).otherwise(cut)
    return T.strip(F.when(F.size(pieces) > most, backed).otherwise(text))


def training_error(log: Column, exit_code: Column) -> Column:
    """The kind of error of a training log, by ordered markers."""
    # Kinds and their markers, in order.
    rules = (
        ("cuda_oom", ("cuda out of memory", "cublas_status_alloc_failed")),
        ("process_killed", ("killed", "terminated")),
        ("driver_reset", ("device lost", "cuda driver", "unknown error")),
        ("bnb_load_error", ("bitsandbytes", "4-bit", "4bit")),
        ("tokenizer_error", ("tokenizer", "autotokenizer", "autoconfig")),
        ("dataset_error", ("dataset_info", "filenotfounderror", "jsondecodeerror", "dataset")),
        ("llamafactory_error", ("llamafactory", "unrecognized arguments", "invalid choice")),
        ("adapter_save_error", ("adapter_model", "save_pretrained", "permission denied")),
    )
    dataset = ("dataset_info", "filenotfounderror", "jsondecodeerror", "dataset", "data_sft", "data/", "data\\", ".jsonl", "input/", "input\\")
    saving = ("adapter", "output_dir", "save_pretrained", "adapter_model")
    specific = ("cuda_oom", "bnb_load_error", "tokenizer_error", "llamafactory_error")
    low = F.lower(log)
    held = lambda marks: F.size(T.present(low, marks)) > 0
    failed = F.coalesce(exit_code != 0, F.lit(False))
    out = F.when(F.coalesce(exit_code == 0, F.lit(False)), "none")
    for kind, marks in rules:
        if kind in specific:
            out = out.when(held(marks), kind)
    out = out.when(held(dataset), "dataset_error")
    denied = F.contains(low, F.lit("permission denied"))
    out = out.when(denied & held(saving), "adapter_save_error").when(denied & failed, "process_killed").when(denied, "none")
    for kind, marks in rules:
        if kind not in (*specific, "dataset_error"):
            out = out.when(held(marks), kind)
    return out.when(failed, "process_killed").otherwise("none")


#: What to do about each kind of error.
SUGGESTIONS = {
    "none": "无", "cuda_oom": "降低 cutoff_len，必要时降低 lora_rank", "process_killed": "查看 GPU 采样和系统稳定性，确认是否被系统结束", "driver_reset": "重启训练环境并检查驱动状态",
    "bnb_load_error": "检查 bitsandbytes、CUDA 和 PyTorch 版本匹配", "tokenizer_error": "检查本地模型目录和 tokenizer 文件", "dataset_error": "检查数据路径和 LLaMA-Factory dataset_info",
    "llamafactory_error": "检查 LLaMA-Factory 命令和参数", "adapter_save_error": "检查 output_dir 权限和磁盘空间",
}


def suggestion(kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in SUGGESTIONS.items() for x in pair])[kind]


# Phases of a training log and their markers, in order.
PHASES = (
    ("load_tokenizer", ("loading tokenizer", "load tokenizer", "autotokenizer")),
    ("load_base_model_4bit", ("load 4-bit base model", "load 4bit base model", "4-bit base model")),
    ("prepare_lora", ("prepare lora", "preparing lora", "inject lora", "lora adapter", "peft model")),
    ("tokenize_dataset", ("tokenize dataset", "tokenizing dataset")),
    ("first_forward", ("first forward", "first_forward")),
    ("first_backward", ("first backward", "first_backward")),
    ("first_optimizer_step", ("first optimizer step", "first_optimizer_step")),
    ("save_adapter", ("save adapter", "saving adapter", "save_pretrained")),
)


def log_phases(line: Column) -> Column:
    """All phases whose markers a log line holds, in order."""
    low = F.lower(line)
    return F.filter(F.array(*[F.when(F.size(T.present(low, marks)) > 0, F.lit(name)) for name, marks in PHASES]), lambda x: x.isNotNull())


def log_phase(line: Column) -> Column:
    """The first phase that a log line opens, or null."""
    return F.get(log_phases(line), F.lit(0))
