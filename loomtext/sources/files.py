"""Raw text, CSV-like samples, flat settings and file hashes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import work_id


def decoded(content):
    """Bytes as text: UTF-8 (a BOM is dropped), else GB18030. UTF-8 is decided in the JVM, only other files reach Python."""

    @F.pandas_udf("string")
    def legacy(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: None if x is None else x.decode("gb18030"))

    utf8 = F.try_validate_utf8(content.cast("string"))
    return F.coalesce(F.regexp_replace(utf8, "^﻿", ""), legacy(F.when(utf8.isNull(), content)))


def read_texts(spark: SparkSession, folder: str, pattern: str = r"(?i)\.(txt|md)$") -> DataFrame:
    """path (relative), work_id, text of all .txt and .md files below a folder."""
    files = text_files(spark, folder, pattern)
    return files.select("path", work_id(F.col("path")).alias("work_id"), decoded(F.col("content")).alias("text"))


def text_files(spark: SparkSession, folder: str, pattern: str = r"(?i)\.(txt|md)$") -> DataFrame:
    """path (relative to the folder), length, content of the matching files at any depth."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where(F.col("path").rlike(pattern))
    return files.select(F.substring("path", len(root) + 2, 1 << 20).alias("path"), "length", "content")


def count_texts(spark: SparkSession, folder: str, pattern: str = r"(?i)\.(txt|md)$") -> int:
    """The number of matching files; contents are not read. A missing folder has none."""
    from .jsonl import exists

    return text_files(spark, folder, pattern).select("path").count() if exists(spark, folder) else 0


def file_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", F.sha2("content", 256).alias("sha256"))


def gpu_memory(lines: DataFrame, value: str = "value") -> DataFrame:
    """name, free_mb, total_mb of lines "name, total, free"; lines of another shape are left out."""
    p = F.transform(F.split(value, ","), lambda x: F.trim(x))
    rows = lines.withColumn("p", p).where(F.size("p") == 3)
    return rows.select(F.col("p")[0].alias("name"), F.expr("try_cast(p[1] as int)").alias("total_mb"), F.expr("try_cast(p[2] as int)").alias("free_mb")).where("total_mb is not null and free_mb is not null")


def gpu_processes(lines: DataFrame, value: str = "value") -> DataFrame:
    """pid, name, used_mb of lines "pid, name, used"."""
    rows = lines.withColumn("p", F.transform(F.split(value, ","), lambda x: F.trim(x))).where(F.size("p") == 3)
    return rows.select(F.expr("try_cast(p[0] as int)").alias("pid"), F.col("p")[1].alias("name"), F.expr("try_cast(p[2] as int)").alias("used_mb")).where("pid is not null and used_mb is not null")


def flat_settings(lines: DataFrame, value: str = "value") -> DataFrame:
    """key, kind (bool, null, int, float, string), text of "key: value" lines; comments and other lines are left out."""
    rows = lines.where(~F.ltrim(value).startswith("#") & F.contains(F.col(value), F.lit(":")))
    raw = F.trim(F.regexp_replace(value, r"^[^:]*:", ""))
    rows = rows.select(F.trim(F.split(value, ":", 2)[0]).alias("key"), raw.alias("raw"))
    quoted = F.col("raw").rlike("^(\".*\"|'.*')$")
    kind = F.when(quoted, "string").when(F.lower("raw").isin("true", "false"), "bool").when(F.lower("raw").isin("null", "~", ""), "null").when(F.expr("try_cast(raw as bigint)").isNotNull(), "int").when(F.expr("try_cast(raw as double)").isNotNull(), "float").otherwise("string")
    return rows.select("key", kind.alias("kind"), F.when(quoted, F.expr("substring(raw, 2, length(raw) - 2)")).otherwise(F.col("raw")).alias("text"))


def scalar_text(value) -> str:
    """A scalar as flat settings write it: a string that would read as something else is quoted."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, str):
        plain = value == value.strip() and value.lower() not in ("", "true", "false", "null", "~") and not value.startswith(("#", "'", '"', "[", "{", "- ")) and "\n" not in value and ": " not in value and " #" not in value
        try:
            float(value)
            plain = False
        except ValueError:
            pass
        return value if plain else f'"{value}"'
    raise TypeError(f"not a scalar: {value!r}")


def settings_text(settings: dict) -> str:
    """"key: value" lines in the dict's order."""
    return "".join(f"{k}: {scalar_text(v)}\n" for k, v in settings.items())
