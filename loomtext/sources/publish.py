"""Outputs that appear all together or not at all, and appends that a rerun does not repeat."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.gates import require
from .jsonl import exists


class Files:
    """The file system of a folder, through Spark: the outputs need not lie on a local disk."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def has(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        if not self.fs.rename(self.path(name), self.path(to)):
            raise OSError(f"cannot move {name} to {to}")

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))] if self.has(folder) else []

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


def withdraw(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Remove outputs that no longer hold."""
    files = Files(spark, folder)
    for name in names:
        files.drop(f"{folder}/{name}")


def recover(spark: SparkSession, folder: str) -> None:
    """Finish publications whose list was written, and remove what others left: a run that was lost half-way leaves
    either all of its outputs or none."""
    files = Files(spark, folder)
    for name in files.names(folder):
        if name.startswith("_commit-") and not name.endswith(".tmp"):
            _move_in(files, folder, f"{folder}/_staged-{name.removeprefix('_commit-')}", json.loads(files.read(f"{folder}/{name}")))
            files.drop(f"{folder}/{name}")
    for name in files.names(folder):
        if name.startswith("_staged-") or name.startswith("_commit-"):
            files.drop(f"{folder}/{name}")


def _move_in(files: Files, folder: str, staged: str, names: list[str]) -> None:
    for name in names:
        if files.has(f"{staged}/{name}"):  # else it was moved before the run was lost
            files.drop(f"{folder}/{name}")
            files.move(f"{staged}/{name}", f"{folder}/{name}")
    files.drop(staged)


def publish(spark: SparkSession, folder: str, outputs: dict[str, DataFrame | str | Callable[[str], None]], violations: DataFrame | None = None, form: str = "json") -> None:
    """Write several outputs of one folder as one: tables, texts, or whatever a function writes to the path it is given.

    All are written to a staging folder first; the list of their names, renamed into place, is the point of no return, and
    what follows are renames that recover() can finish. Violations, or an output that fails, remove the outputs of
    earlier runs too: stale results beside a failure are worse than none."""
    files, name = Files(spark, folder), uuid.uuid4().hex
    recover(spark, folder)
    staged = f"{folder}/_staged-{name}"
    try:
        if violations is not None:
            require(violations)
        for out, what in outputs.items():
            if isinstance(what, str):
                files.write(f"{staged}/{out}", what)
            elif isinstance(what, DataFrame):
                what.write.format(form).save(f"{staged}/{out}")
            else:
                what(f"{staged}/{out}")
        files.write(f"{folder}/_commit-{name}.tmp", json.dumps(list(outputs)))
        files.move(f"{folder}/_commit-{name}.tmp", f"{folder}/_commit-{name}")
    except Exception:
        files.drop(staged)
        files.drop(f"{folder}/_commit-{name}.tmp")
        withdraw(spark, folder, list(outputs))
        raise
    _move_in(files, folder, staged, list(outputs))
    files.drop(f"{folder}/_commit-{name}")


def append_absent(rows: DataFrame, path: str, keys: list[str], form: str = "parquet") -> None:
    """Append the rows whose keys the sink lacks, one of each key: a rerun, or a batch that overlaps an earlier one, adds
    only what is new. Keys are compared by an anti join; no row of the sink but its keys is read."""
    spark = rows.sparkSession
    new = rows.dropDuplicates(keys)
    if exists(spark, path):
        held = spark.read.format(form).schema(rows.schema).load(path).select(*keys).distinct()
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
        new = new.alias("n").join(held.alias("h"), same, "left_anti")
    new.write.format(form).mode("append").save(path)


def append_batch(path: str, form: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A writer for foreachBatch whose ledger is the folder itself: batch n is the folder batch=n, so a batch that is
    delivered again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.format(form).mode("overwrite").save(f"{path}/batch={number}")

    return write


def append_stream(stream: DataFrame, path: str, checkpoint: str, form: str = "parquet") -> None:
    """Append all that a stream holds, each batch once however often it is delivered, then stop."""
    stream.writeStream.foreachBatch(append_batch(path, form)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def log_events(rows: DataFrame, phase: str, status: str, *detail: str) -> DataFrame:
    """Rows of an event log: time, phase, status and the named columns as detail; append_absent adds them."""
    out = [F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("time"), F.lit(phase).alias("phase"), F.lit(status).alias("status")]
    return rows.select(*out, *([F.to_json(F.struct(*detail)).alias("detail")] if detail else []))
