"""A segmented scan: what a machine of few states has seen before each row of a long, ordered group.

A group may lie in many splits. Each row tells, for every state the machine may be in, the state after it and an amount
it adds; rows are walked once in ranges of (key, order), and for the group that a range begins with the walk is made for
every start. Each range then leaves one summary, the summaries are chained (a row a range), and what the chain says
of a range's start picks the row's answer. No task holds a group, and nothing but these small rows is moved."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..sources.store import stored


def _walk(states: int):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, opening = (), True
        now, total = list(range(states)), [0] * states
        for batch in batches:
            keys, ends, adds = (batch.column(c).to_pylist() for c in ("key", "ends", "adds"))
            out = []
            for key, end, add in zip(keys, ends, adds):
                if last and last[0] != key:
                    opening, now, total = False, list(range(states)), [0] * states
                last = (key,)
                before, sums = now, total
                now, total = [end[s] for s in now], [t + add[s] for s, t in zip(now, total)]
                out.append((opening, before, sums, now, total))
            new = [pa.array(c, t) for c, t in zip(zip(*out), (pa.bool_(), *[pa.list_(pa.int64())] * 4))] if out else [pa.array([], t) for t in (pa.bool_(), *[pa.list_(pa.int64())] * 4)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("key", "order", "at")] + new, names=["key", "order", "at", "opening", "before", "sums", "after", "totals"])

    return stream


def scanned(rows: DataFrame, states: int) -> DataFrame:
    """key, order, state (before the row; a group begins in state 0), total (added in its group before the row).

    rows: key, order (unique in its key), ends and adds (arrays with an entry for each state)."""
    spark = rows.sparkSession
    kinds = {f.name: f.dataType for f in rows.schema}
    long = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("key", kinds["key"]), T.StructField("order", kinds["order"]), T.StructField("at", T.LongType()), T.StructField("opening", T.BooleanType()), *[T.StructField(c, long) for c in ("before", "sums", "after", "totals")]])
    ranges = rows.select("key", "order", F.col("ends").cast(long), F.col("adds").cast(long)).repartitionByRange("key", "order").sortWithinPartitions("key", "order")
    walked = stored(ranges.withColumn("at", F.monotonically_increasing_id()).mapInArrow(_walk(states), schema), "walked")
    part = F.shiftright("at", 33)
    ends = walked.groupBy(part.alias("part")).agg(F.min_by("key", "at").alias("first"), F.max_by(F.struct("key", "opening", "after", "totals"), "at").alias("last")).collect()  # a row a range
    state, total, before, starts = 0, 0, None, []
    for r in sorted(ends, key=lambda r: r.part):
        if before is None or before.key != r.first:
            state, total = 0, 0
        starts.append((r.part, state, total))
        s = state if r.last.opening else 0
        state, total, before = r.last.after[s], r.last.totals[s] + (total if r.last.opening else 0), r.last
    known = F.broadcast(spark.createDataFrame(starts or [(0, 0, 0)], "_part long, _state int, _total long"))
    out = walked.join(known, part == F.col("_part"))
    start = F.when(F.col("opening"), F.col("_state")).otherwise(0)
    return out.select("key", "order", F.get("before", start).cast("int").alias("state"), (F.get("sums", start) + F.when(F.col("opening"), F.col("_total")).otherwise(0)).alias("total"))
