"""Event streams: counts by window, sessions, first lines of phases. Each works on batch and stream alike.

State is bounded by watermarks: windows and sessions close `late` after the newest event, and the phases of a run are
forgotten some time after its last line."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as T
from ..functions.rules import PHASES, log_phases


def read_events(spark: SparkSession, folder: str, schema: str, form: str = "parquet", files: int = 16) -> DataFrame:
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files).load(folder)


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """start, event_type, n, total by tumbling window."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, start, end, n of each user's sessions."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def deduplicated(events: DataFrame, key: str = "event_id", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def phases_first(lines: DataFrame, order: str, run: str = "run", line: str = "line") -> DataFrame:
    """run, phase, order, line of the first line of each phase of each run, of a table. A line may open several phases."""
    hit = lines.select(F.col(run).alias("run"), F.col(order).alias("order"), T.strip(F.col(line)).alias("line")).select("run", "order", "line", F.explode(log_phases(F.col("line"))).alias("phase"))
    first = hit.groupBy("run", "phase").agg(F.min_by(F.struct("order", "line"), F.struct("order", "line")).alias("x"))
    return first.select("run", "phase", "x.order", "x.line")


SEEN = "run string, phase string, ts timestamp, line string"


def phases_seen(lines: DataFrame, late: str = "1 hour", idle: str = "6 hours") -> DataFrame:
    """run, phase, ts, line of the first line of each phase of each run, of a stream of (run string, ts, line).

    A run's state is one number, a bit a phase, and has a timer: once the watermark is `idle` past the newest
    line that opened a phase the state is dropped, so there are as many states as runs at work, not as runs ever seen. Lines that are late
    beyond the watermark are left out. A run that speaks again after that begins anew."""
    names = [name for name, _ in PHASES]
    gap = int(pd.Timedelta(idle).total_seconds() * 1000)

    def see(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, newest = state.get if state.exists else (0, 0)
        # a group may come in several frames, so its lines are put in order before they are looked at
        rows = pd.concat(list(frames)).sort_values(["ms", "line"], kind="stable")
        rows = rows[rows["ms"] > state.getCurrentWatermarkMs()]  # the plan's own filter lags a batch behind
        if not len(rows):
            return
        out = []
        for ts, line, phases in zip(rows["ts"], rows["line"], rows["phases"]):
            for phase in phases:
                bit = 1 << names.index(phase)
                if not seen & bit:
                    seen |= bit
                    out.append((key[0], phase, ts, line))
        newest = max(newest, int(rows["ms"].max()))
        state.update((seen, newest))
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + gap)
        if out:
            yield pd.DataFrame(out, columns=["run", "phase", "ts", "line"])

    # lines without a phase never leave the scan; only their markers' hits are grouped
    hits = lines.withWatermark("ts", late).select("run", "ts", F.unix_millis("ts").alias("ms"), T.strip(F.col("line")).alias("line")).withColumn("phases", log_phases(F.col("line"))).where(F.size("phases") > 0)
    return hits.groupBy("run").applyInPandasWithState(see, SEEN, "seen long, newest long", "append", GroupStateTimeout.EventTimeTimeout)


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process all that is there, then stop; the checkpoint makes a rerun take up where it ended."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
