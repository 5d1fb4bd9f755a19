"""Event logs, streams, seeded samples and hashes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.split import seeded_split as draw
from ..sources.jsonl import canonical_hash as canonical
from ..sources.store import scratch
from ..streaming import events as E
from .text_queries import _docs

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def _events(spark, d):
    return spark.read.parquet(f"{d}/events.parquet")


def events_daily(spark, d):
    out = E.windowed_counts(_events(spark, d))
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def event_sessions(spark, d):
    out = E.sessions(_events(spark, d), "6 hours")
    return out.groupBy("user_id").agg(F.count("*").alias("sessions"), F.max("n").alias("longest"))


def events_stream(spark, d):
    """The daily counts as a stream: all that is there is processed once, and only days that the watermark has closed are written."""
    base = scratch(spark, "stream")
    E.drain(E.windowed_counts(E.read_events(spark, f"{d}/events.parque*", EVENTS)), f"{base}/out", f"{base}/state")
    out = spark.read.parquet(f"{base}/out")
    return out.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def canonical_hash(spark, d):
    return _events(spark, d).select("event_id", canonical(F.col("props")).alias("sha256"))


def seeded_split(spark, d):
    """50 documents by place with Python's generator: not SQL; tests hold it against random.Random."""
    return draw(spark, _docs(spark, d, "doc_id"), "doc_id", 50, 42)


DAILY = "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 4) as total from events {} group by 1, 2"
SQL = {
    "events_daily": DAILY.format(""),
    "events_stream": DAILY.format("where date_trunc('day', ts) + interval 1 day <= (select max(ts) from events) - interval 1 hour"),
    "event_sessions": "with a as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 6 hours then 0 else 1 end as opens from events), b as (select user_id, sum(opens) over (partition by user_id order by ts, opens desc rows unbounded preceding) as s from a), c as (select user_id, s, count(*) as n from b group by 1, 2) select user_id, count(*) as sessions, max(n) as longest from c group by user_id",
    "canonical_hash": "select event_id, sha256(replace(props, ' ', '')) as sha256 from events",
}
QUERIES = {name: globals()[name] for name in [*SQL, "seeded_split"]}
