"""Streaming queries over the events, run over all files that are there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import upsert
from ..streaming import streams as R
from .registry import Tables, plan


def _events(t: Tables) -> DataFrame:
    return R.file_stream(t.spark, f"{t.folder}/events.parquet")


@plan("""
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL
""")
def stream_windowed(t: Tables) -> DataFrame:
    """Tumbling windows with a watermark."""
    out = R.run_available(R.windowed(_events(t), "ts", ["event_type"], "value"), "complete")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))


@plan("SELECT event_id, user_id, value FROM events")
def stream_idempotent(t: Tables) -> DataFrame:
    """Every event once, though the stream brings each twice."""
    e = _events(t)
    return R.run_available(R.idempotent(e.unionByName(e), "ts", "event_id", "60 days")).select("event_id", "user_id", "value")


@plan("""
WITH a AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) >= 21600000000 THEN 1 ELSE 0 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM a)
SELECT user_id, count(*) AS n, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM s GROUP BY user_id, session
""")
def stream_sessions(t: Tables) -> DataFrame:
    """Sessions of each user by inactivity."""
    from ..functions.scalars import micros

    out = R.run_available(R.sessions(_events(t), "ts", ["user_id"], "6 hours"), "complete")
    return out.select("user_id", "n", micros("first").alias("first_us"), micros("last").alias("last_us"))


@plan("""
SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""")
def stream_upsert(t: Tables) -> DataFrame:
    """The latest event of each user, merged batch by batch."""
    from ..operators.joins import best_row

    def merge(before: DataFrame | None, batch: DataFrame) -> DataFrame:
        new = best_row(batch if before is None else before.unionByName(batch), ["user_id"], [F.desc("ts"), F.desc("event_id")])
        return new if before is None else upsert(before, new, ["user_id"])

    return R.run_available(_events(t).select("user_id", "event_id", "ts", "value"), merge=merge).select("user_id", "event_id", "value")


@plan("""
SELECT key, count(*) AS n, max(w) AS newest FROM (SELECT event_type AS key, epoch_us(ts) AS w, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS r FROM events) WHERE r <= 20 GROUP BY key
""")
def stream_last_n(t: Tables) -> DataFrame:
    """A window of the last rows of each type, kept in state."""
    last = R.run_available(R.last_n(_events(t), "event_type", "ts", "value", 20), "update", merge=lambda before, batch: batch if before is None else upsert(before, batch, ["key"]))
    return last.select("key", "n", "newest")
