"""Streams over the events table, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import time_key
from millrace.plans.nested import DECODED_LINES, decoded_lines, line_messages
from millrace.plans.registry import query
from millrace.streaming import io, jobs, keyed
from millrace.workspace import new_name, new_path


def _event_stream(t):
    # a stream reads a folder or a glob, so the one file is named by a pattern
    return io.file_stream(t.spark, "parquet", f"{t.folder}/event[s].parquet", t.events.schema)


def _checkpoint(t):
    return new_path(t.spark, "stream-progress")


def _snapshot(t, df):
    path = new_path(t.spark, "snapshots")
    io.finish(io.to_snapshots(df, path, _checkpoint(t)))
    return io.latest_snapshot(t.spark, path)


@query("stream_counts", "ST1 ST2 SRC17 D7", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def stream_counts(t):
    return _snapshot(t, jobs.grouped_counts(_event_stream(t), ["event_type"]))


@query("stream_update_latest", "ST3", """
    SELECT user_id, count(*) AS events, max(value) AS top_value FROM events GROUP BY 1""")
def stream_update_latest(t):
    counted = _event_stream(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"),
                                                      F.max("value").alias("top_value"))
    path = new_path(t.spark, "updates")
    io.finish(io.to_update_log(counted, path, _checkpoint(t), keys=["user_id"]))
    return io.latest_updates(t.spark, path, ["user_id"])


@query("stream_keyed_state", "ST3 ST12", """
    SELECT user_id, event_type, count(*) AS events, max(value) AS top_value FROM events GROUP BY 1, 2""")
def stream_keyed_state(t):
    counted = _event_stream(t).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("events"),
                                                                    F.max("value").alias("top_value"))
    path = new_path(t.spark, "keyed")
    io.finish(keyed.to_keyed_state(counted, path, _checkpoint(t), ["user_id", "event_type"], buckets=8))
    return keyed.read_keyed_state(t.spark, path)


_MINUTES = """SELECT event_type, date_trunc('minute', ts) AS window_start,
                     date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS count
              FROM events GROUP BY 1, 2"""


def _minutes(df, watermark=None):
    return jobs.windowed(df, ["event_type"], "ts", "1 minute", [F.count(F.lit(1)).alias("count")], watermark)


@query("tumbling_counts", "ST5", _MINUTES)
def tumbling_counts(t):
    return _snapshot(t, _minutes(_event_stream(t)))


#: Windows that a watermark of five minutes has closed after the last event.
_CLOSED = " HAVING date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE"


@query("watermark_append", "ST6 ST11", _MINUTES + _CLOSED)
def watermark_append(t):
    name = new_name("closed_minutes")
    io.finish(io.to_table(_minutes(_event_stream(t), "5 minutes"), name, _checkpoint(t),
                          new_path(t.spark, "closed-minutes")))
    return t.spark.table(name)


@query("stream_decode_sink", "ST12 ST15", DECODED_LINES)
def stream_decode_sink(t):
    source, sink = new_path(t.spark, "messages"), new_path(t.spark, "decoded")
    messages = line_messages(t)
    messages.write.parquet(source)
    stream = io.file_stream(t.spark, "parquet", source, messages.schema)
    decoded = decoded_lines(stream)
    io.finish(io.to_files(decoded, sink, _checkpoint(t)))
    return t.spark.read.schema(decoded.schema).parquet(sink)


@query("stream_partitioned_sink", "ST13", """
    SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y%m%d%H%M') AS minute, strftime(ts, '%Y%m%d') AS day
    FROM events""")
def stream_partitioned_sink(t):
    # the minute stays a column and the day is the folder: a folder per minute makes tiny files
    keyed = _event_stream(t).select("event_id", "user_id", "event_type", "value", "props",
                                    time_key("ts").alias("minute"), time_key("ts", "yyyyMMdd").alias("day"))
    path = new_path(t.spark, "events-by-day")
    io.finish(io.to_files(keyed, path, _checkpoint(t), partition_by=["day"]))
    return t.spark.read.schema(keyed.schema).parquet(path)


@query("two_stage_stream", "ST14", """
    SELECT user_id, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, count(*) AS count
    FROM events GROUP BY 1, 2
    HAVING window_end <= (SELECT max(ts) FROM events) - INTERVAL 5 MINUTE""")
def two_stage_stream(t):
    raw, closed = new_path(t.spark, "raw-events"), new_path(t.spark, "closed-windows")
    first = _event_stream(t)
    io.finish(io.to_files(first, raw, _checkpoint(t)))
    second = io.file_stream(t.spark, "parquet", raw, first.schema)
    counted = jobs.windowed(second, ["user_id"], "ts", "5 minutes", [F.count(F.lit(1)).alias("count")],
                            watermark="5 minutes")
    io.finish(io.to_files(counted, closed, _checkpoint(t)))
    return t.spark.read.schema(counted.schema).parquet(closed)


@query("stream_static_join", "JN16 ST16", """
    SELECT c_name, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
           round(sum(value), 2) AS volume
    FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2""")
def stream_static_join(t):
    joined = jobs.windowed_with_dimension(
        _event_stream(t), "user_id", "ts", "5 minutes", [F.round(F.sum("value"), 2).alias("volume")],
        t.customer, "c_custkey", ["c_name"], [F.desc("volume"), F.asc("c_name")])
    return _snapshot(t, joined.select("c_name", "window_start", "volume"))


@query("stream_memory", "ST10", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def stream_memory(t):
    # five groups, so the preview on the driver has a bound
    name = new_name("preview")
    io.finish(io.to_memory(jobs.grouped_counts(_event_stream(t), ["event_type"]), name))
    return t.spark.sql(f"SELECT event_type, count FROM {name}")


def _late(t):
    """Every tenth event arrives in a second file, after the others."""
    return F.col("event_id") % 10 == 0


@query("stream_restart", "ST8", "SELECT * FROM events")
def stream_restart(t):
    source, sink, progress = (new_path(t.spark, label) for label in ("arrivals", "restarted", "stream-progress"))
    for arrived in (~_late(t), _late(t)):
        t.events.where(arrived).write.mode("append").parquet(source)
        stream = io.file_stream(t.spark, "parquet", source, t.events.schema)
        io.finish(io.to_files(stream, sink, progress))
    return t.spark.read.schema(t.events.schema).parquet(sink)


@query("stream_late_rows", "ST6", """
    WITH marks AS (SELECT max(ts) FILTER (event_id % 10 <> 0) - INTERVAL 5 MINUTE AS early,
                          max(ts) - INTERVAL 5 MINUTE AS final FROM events)
    SELECT event_type, date_trunc('minute', ts) AS window_start,
           date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS count
    FROM events, marks
    WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= final
      AND (event_id % 10 <> 0 OR date_trunc('minute', ts) + INTERVAL 1 MINUTE > early)
    GROUP BY 1, 2""")
def stream_late_rows(t):
    source, sink, progress = (new_path(t.spark, label) for label in ("arrivals", "in-time", "stream-progress"))
    for arrived in (~_late(t), _late(t)):
        t.events.where(arrived).write.mode("append").parquet(source)
        counted = _minutes(io.file_stream(t.spark, "parquet", source, t.events.schema), "5 minutes")
        io.finish(io.to_files(counted, sink, progress))
    return t.spark.read.schema(counted.schema).parquet(sink)
