"""Streaming writes over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import changes
from tablewright.operators.changes import open_table
from tablewright.plans.registry import query
from tablewright.session import scratch_path
from tablewright.sources.tables import load
from tablewright.streaming.writes import append_stream, batch_counts, publish_stream, read_files

_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def _stream(spark, sf):
    return read_files(spark, f"{sf}/events.parquet", load(spark, sf, "events").schema)


@query("stream_append_default", _EVENTS)
def stream_append_default(spark, sf):
    path = scratch_path(spark, "stream")
    append_stream(_stream(spark, sf), f"{path}/table", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/table")


@query("stream_publish_pending", _EVENTS)
def stream_publish_pending(spark, sf):
    path = scratch_path(spark, "stream")
    publish_stream(_stream(spark, sf), f"{path}/table", f"{path}/checkpoint")
    return open_table(spark, f"{path}/table")


@query(
    "stream_beside_batch",
    "SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_type = 'view' THEN NULL ELSE props END AS props FROM events",
)
def stream_beside_batch(spark, sf):
    """Rows appended as a batch, then by a stream without one of the columns, then by another run."""
    path, events = scratch_path(spark, "stream"), load(spark, sf, "events")
    changes.append(events.where("event_type = 'purchase'"), f"{path}/table")
    stream = _stream(spark, sf)
    append_stream(stream.where("event_type = 'view'").drop("props"), f"{path}/table", f"{path}/views")
    append_stream(stream.where("event_type NOT IN ('view', 'purchase')"), f"{path}/table", f"{path}/others")
    return spark.read.parquet(f"{path}/table")


@query(
    "stream_run_stats",
    "SELECT CASE WHEN event_type = 'view' THEN 'views' ELSE 'others' END AS run, 0::BIGINT AS batch_id, count(*) AS rows_written "
    "FROM events WHERE event_type <> 'purchase' GROUP BY 1",
)
def stream_run_stats(spark, sf):
    """Rows of each batch of each named run in a table that also holds rows published as a batch."""
    path, events = scratch_path(spark, "stream"), load(spark, sf, "events")
    changes.publish(events.where("event_type = 'purchase'"), f"{path}/table")
    stream = _stream(spark, sf)
    append_stream(stream.where("event_type = 'view'"), f"{path}/table", f"{path}/views", run="views")
    append_stream(stream.where("event_type NOT IN ('view', 'purchase')"), f"{path}/table", f"{path}/others", run="others")
    return batch_counts(spark, f"{path}/table", ["views", "others"])


@query("stream_write_stats", "SELECT count(*) AS rows_written FROM events")
def stream_write_stats(spark, sf):
    path = scratch_path(spark, "stream")
    publish_stream(_stream(spark, sf), f"{path}/table", f"{path}/checkpoint")
    return batch_counts(spark, f"{path}/table").agg(F.sum("rows_written").alias("rows_written"))
