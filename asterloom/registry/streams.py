"""Incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.analysis import count_by
from ..schemas import TableSpec, schema_of
from ..scratch import scratch_path
from ..session import estimated_bytes
from ..sources.files import read_table
from ..streaming.ingest import (
    insert_stream, stream_files, stream_session, upsert_stream,
)
from .base import query


def _stream(t):
    session = stream_session(t.spark, estimated_bytes(t.events))
    # As a glob the path may be one file or a folder of them.
    return stream_files(session, t.path("event[s]"), t.events.schema, "parquet")


_DAYS = TableSpec(
    "day_events", schema_of("event_id bigint, event_type string, day date"), key=("day", "event_id"), partition_by=("day",)
)


@query("SELECT CAST(ts AS DATE) AS d, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def daily_counts_stream(t):
    """Stream in, add what the stored day lacks, however late, count what is stored."""
    root = scratch_path(t.spark, "streamed")
    stream = _stream(t).select("event_id", "event_type", F.col("ts").cast("date").alias("day"))
    insert_stream(stream, _DAYS, root, scratch_path(t.spark, "streamed-state"), ["event_type"])
    stored = read_table(t.spark, _DAYS, root)
    return count_by(stored.select(F.col("day").alias("d"), "event_type"), ["d", "event_type"])


_EVENTS = TableSpec(
    "events", schema_of("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"), key=("event_id",)
)


@query("SELECT event_id, ts, user_id, event_type FROM events")
def insert_events_stream(t):
    """New events added by key, twice the same stream: the second adds nothing."""
    root = scratch_path(t.spark, "stream-insert")
    rows = _stream(t).select(_EVENTS.schema.fieldNames())
    for _ in range(2):
        insert_stream(rows, _EVENTS, root, scratch_path(t.spark, "stream-insert-state"), ["ts"])
    return read_table(t.spark, _EVENTS, root)


_USERS = TableSpec("users", schema_of("user_id bigint, first_type string, level string"), key=("user_id",))


@query("""
    SELECT f.user_id, f.event_type AS first_type, l.event_type AS level FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) f
    JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) l
    ON f.user_id = l.user_id AND f.rn = 1 AND l.rn = 1
""")
def upsert_users_stream(t):
    """Every batch of the stream upserted into the stored users."""
    root = scratch_path(t.spark, "stream-upsert")
    rows = _stream(t).select(
        "user_id", F.col("event_type").alias("first_type"), F.col("event_type").alias("level"), "ts", "event_id"
    )
    upsert_stream(rows, _USERS, root, scratch_path(t.spark, "stream-upsert-state"), ["ts", "event_id"], ["level"])
    return read_table(t.spark, _USERS, root)
