from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from asterloom.schemas import TableSpec, schema_of
from asterloom.sinks.files import upsert_table, write_table
from asterloom.sources.files import read_table
from asterloom.streaming import ingest

from .conftest import rows

SCHEMA = schema_of("id bigint, ts timestamp_ntz, user bigint, level string")


def arrive(local, name, *events):
    (local / "in").mkdir(exist_ok=True)
    lines = [json.dumps({"id": i, "ts": ts, "user": u, "level": lv}) for i, ts, u, lv in events]
    (local / "in" / f"{name}.json").write_text("\n".join(lines) + "\n")


DAYS = TableSpec("days", schema_of("id bigint, level string, day date"), key=("day", "id"), partition_by=("day",))


def run(spark, folder):
    session = ingest.stream_session(spark, 0)
    stream = ingest.stream_files(session, f"{folder}/in", SCHEMA, "json", glob="*.json", files_per_batch=1)
    days = stream.select("id", "level", F.col("ts").cast("date").alias("day"))
    ingest.insert_stream(days, DAYS, folder, f"{folder}/state", ["level"])
    return read_table(spark, DAYS, folder)


def test_new_files_are_loaded_once_without_repeats(spark, folder, local):
    arrive(local, "a", (1, "2018-11-01T10:00:00", 7, "free"), (2, "2018-11-01T10:30:00", 7, "paid"), (1, "2018-11-01T10:00:00", 7, "free"))
    assert rows(run(spark, folder).select("id")) == [(1,), (2,)]
    # The second run sees only the new file; id 2 is a repeat, id 3 a bit late.
    arrive(local, "b", (2, "2018-11-01T10:30:00", 7, "paid"), (3, "2018-11-01T09:30:00", 8, "free"))
    assert rows(run(spark, folder).select("id")) == [(1,), (2,), (3,)]
    assert rows(run(spark, folder).select("id")) == [(1,), (2,), (3,)]


def test_no_row_is_too_late_however_many_batches_follow(spark, folder, local):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        arrive(local, "a", (1, "2018-11-20T10:00:00", 7, "free"))
        arrive(local, "b", (2, "2017-01-01T10:00:00", 7, "free"))
        for k in range(3, 7):
            arrive(local, f"c{k}", (k, f"2018-12-0{k}T10:00:00", 7, "free"))
        assert rows(run(spark, folder).select("id")) == [(k,) for k in range(1, 7)]
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


USERS = TableSpec("users", schema_of("user bigint, level string"), key=("user",))


def test_batches_are_upserted(spark, folder, local):
    def load():
        session = ingest.stream_session(spark, 0)
        stream = ingest.stream_files(session, f"{folder}/in", SCHEMA, "json", files_per_batch=1)
        ingest.upsert_stream(stream, USERS, folder, f"{folder}/state", ["ts", "id"], ["level"])
        return rows(read_table(spark, USERS, folder))

    arrive(local, "a", (1, "2018-11-01T10:00:00", 7, "paid"), (2, "2018-11-01T09:00:00", 7, "free"), (3, "2018-11-01T09:00:00", 8, "free"))
    assert load() == [(7, "paid"), (8, "free")]
    arrive(local, "b", (4, "2018-11-02T10:00:00", 8, "paid"), (5, "2018-11-02T10:00:00", 9, "free"))
    assert load() == [(7, "paid"), (8, "paid"), (9, "free")]
    assert load() == [(7, "paid"), (8, "paid"), (9, "free")]


def test_a_run_lost_while_overwriting_is_made_good(spark, folder):
    def users(*values):
        return spark.createDataFrame(list(values), "user bigint, level string, ts int")

    write_table(users((1, "free", 0), (2, "free", 0)), USERS, folder)
    batch, staged = users((2, "paid", 1)), f"{folder}/merged/0"
    upsert_table(batch, USERS, folder, ["ts"], ["level"], staged)
    # As if the overwrite had stopped half way.
    write_table(users((2, "paid", 0)), USERS, folder)
    upsert_table(batch, USERS, folder, ["ts"], ["level"], staged)
    assert rows(read_table(spark, USERS, folder)) == [(1, "free"), (2, "paid")]


def test_late_rows_are_inserted_without_a_watermark(spark, folder, local):
    spec = TableSpec("events", SCHEMA, key=("id",))

    def load():
        stream = ingest.stream_files(ingest.stream_session(spark, 0), f"{folder}/in", SCHEMA, "json", files_per_batch=1)
        ingest.insert_stream(stream, spec, folder, f"{folder}/state", ["ts"])
        return rows(read_table(spark, spec, folder).select("id", "level"))

    arrive(local, "a", (1, "2018-11-02T10:00:00", 7, "free"), (1, "2018-11-02T10:00:00", 7, "free"))
    assert load() == [(1, "free")]
    arrive(local, "b", (1, "2018-11-02T10:00:00", 7, "other"), (2, "2017-01-01T00:00:00", "8", "paid"))
    assert load() == [(1, "free"), (2, "paid")]


def test_stream_keeps_the_callers_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = ingest.stream_session(spark, 10**12)
    assert int(session.conf.get("spark.sql.shuffle.partitions")) > 1000
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert dt.datetime  # zone stays the caller's
    assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
