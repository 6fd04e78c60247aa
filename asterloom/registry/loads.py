"""Sinks: tables are really written, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.analysis import count_by
from ..operators.quality import require_schema, row_counts
from ..operators.upsert import reduce_upserts
from ..schemas import TableSpec, schema_of
from ..scratch import scratch_path
from ..session import estimated_bytes, shuffle_partitions
from ..sinks.catalog import drop_tables, reset_tables, write_bucketed
from ..sinks.files import copy_tables, insert_new, insert_positional, load_table, upsert_table, write_table
from ..sources.files import read_table, read_tables
from .base import query

_LEVELS = TableSpec("levels", schema_of("user_id bigint, level string"), key=("user_id",))


def _levels(t):
    return t.events.select("user_id", F.col("event_type").alias("level"))


@query("SELECT DISTINCT user_id, event_type AS level FROM events")
def truncate_insert_reload(t):
    """A second load into the same dimension replaces the first."""
    root = scratch_path(t.spark, "reload")
    write_table(_levels(t), _LEVELS, root)
    load_table(t.spark, _LEVELS, root, _levels(t).distinct(), truncate=True)
    return read_table(t.spark, _LEVELS, root)


@query("SELECT user_id, event_type AS level FROM events UNION ALL SELECT user_id, event_type AS level FROM events")
def append_load(t):
    """A second load into a fact adds to the first."""
    root = scratch_path(t.spark, "append")
    for _ in range(2):
        load_table(t.spark, _LEVELS, root, _levels(t))
    return read_table(t.spark, _LEVELS, root)


@query("SELECT user_id, event_type AS level FROM events WHERE event_type <> 'error'")
def load_from_sql(t):
    """A table filled by SQL text, emptied first."""
    root, view = scratch_path(t.spark, "from-sql"), f"staged_{uuid.uuid4().hex}"
    t.events.createOrReplaceTempView(view)
    write_table(_levels(t), _LEVELS, root)
    text = f"SELECT user_id, event_type AS level FROM {view} WHERE event_type <> 'error'"
    load_table(t.spark, _LEVELS, root, text, truncate=True)
    t.spark.catalog.dropTempView(view)
    return read_table(t.spark, _LEVELS, root)


_USERS = TableSpec("members", schema_of("user_id bigint, first_type string, level string"), key=("user_id",))
_CUT = "2024-01-16"


@query("""
    SELECT f.user_id, f.event_type AS first_type, l.event_type AS level FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) f
    JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) l
    ON f.user_id = l.user_id AND f.rn = 1 AND l.rn = 1
""")
def upsert_stored_table(t):
    """Two batches, by date, upserted one after the other into a stored table."""
    root = scratch_path(t.spark, "upsert")
    rows = t.events.select(
        "user_id", F.col("event_type").alias("first_type"), F.col("event_type").alias("level"), "ts", "event_id"
    )
    cut = F.lit(_CUT).cast("timestamp_ntz")
    first, second = rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut)
    write_table(reduce_upserts(first, ["user_id"], ["ts", "event_id"], ["level"]), _USERS, root)
    upsert_table(second, _USERS, root, ["ts", "event_id"], ["level"])
    return read_table(t.spark, _USERS, root)


@query("""
    SELECT user_id, event_type AS level
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) t WHERE rn = 1
""")
def insert_new_stored(t):
    """Two batches, by date, of which only keys not stored yet are added."""
    root = scratch_path(t.spark, "insert-new")
    rows = t.events.select("user_id", F.col("event_type").alias("level"), "ts", "event_id")
    cut = F.lit(_CUT).cast("timestamp_ntz")
    write_table(t.spark.createDataFrame([], _LEVELS.schema), _LEVELS, root)
    for batch in (rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut)):
        insert_new(batch, _LEVELS, root, ["ts", "event_id"])
    return read_table(t.spark, _LEVELS, root)


_DAILY = TableSpec(
    "daily_levels", schema_of("user_id bigint, first_id bigint, level string, day date"), key=("day", "user_id"), partition_by=("day",)
)


@query("""
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_id, arg_max(event_type, (ts, event_id)) AS level,
           CAST(ts AS DATE) AS day
    FROM events GROUP BY user_id, CAST(ts AS DATE)
""")
def upsert_touched_partitions(t):
    """Two batches, by time of a day in the middle; the second rewrites its days only."""
    root = scratch_path(t.spark, "upsert-days")
    rows = t.events.select(
        "user_id", F.col("event_id").alias("first_id"), F.col("event_type").alias("level"), F.col("ts").cast("date").alias("day"),
        "ts", "event_id",
    )
    noon = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    write_table(t.spark.createDataFrame([], _DAILY.schema), _DAILY, root)
    for batch in (rows.filter(F.col("ts") < noon), rows.filter(F.col("ts") >= noon)):
        upsert_table(batch, _DAILY, root, ["ts", "event_id"], ["level"])
    return read_table(t.spark, _DAILY, root)


_TYPED = TableSpec(
    "typed_orders",
    schema_of("order_id int, placed date, whole_price decimal(18,0), status string, note string"),
    not_null=("order_id",),
)


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_orderdate AS DATE) AS placed,
           CAST(round(o_totalprice) AS BIGINT) AS whole_price, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS note
    FROM orders
""")
def typed_insert(t):
    """Insert by position into a table of declared types; the unlisted column stays NULL."""
    root = scratch_path(t.spark, "typed")
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    insert_positional(rows, ["order_id", "placed", "whole_price", "status"], _TYPED, root)
    stored = read_table(t.spark, _TYPED, root)
    require_schema(stored, _TYPED.name, _TYPED.schema)
    return stored.withColumn("whole_price", F.col("whole_price").cast("bigint"))


_SUPPLIERS = TableSpec("suppliers", schema_of("s_suppkey bigint, s_name string, s_nationkey int"), partition_by=("s_nationkey",))


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def create_reset_tables(t):
    """Create, fill, reset and fill again a catalog table."""
    root, prefix = scratch_path(t.spark, "catalog"), f"c{uuid.uuid4().hex}_"
    for _ in range(2):
        reset_tables(t.spark, [_SUPPLIERS], root, prefix)
        t.supplier.select(_SUPPLIERS.schema.fieldNames()).write.insertInto(prefix + _SUPPLIERS.name)
    drop_tables(t.spark, [_SUPPLIERS], prefix)
    return read_table(t.spark, _SUPPLIERS, root)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def bucketed_count(t):
    """Orders bucketed by customer: the count by customer needs no shuffle."""
    name = f"bucketed_{uuid.uuid4().hex}"
    stored = write_bucketed(
        t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), name, scratch_path(t.spark, "bucketed"),
        ["o_custkey"], shuffle_partitions(t.spark, estimated_bytes(t.orders)), ["o_custkey", "o_orderdate"],
    )
    return count_by(stored, ["o_custkey"])


_COPIED = (
    TableSpec("customer", schema_of("c_custkey bigint, c_name string, c_mktsegment string"), partition_by=("c_mktsegment",)),
    TableSpec("part", schema_of("p_partkey bigint, p_name string, p_size int"), cluster_by=("p_partkey",)),
    TableSpec("supplier", schema_of("s_suppkey bigint, s_name string")),
)


@query("""
    SELECT 'customer' AS tbl, count(*) AS n, count(*) > 0 AS ok FROM customer
    UNION ALL SELECT 'part', count(*), count(*) > 0 FROM part
    UNION ALL SELECT 'supplier', count(*), count(*) > 0 FROM supplier
""")
def copy_all_tables(t):
    """Every declared table copied to another root in its layout, then counted there."""
    source, target = scratch_path(t.spark, "source"), scratch_path(t.spark, "target")
    for spec in _COPIED:
        write_table(getattr(t, spec.name), spec, source)
    copy_tables(t.spark, _COPIED, source, target)
    return row_counts(read_tables(t.spark, _COPIED, target))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def copied_rows(t):
    """The rows of a partitioned table after the copy."""
    source, target = scratch_path(t.spark, "source"), scratch_path(t.spark, "target")
    write_table(t.customer, _COPIED[0], source)
    copy_tables(t.spark, _COPIED[:1], source, target)
    return read_table(t.spark, _COPIED[0], target)


_STAGED = TableSpec("staged_events", schema_of("event_id bigint, user_id bigint, event_type string"))


@query("SELECT event_id, user_id, event_type FROM events")
def clear_then_stage(t):
    """Staging is emptied before each load: what an earlier run left is gone."""
    root = scratch_path(t.spark, "staging")
    write_table(t.events.filter(F.col("event_type") == "error"), _STAGED, root)
    write_table(t.events, _STAGED, root)
    return read_table(t.spark, _STAGED, root)
