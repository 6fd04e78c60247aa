"""Dedup, conflict rules and generated keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import md5_key
from ..operators.dedup import distinct_rows, drop_full_duplicates, earliest_by_key, latest_by_key
from ..operators.keys import identity_key, monotonic_key
from ..operators.rows import has_key
from ..operators.upsert import insert_ignore, reduce_upserts, replace_rows, upsert
from .base import query

CUT = "2024-01-16"  # the first batch ends before this day


def _cut():
    return F.lit(CUT).cast("timestamp_ntz")


@query("SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events) u")
def full_row_dedup(t):
    return drop_full_duplicates(t.events.unionAll(t.events))


@query("SELECT DISTINCT user_id, event_type AS level FROM events WHERE user_id IS NOT NULL")
def dim_users_distinct(t):
    named = has_key(t.events, "user_id").withColumnRenamed("event_type", "level")
    return distinct_rows(named, ["user_id", "level"])


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(t):
    return distinct_rows(t.orders, ["o_orderpriority"])


@query("""
    SELECT user_id, event_type AS level
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) t WHERE rn = 1
""")
def dim_insert_ignore(t):
    first = earliest_by_key(t.events, ["user_id"], ["ts", "event_id"], ["event_type"])
    return first.withColumnRenamed("event_type", "level")


@query("""
    SELECT user_id, level, event_id
    FROM (SELECT user_id, event_type AS level, event_id, ts,
                 row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) t
    WHERE rn = 1 AND ts >= TIMESTAMP '2024-01-03 00:00:00'
""")
def insert_ignore_into_target(t):
    """What a second batch adds to the (user, level) pairs of the first."""
    rows = t.events.withColumnRenamed("event_type", "level")
    cut, key, order = F.lit("2024-01-03").cast("timestamp_ntz"), ["user_id", "level"], ["ts", "event_id"]
    stored = earliest_by_key(rows.filter(F.col("ts") < cut), key, order, ["event_id"])
    return insert_ignore(stored, rows.filter(F.col("ts") >= cut), key, order)


_FIRST_LAST = """
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) f
    JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) l
    ON f.user_id = l.user_id AND f.rn = 1 AND l.rn = 1
"""


@query(f"SELECT f.user_id, f.event_type AS first_type, l.event_type AS level FROM {_FIRST_LAST}")
def dim_upsert_level(t):
    rows = t.events.select("user_id", F.col("event_type").alias("first_type"), F.col("event_type").alias("level"), "ts", "event_id")
    reduced = reduce_upserts(rows, ["user_id"], ["ts", "event_id"], ["level"])
    return reduced.select("user_id", "first_type", "level")


@query(f"""
    SELECT f.user_id, f.event_type AS name, l.value AS latitude, l.props AS location FROM {_FIRST_LAST}
""")
def dim_upsert_multi(t):
    rows = t.events.select(
        "user_id", F.col("event_type").alias("name"), F.col("value").alias("latitude"),
        F.col("props").alias("location"), "ts", "event_id",
    )
    reduced = reduce_upserts(rows, ["user_id"], ["ts", "event_id"], ["latitude", "location"])
    return reduced.select("user_id", "name", "latitude", "location")


_BATCHES = f"""
    (SELECT user_id, event_type AS level, value AS score FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events WHERE ts < TIMESTAMP '{CUT} 00:00:00' AND event_type <> 'error') a WHERE rn = 1) t
    FULL OUTER JOIN
    (SELECT user_id, event_type AS level, value AS score FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
       FROM events WHERE ts >= TIMESTAMP '{CUT} 00:00:00') b WHERE rn = 1) u
    ON t.user_id = u.user_id
"""


def _two_batches(t):
    users = t.events.select("user_id", F.col("event_type").alias("level"), F.col("value").alias("score"), "ts", "event_id")
    old = users.filter((F.col("ts") < _cut()) & (F.col("level") != "error"))
    stored = latest_by_key(old, ["user_id"], ["ts", "event_id"], ["level", "score"])
    return stored, users.filter(F.col("ts") >= _cut())


@query(f"""
    SELECT coalesce(t.user_id, u.user_id) AS user_id, coalesce(u.level, t.level) AS level,
           coalesce(u.score, t.score) AS score
    FROM {_BATCHES}
""")
def merge_into_target(t):
    """Last write wins on every column."""
    stored, batch = _two_batches(t)
    return replace_rows(stored, batch, ["user_id"], ["ts", "event_id"])


@query(f"""
    SELECT f.user_id, coalesce(f.old_score, f.first_score) AS score, f.level FROM (
      SELECT coalesce(t.user_id, u.user_id) AS user_id, coalesce(u.level, t.level) AS level, t.score AS old_score,
             g.value AS first_score
      FROM {_BATCHES}
      LEFT JOIN (SELECT user_id AS gid, value FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
         FROM events WHERE ts >= TIMESTAMP '{CUT} 00:00:00') c WHERE rn = 1) g ON g.gid = u.user_id
    ) f
""")
def merge_one_column(t):
    """Only `level` is updated; a stored score stays, a new key brings its first."""
    stored, batch = _two_batches(t)
    return upsert(stored, batch, ["user_id"], ["ts", "event_id"], ["level"])


@query("""
    SELECT conv_id AS session_id, turn AS item_in_session, role, text
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text) AS rn FROM conversations) t
    WHERE rn = 1
""")
def session_items(t):
    rows = t.conversations.select(F.col("conv_id").alias("session_id"), F.col("turn").alias("item_in_session"), "role", "text")
    return earliest_by_key(rows, ["session_id", "item_in_session"], ["role", "text"], ["role", "text"])


@query("SELECT md5(CAST(user_id AS VARCHAR) || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS songplay_id, event_id FROM events")
def fact_md5_key(t):
    second = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select(md5_key(["user_id", second], sep="", null_safe=False).alias("songplay_id"), "event_id")


@query("""
    SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS BIGINT) AS sk, o_orderkey FROM orders
""")
def identity_key_by_date(t):
    return identity_key(t.orders.select("o_orderkey", "o_orderdate"), "sk", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS sk, c_custkey FROM customer", name="identity_key")
def identity_key_of_customers(t):
    return identity_key(t.customer.select("c_custkey"), "sk", ["c_custkey"])


@query("SELECT count(*) AS n, count(*) AS n_ids FROM orders")
def monotonic_ids(t):
    """The ids themselves differ from run to run; that they are unique does not."""
    return monotonic_key(t.orders, "id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"))
