"""Staged values, filters, casts, text and calendar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import text_to_whole, to_float, to_int, to_long, whole_rounded, whole_truncated
from ..functions.text import clean_label, split_part
from ..functions.timeparts import (
    calendar_dim, from_epoch_millis, from_epoch_seconds, from_sas_days, text_to_date, to_epoch_millis, weekday,
)
from ..operators.joins import label_or_self
from ..operators.rows import first_rows, matching, not_blank, only_page, rename_positional
from ..sources.labels import parse_value_blocks, reverse_list
from ..sources.staging import stage_json
from .base import query


@query("""
    SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def stage_events_json(t):
    return stage_json(t.events, "props", {"k": ("$.k", "int")}, keep=["event_id", "ts", "user_id", "event_type"])


@query("SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'")
def filter_page(t):
    return only_page(t.events, "purchase", "event_type").select("event_id", "user_id", "ts")


@query("SELECT doc_id, source FROM documents WHERE source IS NOT NULL AND source <> ''")
def filter_not_blank(t):
    return not_blank(t.documents, "source").select("doc_id", "source")


@query("""
    SELECT o_orderkey FROM orders
    WHERE NOT (o_orderpriority IS NULL) AND o_orderstatus = 'F' AND year(o_orderdate) = 1998
""")
def filter_combined(t):
    # The year as a range of days reaches the scan; year(...) = 1998 would not.
    in_year = (F.col("o_orderdate") >= "1998-01-01") & (F.col("o_orderdate") < "1999-01-01")
    kept = t.orders.filter(~F.col("o_orderpriority").isNull() & (F.col("o_orderstatus") == "F") & in_year)
    return kept.select("o_orderkey")


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def inspect_code(t):
    return matching(t.orders, o_orderstatus="P").select("o_orderkey", "o_custkey", "o_orderstatus")


@query("SELECT event_id, user_id FROM events WHERE value IS NOT NULL ORDER BY event_id LIMIT 5")
def explore_not_null(t):
    return first_rows(t.events.filter(F.col("value").isNotNull()).select("event_id", "user_id"), 5, ["event_id"])


@query("SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS admin_num FROM orders")
def cast_long(t):
    return t.orders.select("o_orderkey", to_long("o_totalprice").alias("admin_num"))


@query("""
    SELECT l_orderkey, l_linenumber,
           CAST(trunc(l_extendedprice) AS INTEGER) AS as_int,
           CAST(l_quantity AS FLOAT) AS as_float,
           CAST(round(l_quantity + l_discount) AS BIGINT) AS rounded,
           CAST(trunc(l_quantity + l_discount) AS BIGINT) AS truncated,
           CAST(trunc(l_quantity) AS BIGINT) AS from_text
    FROM lineitem
""")
def cast_kinds(t):
    length = F.col("l_quantity") + F.col("l_discount")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        to_int("l_extendedprice").alias("as_int"),
        to_float("l_quantity").alias("as_float"),
        whole_rounded(length).cast("bigint").alias("rounded"),
        whole_truncated(length).alias("truncated"),
        text_to_whole(F.col("l_quantity").cast("string")).alias("from_text"),
    )


@query("""
    SELECT CAST(s_suppkey AS INTEGER) AS cic_id, s_name AS name, 'United States' AS country FROM supplier
""")
def rename_lit_cast(t):
    renamed = rename_positional(t.supplier.drop("s_nationkey"), ["cic_id", "name"]).drop("s_acctbal")
    return renamed.withColumns({"cic_id": to_int("cic_id"), "country": F.lit("United States")})


@query("""
    SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS FLOAT) AS num, split_part(c_name, '#', 1) AS pre
    FROM customer
""")
def split_and_cast(t):
    return t.customer.select(
        "c_custkey", to_float(split_part("c_name", "#", 1)).alias("num"), split_part("c_name", "#", 0).alias("pre")
    )


@query("SELECT p_partkey, upper(p_name) AS city FROM part")
def upper_city(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("city"))


@query("SELECT p_partkey, trim(replace(concat('''', p_name, '      '''), '''', '')) AS label FROM part")
def label_trim(t):
    padded = F.concat(F.lit("'"), F.col("p_name"), F.lit("      '"))
    return t.part.select("p_partkey", clean_label(padded).alias("label"))


@query("""
    SELECT CAST(regexp_extract(l, '^\\s*(\\d+)', 1) AS INTEGER) AS code,
           regexp_extract(l, '=\\s*''([^'']*)''', 1) AS label
    FROM (SELECT '   ' || p_partkey || ' =  ''' || p_name || '''' AS l FROM part) t
""")
def label_lines_parse(t):
    # Each part as a format script of its own.
    script = F.format_string("/* list */\n  value parts\n   %d =  '%s' ;\n", "p_partkey", "p_name")
    parsed = parse_value_blocks(t.part.select(script.alias("value")))
    return parsed.select(to_int("code").alias("code"), "label")


@query("""
    SELECT c_custkey, coalesce(m.code, n_name) AS city_code
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (
        SELECT n_name AS name, CAST(max(n_nationkey) AS VARCHAR) AS code
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'EUROPE') GROUP BY n_name
    ) m ON n_name = m.name
""")
def reverse_code_lookup(t):
    listed = t.nation.join(matching(t.region, r_name=["AMERICA", "EUROPE"]), F.col("n_regionkey") == F.col("r_regionkey"))
    labels = listed.select(F.concat("n_name", F.lit(", "), "r_name").alias("label"), F.col("n_nationkey").alias("code"))
    cities = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    coded = label_or_self(cities, "n_name", reverse_list(labels, "label", "code"), "name", "code", "city_code")
    return coded.select("c_custkey", "city_code")


@query("""
    SELECT DISTINCT ts AS start_time, CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
           CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
           CAST(year(ts) AS INTEGER) AS year, dayname(ts) AS weekday
    FROM events
""")
def time_dim_name(t):
    return calendar_dim(t.events, "ts")


@query("""
    SELECT event_id, CAST(dayofweek(ts) AS INTEGER) AS dow0, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow1 FROM events
""")
def time_dim_numeric(t):
    return t.events.select("event_id", weekday("ts", "sun0").alias("dow0"), weekday("ts", "sun1").alias("dow1"))


@query("""
    SELECT event_id, epoch_us(ts) // 1000 AS ms,
           make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS start_time,
           make_timestamp((epoch_us(ts) // 1000) * 1000) AS exact_time
    FROM events
""")
def epoch_roundtrip(t):
    stored = t.events.select("event_id", to_epoch_millis("ts").alias("ms"))
    return stored.withColumns({"start_time": from_epoch_seconds("ms"), "exact_time": from_epoch_millis("ms")})


@query("""
    SELECT o_orderkey,
           CAST(DATE '1960-01-01' + CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)
                AS DATE) AS d
    FROM orders
""")
def sas_date(t):
    # Day numbers arrive as doubles.
    days = F.datediff("o_orderdate", F.to_date(F.lit("1960-01-01"))).cast("double").alias("days")
    return t.orders.select("o_orderkey", days).select("o_orderkey", from_sas_days("days").alias("d"))


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS dt FROM orders")
def string_to_date(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"))
    return text.withColumn("dt", text_to_date("dt"))
