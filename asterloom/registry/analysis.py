"""Reports and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import calendar_dim
from ..operators.analysis import (
    by_popularity, count_by, count_labels, count_per_member, count_values, distinct_count, look_up, pivot_counts,
    pivot_values, top,
)
from ..operators.dedup import distinct_rows, latest_by_key
from ..operators.rows import matching
from ..sources.files import code_list
from .base import query


@query("""
    SELECT dayname(ts) AS weekday, count(*) AS n FROM (SELECT DISTINCT ts FROM events) e
    GROUP BY 1 ORDER BY n DESC, weekday
""")
def plays_by_weekday(t):
    return count_by(calendar_dim(t.events, "ts"), ["weekday"]).orderBy(F.desc("n"), "weekday")


@query("SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey")
def songs_by_popularity(t):
    return by_popularity(t.lineitem, "l_partkey")


@query("""
    SELECT n_name, count(n_name) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name ORDER BY n DESC, n_name LIMIT 5
""")
def top_artists(t):
    return top(count_labels(t.supplier, "s_nationkey", t.nation, "n_nationkey", "n_name", how="inner"), 5, "n", ["n_name"])


@query("""
    SELECT c_custkey, count(o_orderkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_custkey ORDER BY n DESC, c_custkey LIMIT 5
""")
def top_users(t):
    return top(count_per_member(t.orders, "o_custkey", t.customer, "c_custkey"), 5, "n", ["c_custkey"])


@query("""
    SELECT c_custkey, c_mktsegment, count(o_orderkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'MACHINERY' GROUP BY c_custkey, c_mktsegment ORDER BY n DESC, c_custkey LIMIT 5
""")
def top_users_free(t):
    members = matching(t.customer, c_mktsegment="MACHINERY")
    return top(count_per_member(t.orders, "o_custkey", members, "c_custkey", ["c_mktsegment"]), 5, "n", ["c_custkey"])


@query("""
    SELECT country, count(country) AS n FROM customer
    LEFT JOIN (SELECT n_nationkey AS code, n_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey
               WHERE r_name <> 'ASIA') cc
    ON c_nationkey = cc.code GROUP BY country
""")
def top_countries(t):
    """Customers of countries the list lacks form the NULL group, counted 0."""
    regions = t.region.filter(F.col("r_name") != "ASIA")
    codes = t.nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).withColumnRenamed("n_name", "country")
    return count_labels(t.customer, "c_nationkey", codes, "n_nationkey", "country")


# The status codes that have a label.
STATUS_LABELS = {"F": "FILLED", "O": "OPEN"}


@query("""
    SELECT state, count(state) AS n FROM orders
    LEFT JOIN (SELECT * FROM (VALUES ('F', 'FILLED'), ('O', 'OPEN')) v(code, state)) s ON o_orderstatus = s.code
    GROUP BY state ORDER BY n DESC, state LIMIT 5
""")
def top_states(t):
    states = code_list(t.spark, STATUS_LABELS, "code string, state string")
    return top(count_labels(t.orders, "o_orderstatus", states, "code", "state"), 5, "n", ["state"])


@query("SELECT p_size AS birth_year, count(p_size) AS n FROM part GROUP BY p_size ORDER BY n DESC, birth_year LIMIT 5")
def count_by_birth_year(t):
    years = t.part.select(F.col("p_size").alias("birth_year"))
    return top(count_values(years, "birth_year"), 5, "n", ["birth_year"])


@query("""
    SELECT n_name AS country, c_mktsegment AS gender, count(c_mktsegment) AS n
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name = 'NATION_1' OR n_name = 'NATION_2' OR n_name = 'NATION_3' GROUP BY 1, 2
""")
def country_by_gender(t):
    people = t.customer.withColumnRenamed("c_mktsegment", "gender")
    codes = matching(t.nation, n_name=["NATION_1", "NATION_2", "NATION_3"]).withColumnRenamed("n_name", "country")
    return count_labels(people, "c_nationkey", codes, "n_nationkey", "country", by=["gender"], how="inner")


@query("SELECT count(DISTINCT o_orderdate) AS n_dt, count(o_orderdate) AS n FROM orders", name="distinct_count")
def distinct_dates(t):
    return distinct_count(t.orders, "o_orderdate").withColumnRenamed("n_distinct", "n_dt")


@query("""
    SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag = 'A') AS a, count(*) FILTER (WHERE l_returnflag = 'N') AS n,
           count(*) FILTER (WHERE l_returnflag = 'R') AS r
    FROM lineitem GROUP BY l_linestatus
""")
def race_pivot(t):
    return pivot_counts(t.lineitem, ["l_linestatus"], "l_returnflag", {"A": "a", "N": "n", "R": "r"})


@query("""
    SELECT c_nationkey, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building,
           count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS machinery
    FROM customer GROUP BY c_nationkey
""")
def population_pivot(t):
    """A value per group turned into columns, summed."""
    ones = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("people"))
    wide = pivot_values(ones, ["c_nationkey"], "c_mktsegment", "people", {"BUILDING": "building", "MACHINERY": "machinery"})
    return wide.na.fill(0)


@query("""
    SELECT role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role DESC, text DESC) AS rn
                            FROM conversations) t
    WHERE rn = 1 AND conv_id = 3 AND turn = 1
""")
def session_item_lookup(t):
    items = latest_by_key(t.conversations, ["conv_id", "turn"], ["role", "text"], ["role", "text"])
    return look_up(items, ["role", "text"], conv_id=3, turn=1)


@query("""
    SELECT turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role DESC, text DESC) AS rn
                                  FROM conversations) t
    WHERE rn = 1 AND conv_id = 3 ORDER BY turn
""")
def user_session_ordered(t):
    items = latest_by_key(t.conversations, ["conv_id", "turn"], ["role", "text"], ["role", "text"])
    return look_up(items, ["turn", "role", "text"], order_by=["turn"], conv_id=3)


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'signup'")
def song_listeners(t):
    listeners = distinct_rows(t.events, ["event_type", "user_id"])
    return look_up(listeners, ["user_id"], event_type="signup")
