"""Joins: fact resolution, label look-ups, integrity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import whole_truncated
from ..functions.text import md5_key
from ..operators.joins import join_on, look_up_first, orphan_keys, songs_with_artists, whole_equal
from ..operators.rows import only_page
from .base import query


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, p_partkey, p_brand
    FROM (SELECT *, 'Brand#' || CAST(l_linenumber AS VARCHAR) AS artist, l_quantity + l_discount AS length FROM lineitem) e
    LEFT JOIN part ON l_partkey = p_partkey AND artist = p_brand AND CAST(round(length) AS BIGINT) = p_size
""")
def fact_left_join_3key(t):
    plays = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat(F.lit("Brand#"), F.col("l_linenumber")).alias("artist"),
        (F.col("l_quantity") + F.col("l_discount")).alias("length"),
    )
    conditions = [
        F.col("l_partkey") == F.col("p_partkey"),
        F.col("artist") == F.col("p_brand"),
        whole_equal(F.col("length"), F.col("p_size")),
    ]
    return join_on(plays, t.part.select("p_partkey", "p_brand", "p_size"), conditions, "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_partkey", "p_brand"
    )


@query("""
    SELECT DISTINCT l_orderkey, l_partkey, p_brand FROM lineitem
    JOIN part ON l_partkey = p_partkey AND CAST(trunc(l_quantity) AS BIGINT) = p_size WHERE l_returnflag = 'R'
""")
def fact_inner_join_2key(t):
    plays = only_page(t.lineitem, "R", "l_returnflag").select("l_orderkey", "l_partkey", "l_quantity")
    conditions = [F.col("l_partkey") == F.col("p_partkey"), whole_truncated("l_quantity") == F.col("p_size")]
    return join_on(plays, t.part, conditions, "inner").select("l_orderkey", "l_partkey", "p_brand").distinct()


@query("""
    SELECT o_orderkey, o_custkey, song_id, artist_name FROM orders
    JOIN (SELECT l_orderkey, l_partkey AS song_id, p_brand AS artist_name FROM lineitem JOIN part ON l_partkey = p_partkey) d
    ON o_orderkey = l_orderkey
""")
def fact_artist_fanout(t):
    """One key, every match: an order meets each of its items."""
    songs = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("song_id"), F.col("l_partkey").alias("artist_id"))
    artists = t.part.select(F.col("p_partkey").alias("artist_id"), F.col("p_brand").alias("name"))
    catalogue = songs_with_artists(songs, artists)
    found = join_on(t.orders.select("o_orderkey", "o_custkey"), catalogue, [F.col("o_orderkey") == F.col("l_orderkey")], "inner")
    return found.select("o_orderkey", "o_custkey", "song_id", "artist_name")


@query("""
    SELECT e.l_orderkey, e.l_linenumber, d.song_id, d.artist_id
    FROM (SELECT l_orderkey, l_linenumber, l_quantity, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) e
    LEFT JOIN (SELECT p_name, p_brand, p_size, min(p_partkey) AS song_id, arg_min(p_type, p_partkey) AS artist_id
               FROM part GROUP BY p_name, p_brand, p_size) d
    ON e.p_name = d.p_name AND e.p_brand = d.p_brand AND CAST(trunc(e.l_quantity) AS BIGINT) = d.p_size
""")
def song_lookup(t):
    """First match by title, artist and length, or NULLs."""
    named = t.part.select("p_partkey", F.col("p_name").alias("song"), F.col("p_brand").alias("artist"))
    plays = t.lineitem.join(named, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", "song", "artist", whole_truncated("l_quantity").alias("length")
    )
    catalogue = t.part.select(
        F.col("p_partkey").alias("song_id"), F.col("p_type").alias("artist_id"), "p_name", "p_brand", "p_size"
    )
    on = {"song": "p_name", "artist": "p_brand", "length": "p_size"}
    return look_up_first(plays, catalogue, on, ["song_id", "artist_id"]).select(
        "l_orderkey", "l_linenumber", "song_id", "artist_id"
    )


@query("""
    SELECT c.c_custkey FROM (SELECT DISTINCT c_custkey FROM customer) c
    WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)
""")
def integrity_anti_join(t):
    return orphan_keys(t.customer, "c_custkey", t.orders.filter(F.col("o_totalprice") > 450000), "o_custkey")


@query("""
    SELECT md5(CAST(user_id AS VARCHAR) || '|' || CAST(event_id AS VARCHAR)) AS songplay_id, ts AS start_time, user_id,
           c_mktsegment AS level, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
    FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON user_id = c_custkey
    WHERE event_type = 'purchase'
""")
def star_fact(t):
    plays = only_page(t.events, "purchase", "event_type")
    users = t.customer.filter(F.col("c_acctbal") > 0).select("c_custkey", "c_mktsegment")
    return join_on(plays, users, [F.col("user_id") == F.col("c_custkey")]).select(
        md5_key(["user_id", "event_id"]).alias("songplay_id"), F.col("ts").alias("start_time"), "user_id",
        F.col("c_mktsegment").alias("level"), F.year("ts").alias("year"), F.month("ts").alias("month"),
    )
