"""Tables of whole loads, one query each: written, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import to_epoch_millis
from ..plans import arrivals, music
from ..schemas import ARTISTS, DIM_POPULATION, SONGS, TIME, USERS
from ..scratch import materialise, scratch_path
from ..sinks.files import write_table
from ..sources.files import read_csv, read_table
from .base import query
from .stars import _arrivals, _catalogue, _log, airport_dim, write_raw


def _stored(t, spec, rows):
    root = scratch_path(t.spark, "loaded")
    write_table(rows, spec, root, unique=True)
    return read_table(t.spark, spec, root)


def _staged_log(t):
    """The log through raw JSON files."""
    root = scratch_path(t.spark, "raw-log")
    write_raw(_log(t), root)
    return materialise(music.stage_log(t.spark, root, page=music.PLAY_PAGE), "staged-log")


def _staged_catalogue(t):
    root = scratch_path(t.spark, "raw-catalogue")
    write_raw(_catalogue(t), root)
    return materialise(music.stage_catalogue(t.spark, root), "staged-catalogue")


@query("""
    SELECT CAST(l_suppkey AS INTEGER) AS user_id, 'first ' || CAST(l_suppkey AS VARCHAR) AS first_name,
           'last ' || CAST(l_suppkey AS VARCHAR) AS last_name, 'F' AS gender,
           arg_max(CASE WHEN l_linestatus = 'F' THEN 'free' ELSE 'paid' END, (l_shipdate, l_orderkey, l_linenumber)) AS level
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey
""")
def star_users(t):
    """Users with their last level, from raw JSON logs to the stored table."""
    return _stored(t, USERS, music.users_dim(_staged_log(t)))


@query("""
    SELECT DISTINCT l_shipdate AS start_time, CAST(hour(l_shipdate) AS INTEGER) AS hour, CAST(day(l_shipdate) AS INTEGER) AS day,
           CAST(week(l_shipdate) AS INTEGER) AS week, dayname(l_shipdate) AS weekday,
           CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
    FROM lineitem WHERE l_returnflag = 'R'
""")
def star_time(t):
    """The calendar of play times, stored by year and month."""
    return _stored(t, TIME, music.time_dim(_staged_log(t)))


_SONGS_SQL = """
    SELECT format('S{:012d}', p_partkey) AS song_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS title,
           p_brand AS artist_id, CAST(p_size AS DOUBLE) AS duration, CAST(0 AS INTEGER) AS year
    FROM part
"""


@query(_SONGS_SQL)
def star_songs(t):
    """Songs from raw catalogue files, stored by year."""
    stored = _stored(t, SONGS, music.songs_dim(_staged_catalogue(t)))
    return stored.withColumn("duration", F.col("duration").cast("double"))


@query("""
    SELECT p_brand AS artist_id, 'The ' || p_brand AS name, arg_max(p_type, p_partkey) AS location,
           CAST(NULL AS DOUBLE) AS latitude, arg_max(p_retailprice, p_partkey) AS longitude
    FROM part GROUP BY p_brand
""")
def star_artists(t):
    """Artists with their last place, from raw catalogue files to the stored table."""
    return _stored(t, ARTISTS, music.artists_dim(_staged_catalogue(t)))


@query(_SONGS_SQL)
def songs_distinct(t):
    """Distinct song rows of a catalogue staged twice."""
    return music.songs_distinct(_catalogue(t).unionAll(_catalogue(t)))


@query("""
    SELECT DISTINCT p_brand AS artist_id, 'The ' || p_brand AS name, p_type AS location,
           CAST(NULL AS DOUBLE) AS latitude, p_retailprice AS longitude
    FROM part
""")
def artists_distinct(t):
    """Distinct artist rows: one for each place an artist was told with."""
    return music.artists_distinct(_catalogue(t))


@query("""
    SELECT CAST(min(l_suppkey) AS INTEGER) AS user_id, l_shipdate AS start_time, CAST(l_orderkey AS INTEGER) AS session_id
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_shipdate, l_orderkey, l_linenumber
""")
def star_reload(t):
    """The whole star loaded twice from raw files, with its checks: one play per key, and the second load adds nothing."""
    root = scratch_path(t.spark, "reload-star")
    write_raw(_log(t), f"{root}/raw/log")
    write_raw(_catalogue(t), f"{root}/raw/catalogue")
    for _ in range(2):
        star = music.load_star(t.spark, f"{root}/raw/log", f"{root}/raw/catalogue", f"{root}/star", append_fact=True)
    return star["songplays"].select("user_id", "start_time", "session_id")


@query("""
    SELECT CAST(user_id AS INTEGER) AS session_id, date_trunc('second', ts) AS start_time, count(*) AS n
    FROM events GROUP BY 1, 2
""")
def fact_whole_seconds(t):
    """Events as plays on whole seconds, a session per user: plays per key."""
    log = t.events.select(
        F.lit(None).cast("string").alias("artist"), F.lit(None).cast("string").alias("song"),
        F.lit(None).cast("double").alias("length"), F.lit(None).cast("string").alias("location"),
        F.col("event_type").alias("level"), F.col("event_type").alias("userAgent"), F.lit(music.PLAY_PAGE).alias("page"),
        F.col("user_id").cast("int").alias("userId"), F.col("user_id").cast("int").alias("sessionId"),
        F.col("event_id").cast("int").alias("itemInSession"), to_epoch_millis("ts").alias("ts"),
    )
    fact = music.songplays_fact(log, _catalogue(t), whole_seconds=True)
    return fact.groupBy("songplay_id", "session_id", "start_time").agg(F.count(F.lit(1)).alias("n")).drop("songplay_id")


_STATES = """
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_code, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def _demographics(t):
    """Customers as cities, their nations as states."""
    columns = {name: F.lit("x") for name in arrivals.DEMOGRAPHICS_RAW.fieldNames()}
    columns.update({
        "City": F.col("c_name"), "State Code": F.format_string("%02d", "c_nationkey"),
        "Male Population": F.col("c_custkey"), "Race": F.col("c_mktsegment"),
    })
    places = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return places.select("r_name", *[c.cast("string").alias(name) for name, c in columns.items()])


@query(f"""
    SELECT DISTINCT c_name AS city, CAST(c_custkey AS VARCHAR) AS male_pop, 'x' AS female_pop, 'x' AS num_vetarans,
           'x' AS foreign_born, c_mktsegment AS race, state_code
    FROM ({_STATES}) c
""")
def population_dim(t):
    """Population per city and race from a semicolon file, stored by state."""
    root = scratch_path(t.spark, "population")
    _demographics(t).drop("r_name").write.option("header", True).option("sep", ";").csv(root)
    raw = read_csv(t.spark, root, arrivals.DEMOGRAPHICS_RAW, sep=";")
    return _stored(t, DIM_POPULATION, arrivals.dim_population(raw)).drop("pop_id")


@query(f"""
    WITH fact AS (
        SELECT DISTINCT substr(o_orderpriority, 1, 1) AS port,
               CASE WHEN o_orderstatus <> 'P' THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS state_code
        FROM orders JOIN customer ON o_custkey = c_custkey
    ), places AS (SELECT * FROM ({_STATES}) c)
    SELECT 'airline' AS "check", CAST(0 AS BIGINT) AS n UNION ALL SELECT 'personal', 0
    UNION ALL SELECT 'airports', count(DISTINCT port) FROM fact WHERE port NOT IN (
        SELECT CAST(s_suppkey AS VARCHAR) FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'ASIA'))
    UNION ALL SELECT 'population', count(*) FROM (SELECT DISTINCT state_code FROM fact) f
        WHERE NOT EXISTS (SELECT 1 FROM places p WHERE p.state_code = f.state_code AND r_name = 'ASIA')
    UNION ALL SELECT 'statistics', count(*) FROM (SELECT DISTINCT state_code FROM fact) f
        WHERE NOT EXISTS (SELECT 1 FROM places p WHERE p.state_code = f.state_code)
""")
def arrivals_integrity(t):
    """The five checks of the arrivals star; cities of one region only have a population."""
    cities = _demographics(t)
    return arrivals.integrity({
        "fact_immi": arrivals.fact_immi(_arrivals(t)),
        "dim_immi_airline": arrivals.dim_airline(_arrivals(t)),
        "dim_immi_personal": arrivals.dim_personal(_arrivals(t)),
        "dim_airport": airport_dim(t),
        "dim_demographic_population": arrivals.dim_population(cities.filter(F.col("r_name") == "ASIA")),
        "dim_demographic_statistics": arrivals.dim_statistics(cities),
    })
