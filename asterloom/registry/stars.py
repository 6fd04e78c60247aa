"""Whole loads: raw files derived from the tables, staged, loaded, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import conform
from ..functions.timeparts import to_epoch_millis
from ..operators.dedup import drop_full_duplicates
from ..operators.joins import songs_with_artists
from ..operators.quality import row_counts
from ..operators.rows import only_page
from ..plans import arrivals, music, sessions
from ..schemas import CATALOGUE_RAW, DIM_STATISTICS, FACT_IMMI, LOG_RAW, SONGPLAYS, USER_SESSIONS
from ..scratch import materialise, scratch_path
from ..sinks.files import write_table
from ..sources.files import read_csv, read_table, read_tables
from ..sources.staging import stage_json
from .base import query

RAW_LINES = 1 << 19


def _catalogue(t):
    """Parts as songs, brands as artists."""
    return t.part.select(
        F.lit(1).alias("num_songs"),
        F.col("p_brand").alias("artist_id"),
        F.lit(None).cast("double").alias("artist_latitude"),
        F.col("p_retailprice").alias("artist_longitude"),
        F.col("p_type").alias("artist_location"),
        F.concat(F.lit("The "), "p_brand").alias("artist_name"),
        F.format_string("S%012d", "p_partkey").alias("song_id"),
        F.concat_ws(" ", "p_name", "p_partkey").alias("title"),
        F.col("p_size").cast("double").alias("duration"),
        F.lit(0).alias("year"),
    )


def _log(t):
    """Line items as log rows: ship date as play time, orders as sessions."""
    part = t.part.select("p_partkey", "p_name", "p_brand")
    return t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit("The "), "p_brand").alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.concat(F.lit("first "), "l_suppkey").alias("firstName"),
        F.lit("F").alias("gender"),
        F.col("l_linenumber").alias("itemInSession"),
        F.concat(F.lit("last "), "l_suppkey").alias("lastName"),
        F.col("l_quantity").alias("length"),
        F.when(F.col("l_linestatus") == "F", "free").otherwise("paid").alias("level"),
        F.col("l_linestatus").alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("l_returnflag") == "R", "NextSong").otherwise("Home").alias("page"),
        F.col("l_extendedprice").alias("registration"),
        F.col("l_orderkey").alias("sessionId"),
        F.concat_ws(" ", "p_name", "p_partkey").alias("song"),
        F.lit(200).alias("status"),
        to_epoch_millis("l_shipdate").alias("ts"),
        F.lit("agent").alias("userAgent"),
        F.col("l_suppkey").cast("string").alias("userId"),
    )


def write_raw(rows, path):
    """Raw JSON lines, gzipped: as text the log is many times the size of its tables.

    A gzipped file is read by one task, so none gets more than RAW_LINES lines.
    """
    rows.write.option("compression", "gzip").option("maxRecordsPerFile", RAW_LINES).json(path)


@query("""
    SELECT format('S{:012d}', p_partkey) AS song_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS title,
           p_brand AS artist_id, 'The ' || p_brand AS name, l.location, l.longitude, CAST(p_size AS DOUBLE) AS duration,
           CAST(0 AS INTEGER) AS year
    FROM part JOIN (SELECT p_brand AS b, arg_max(p_type, p_partkey) AS location, arg_max(p_retailprice, p_partkey) AS longitude
                    FROM part GROUP BY p_brand) l ON p_brand = l.b
""")
def catalogue_star(t):
    """Catalogue files to songs and artists, joined again."""
    root = scratch_path(t.spark, "catalogue")
    write_raw(_catalogue(t), root)
    staged = music.stage_catalogue(t.spark, root)
    songs, artists = music.songs_dim(staged), music.artists_dim(staged)
    found = songs_with_artists(songs, artists, ["artist_name", "location", "longitude"])
    return found.withColumnRenamed("artist_name", "name")


_PLAYS_SQL = """
    SELECT DISTINCT l_shipdate AS start_time, l_suppkey, l_linestatus, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           p_partkey, p_brand, p_size
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'
"""


@query(f"""
    SELECT start_time, CAST(l_suppkey AS INTEGER) AS user_id,
           CASE WHEN l_linestatus = 'F' THEN 'free' ELSE 'paid' END AS level,
           CASE WHEN l_quantity = p_size THEN format('S{{:012d}}', p_partkey) END AS song_id,
           CASE WHEN l_quantity = p_size THEN p_brand END AS artist_id,
           CAST(l_orderkey AS INTEGER) AS session_id, l_linestatus AS location, 'agent' AS user_agent,
           CAST(year(start_time) AS INTEGER) AS year, CAST(month(start_time) AS INTEGER) AS month
    FROM ({_PLAYS_SQL}) e
""")
def log_star(t):
    """Log and catalogue built into a partitioned fact, three-key left join."""
    root = scratch_path(t.spark, "log-star")
    write_raw(_catalogue(t), f"{root}/raw/catalogue")
    write_raw(_log(t), f"{root}/raw/log")
    log = music.stage_log(t.spark, f"{root}/raw/log", page=music.PLAY_PAGE)
    fact = music.songplays_fact(log, music.stage_catalogue(t.spark, f"{root}/raw/catalogue"))
    write_table(fact, SONGPLAYS, root)
    return read_table(t.spark, SONGPLAYS, root).drop("songplay_id")


@query(f"""
    SELECT DISTINCT start_time, CAST(l_suppkey AS INTEGER) AS user_id, format('S{{:012d}}', p_partkey) AS song_id,
           p_brand AS artist_id, CAST(l_orderkey AS INTEGER) AS session_id, CAST(l_linenumber AS INTEGER) AS item
    FROM ({_PLAYS_SQL}) e
""")
def warehouse_star(t):
    """Log lines staged through the mapping, inner join on title and artist, distinct."""
    lines = _log(t).select(F.to_json(F.struct("*")).alias("value"))
    # Other pages go before repeats are looked for.
    plays = only_page(stage_json(lines, "value", music.LOG_MAPPING), music.PLAY_PAGE)
    log = materialise(drop_full_duplicates(plays), "staged-log")
    # Carried through as the agent, to be told apart in the result.
    log = log.withColumn("userAgent", F.col("itemInSession").cast("string"))
    fact = music.songplays_fact(log, _catalogue(t), match="title", how="inner")
    return fact.select(
        "start_time", "user_id", "song_id", "artist_id", "session_id", F.col("user_agent").cast("int").alias("item")
    ).distinct()


@query("""
    SELECT 'artists' AS tbl, count(DISTINCT p_brand) AS n, true AS ok FROM part
    UNION ALL SELECT 'songplays', count(*), true
              FROM (SELECT DISTINCT * EXCLUDE (l_discount, l_tax) FROM lineitem WHERE l_returnflag = 'R') l
    UNION ALL SELECT 'songs', count(*), true FROM part
    UNION ALL SELECT 'time', count(DISTINCT l_shipdate), true FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT 'users', count(DISTINCT l_suppkey), true FROM lineitem WHERE l_returnflag = 'R'
""")
def staged_star(t):
    """Stage, dimensions, fact, in load order; rows per loaded table."""
    root = scratch_path(t.spark, "staged-star")
    log = materialise(drop_full_duplicates(conform(only_page(_log(t), music.PLAY_PAGE), LOG_RAW)), "staged-log")
    catalogue = materialise(conform(_catalogue(t), CATALOGUE_RAW), "staged-catalogue")
    for spec, rows in music.build_star(log, catalogue).items():
        write_table(rows, spec, root)
    return row_counts(read_tables(t.spark, music.MUSIC_STAR, root))


@query(f"""
    SELECT CAST(l_suppkey AS INTEGER) AS user_id, CAST(l_orderkey AS INTEGER) AS session_id, l_linenumber AS item_in_session,
           artist AS artist_name, song AS song_title, 'first ' || CAST(l_suppkey AS VARCHAR) AS user_firstname,
           'last ' || CAST(l_suppkey AS VARCHAR) AS user_lastname
    FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_linenumber
                                       ORDER BY l_quantity DESC, artist DESC, song DESC) AS rn
          FROM (SELECT *, 'The ' || p_brand AS artist, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS song
                FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R') p) e
    WHERE rn = 1
""")
def query_tables(t):
    """CSV logs, rows without an artist left out, to a table keyed for one question."""
    root = scratch_path(t.spark, "query-tables")
    played = F.when(F.col("page") == "NextSong", F.col("artist")).otherwise(F.lit(""))
    _log(t).withColumn("artist", played).drop("userAgent").write.option("header", True).csv(f"{root}/raw")
    log = sessions.consolidate(t.spark, f"{root}/raw")
    write_table(sessions.user_sessions(log, sessions.WRITE_ORDER), USER_SESSIONS, root)
    return read_table(t.spark, USER_SESSIONS, root)


def _arrivals(t):
    """Orders as arrivals, customers as travellers; every number a double."""
    people = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    day = F.datediff("o_orderdate", F.to_date(F.lit("1960-01-01"))).cast("double")
    return t.orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.year("o_orderdate").cast("double").alias("i94yr"),
        F.month("o_orderdate").cast("double").alias("i94mon"),
        F.substring("o_orderpriority", 1, 1).alias("i94port"),
        F.when(F.col("o_orderstatus") != "P", F.format_string("%02d", "c_nationkey")).alias("i94addr"),
        day.alias("arrdate"),
        F.when(F.col("o_orderstatus") == "F", day + 10).alias("depdate"),
        F.lit(1.0).alias("i94mode"),
        F.lit(2.0).alias("i94visa"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        F.col("c_nationkey").cast("double").alias("i94res"),
        (F.lit(1950.0) + F.col("c_nationkey")).alias("biryear"),
        F.col("c_mktsegment").alias("gender"),
        F.lit(None).cast("string").alias("insnum"),
        F.col("o_orderpriority").alias("airline"),
        (F.col("o_orderkey") + F.lit(92000000000.0)).alias("admnum"),
        F.col("o_orderstatus").alias("fltno"),
        F.lit("B2").alias("visatype"),
    )


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS cic_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month, substr(o_orderpriority, 1, 1) AS port_code,
           CAST(o_orderdate AS DATE) AS arrive_date,
           CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 10 AS DATE) END AS departure_date,
           1 AS travel_code, 2 AS visa_code, 'United States' AS country,
           CASE WHEN o_orderstatus <> 'P' THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END AS state_code
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def arrivals_fact(t):
    """The arrivals fact, stored by state (`07` and NULL among them), read back."""
    root = scratch_path(t.spark, "arrivals")
    write_table(arrivals.fact_immi(_arrivals(t)), FACT_IMMI, root)
    return read_table(t.spark, FACT_IMMI, root).drop("immigration_id")


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS cic_id, c_nationkey AS citizen_country, c_nationkey AS residence_country,
           1950 + c_nationkey AS birth_year, c_mktsegment AS gender, CAST(NULL AS VARCHAR) AS ins_num
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def arrivals_personal(t):
    return arrivals.dim_personal(_arrivals(t)).drop("immi_person_id")


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS cic_id, o_orderpriority AS airline, 92000000000 + o_orderkey AS admin_num,
           o_orderstatus AS flight_number, 'B2' AS visa_type, substr(o_orderpriority, 1, 1) AS port_code
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def arrivals_airline(t):
    return arrivals.dim_airline(_arrivals(t)).drop("immi_airline_id")


@query("""
    SELECT n_name AS country, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 5
""")
def arrivals_top_countries(t):
    countries = t.nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("country"))
    return arrivals.top_citizen_countries(arrivals.dim_personal(_arrivals(t)), countries)


@query("""
    SELECT DISTINCT upper(c_name) AS city, CAST(c_acctbal AS VARCHAR) AS median_age, c_mktsegment AS avg_household_size,
           lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_code
    FROM customer
""")
def city_statistics(t):
    """Statistics per city from a semicolon file, stored by state."""
    root = scratch_path(t.spark, "cities")
    columns = {name: F.lit("x") for name in arrivals.DEMOGRAPHICS_RAW.fieldNames()}
    columns.update({
        "City": F.col("c_name"), "State Code": F.format_string("%02d", "c_nationkey"),
        "Median Age": F.col("c_acctbal"), "Average Household Size": F.col("c_mktsegment"),
    })
    rows = t.customer.select([c.alias(name) for name, c in columns.items()])
    rows.write.option("header", True).option("sep", ";").csv(f"{root}/raw")
    raw = read_csv(t.spark, f"{root}/raw", arrivals.DEMOGRAPHICS_RAW, sep=";")
    write_table(arrivals.dim_statistics(raw), DIM_STATISTICS, root)
    return read_table(t.spark, DIM_STATISTICS, root).drop("stat_id")


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS iata_code, s_name AS name, 'small' AS type, 'United States' AS country,
           n_name AS municipality, CAST(s_acctbal AS FLOAT) AS longitude, CAST(s_suppkey AS FLOAT) AS latitude,
           r_name AS state_code
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name IN ('AMERICA', 'ASIA')
""")
def airport_dim(t):
    """Airports of one country that have a code; coordinates and region split."""
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    airports = places.select(
        F.when(F.col("r_name") != "AFRICA", F.col("s_suppkey").cast("string")).alias("iata_code"),
        F.col("s_name").alias("name"), F.lit("small").alias("type"),
        F.when(F.col("r_name").isin("AMERICA", "ASIA", "AFRICA"), "US").otherwise("XX").alias("iso_country"),
        F.concat(F.lit("US-"), "r_name").alias("iso_region"), F.col("n_name").alias("municipality"),
        F.concat_ws(", ", "s_acctbal", "s_suppkey").alias("coordinates"),
    )
    return arrivals.dim_airport(airports)


@query("""
    SELECT CAST(o_orderdate AS DATE) AS dt, CAST(o_totalprice AS FLOAT) AS avg_temp,
           CAST(o_orderkey AS FLOAT) AS avg_temp_uncertnty, o_orderpriority AS city, 'United States' AS country,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           row_number() OVER (ORDER BY o_orderdate, o_orderpriority, CAST(o_totalprice AS FLOAT), CAST(o_orderkey AS FLOAT)) - 1
               AS record_id
    FROM orders WHERE o_orderstatus = 'F'
""")
def temperature_dim(t):
    """Readings of one country, dated and numbered."""
    readings = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"), F.col("o_totalprice").cast("string").alias("AverageTemperature"),
        F.col("o_orderkey").cast("string").alias("AverageTemperatureUncertainty"), F.col("o_orderpriority").alias("City"),
        F.when(F.col("o_orderstatus") == "F", arrivals.HOME_COUNTRY).otherwise("Elsewhere").alias("Country"),
    )
    return arrivals.dim_temperature(readings)
