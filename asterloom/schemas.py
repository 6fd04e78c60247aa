"""Declared schemas: raw files, star tables and query-shaped tables.

Column names, types and orders here are fixed values: they are the data model
users of these tables already have.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}
_COLUMN = re.compile(r"\s*(?:`([^`]+)`|(\w+))\s+(\w+)(?:\(\s*(\d+)\s*,\s*(\d+)\s*\))?\s*(?:,(?=\s*\S)|$)")


def schema_of(columns: str) -> T.StructType:
    """`name type, ...` as a schema; needs no running session.

    Text that isn't wholly columns of known types is an error.
    """
    fields, place = [], 0
    while place < len(columns):
        found = _COLUMN.match(columns, place)
        if not found or found[3] not in (*_TYPES, "decimal") or (found[3] == "decimal") != bool(found[4]):
            raise ValueError(f"not a column of a known type: {columns[place:]!r}")
        place = found.end()
        quoted, plain, kind, precision, scale = found.groups()
        dtype = T.DecimalType(int(precision), int(scale)) if kind == "decimal" else _TYPES[kind]
        fields.append(T.StructField(quoted or plain, dtype))
    return T.StructType(fields)


@dataclass(frozen=True)
class TableSpec:
    """A table's columns, keys and layout, declared once and used everywhere."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = field(default=())
    # Rows of one key always share a partition, though its columns aren't in the key.
    partition_follows_key: bool = False
    # Columns that rows are looked up by: their files carry Bloom filters.
    look_up_by: tuple[str, ...] = ()


# --- raw inputs (fixed values) ---------------------------------------------

CATALOGUE_RAW = schema_of(
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, "
    "duration double, year int"
)

LOG_RAW = schema_of(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, "
    "ts bigint, userAgent string, userId int"
)

# The CSV form of the log: no userAgent, and ts is rounded, so never a time.
LOG_CSV_RAW = schema_of(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, "
    "ts double, userId int"
)

ARRIVALS_RAW = schema_of(
    "cicid double, i94yr double, i94mon double, i94port string, i94addr string, "
    "arrdate double, depdate double, i94mode double, i94visa double, i94cit double, "
    "i94res double, biryear double, gender string, insnum string, airline string, "
    "admnum double, fltno string, visatype string"
)

# --- music star (fixed values) ---------------------------------------------

SONGPLAYS = TableSpec(
    "songplays",
    schema_of(
        "songplay_id string, start_time timestamp_ntz, user_id int, level string, "
        "song_id string, artist_id string, session_id int, location string, "
        "user_agent string, year int, month int"
    ),
    key=("songplay_id",),
    not_null=("songplay_id", "start_time", "user_id"),
    partition_by=("year", "month"),
    cluster_by=("start_time",),
    partition_follows_key=True,
)
USERS = TableSpec(
    "users",
    schema_of("user_id int, first_name string, last_name string, gender string, level string"),
    key=("user_id",),
    not_null=("user_id",),
)
# Partitioned by year only: a directory per artist gives millions of tiny files.
SONGS = TableSpec(
    "songs",
    schema_of("song_id string, title string, artist_id string, duration decimal(18,5), year int"),
    key=("song_id",),
    not_null=("song_id",),
    partition_by=("year",),
    cluster_by=("artist_id",),
)
ARTISTS = TableSpec(
    "artists",
    schema_of("artist_id string, name string, location string, latitude double, longitude double"),
    key=("artist_id",),
    not_null=("artist_id",),
)
TIME = TableSpec(
    "time",
    schema_of(
        "start_time timestamp_ntz, hour int, day int, week int, weekday string, year int, month int"
    ),
    key=("start_time",),
    not_null=("start_time",),
    partition_by=("year", "month"),
    cluster_by=("start_time",),
    partition_follows_key=True,
)

# --- query-shaped tables (fixed values) ------------------------------------

SESSION_ITEMS = TableSpec(
    "session_items",
    schema_of(
        "session_id int, item_in_session int, artist_name string, song_title string, "
        "song_length double"
    ),
    key=("session_id", "item_in_session"),
    cluster_by=("session_id", "item_in_session"),
    look_up_by=("session_id",),
)
USER_SESSIONS = TableSpec(
    "user_sessions",
    schema_of(
        "user_id int, session_id int, item_in_session int, artist_name string, "
        "song_title string, user_firstname string, user_lastname string"
    ),
    key=("user_id", "session_id", "item_in_session"),
    cluster_by=("user_id", "session_id", "item_in_session"),
    look_up_by=("user_id", "session_id"),
)
SONG_USERS = TableSpec(
    "song_users",
    schema_of("song_title string, user_id int, user_firstname string, user_lastname string"),
    key=("song_title", "user_id"),
    cluster_by=("song_title", "user_id"),
    look_up_by=("song_title",),
)

# --- arrivals star (fixed values) ------------------------------------------

FACT_IMMI = TableSpec(
    "fact_immi",
    schema_of(
        "cic_id int, year int, month int, port_code string, arrive_date date, "
        "departure_date date, travel_code int, visa_code int, immigration_id string, "
        "country string, state_code string"
    ),
    key=("immigration_id",),
    not_null=("cic_id",),
    partition_by=("state_code",),
)
DIM_PERSONAL = TableSpec(
    "dim_immi_personal",
    schema_of(
        "cic_id int, citizen_country int, residence_country int, birth_year int, "
        "gender string, ins_num string, immi_person_id string"
    ),
    key=("immi_person_id",),
)
DIM_AIRLINE = TableSpec(
    "dim_immi_airline",
    schema_of(
        "cic_id int, airline string, admin_num bigint, flight_number string, "
        "visa_type string, port_code string, immi_airline_id string"
    ),
    key=("immi_airline_id",),
)
DIM_POPULATION = TableSpec(
    "dim_demographic_population",
    schema_of(
        "city string, male_pop string, female_pop string, num_vetarans string, "
        "foreign_born string, race string, pop_id string, state_code string"
    ),
    key=("pop_id",),
    partition_by=("state_code",),
)
DIM_STATISTICS = TableSpec(
    "dim_demographic_statistics",
    schema_of(
        "city string, median_age string, avg_household_size string, stat_id string, "
        "state_code string"
    ),
    key=("stat_id",),
    partition_by=("state_code",),
)
DIM_AIRPORT = TableSpec(
    "dim_airport",
    schema_of(
        "iata_code string, name string, type string, country string, municipality string, "
        "longitude float, latitude float, state_code string"
    ),
    not_null=("iata_code",),
    partition_by=("state_code",),
)
DIM_TEMPERATURE = TableSpec(
    "dim_temperature",
    schema_of(
        "dt date, avg_temp float, avg_temp_uncertnty float, city string, country string, "
        "year int, month int, record_id bigint"
    ),
    key=("record_id",),
)
COUNTRY_CODE = TableSpec("country_code", schema_of("code int, country string"), key=("code",))
PORT_CODE = TableSpec("port_code", schema_of("code string, port string"), key=("code",))
STATE_CODE = TableSpec("state_code", schema_of("code string, state string"), key=("code",))
VISA_CODE = TableSpec("visa_code", schema_of("code int, visa string"), key=("code",))
TRAVEL_CODE = TableSpec("travel_code", schema_of("code int, travel string"), key=("code",))

MUSIC_STAR = (USERS, SONGS, ARTISTS, TIME, SONGPLAYS)
QUERY_TABLES = (SESSION_ITEMS, USER_SESSIONS, SONG_USERS)
ARRIVALS_STAR = (
    COUNTRY_CODE, PORT_CODE, STATE_CODE, VISA_CODE, TRAVEL_CODE,
    DIM_PERSONAL, DIM_AIRLINE, DIM_POPULATION, DIM_STATISTICS, DIM_AIRPORT,
    DIM_TEMPERATURE, FACT_IMMI,
)
