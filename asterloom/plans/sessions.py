"""Query-shaped tables: one per question, keyed and clustered for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analysis import look_up
from ..operators.dedup import latest_by_key
from ..operators.rows import not_blank
from ..schemas import LOG_CSV_RAW, QUERY_TABLES, SESSION_ITEMS, SONG_USERS, USER_SESSIONS, TableSpec
from ..sinks.files import write_csv, write_table
from ..sources.files import read_csv, read_tables

# The columns of the consolidated file, in order.
CONSOLIDATED = (
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
    "sessionId", "song", "userId",
)


def consolidate(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The whole tree of CSV logs as one set, rows without an artist left out."""
    return not_blank(read_csv(spark, paths, LOG_CSV_RAW), "artist").select(*CONSOLIDATED)


def session_items(log: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """What was heard at each (session, item)."""
    return latest_by_key(_named(log), SESSION_ITEMS.key, order_by, ["artist_name", "song_title", "song_length"])


def user_sessions(log: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """What each user heard in each session, by item."""
    columns = ["artist_name", "song_title", "user_firstname", "user_lastname"]
    return latest_by_key(_named(log), USER_SESSIONS.key, order_by, columns)


def song_users(log: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Who heard each song."""
    return latest_by_key(_named(log), SONG_USERS.key, order_by, ["user_firstname", "user_lastname"])


def _named(log: DataFrame) -> DataFrame:
    return log.withColumns({
        "session_id": F.col("sessionId"),
        "item_in_session": F.col("itemInSession"),
        "user_id": F.col("userId"),
        "artist_name": F.col("artist"),
        "song_title": F.col("song"),
        "song_length": F.col("length"),
        "user_firstname": F.col("firstName"),
        "user_lastname": F.col("lastName"),
    })


# Within one primary key the logs give no write order; the item decides.
WRITE_ORDER = ("sessionId", "itemInSession", "length", "artist", "song")


def load_query_tables(
    spark: SparkSession, paths: str | Sequence[str], root: str, csv_path: str | None = None
) -> dict[str, DataFrame]:
    """Consolidate the CSV logs and write the three tables.

    With `csv_path` the consolidated set is also kept as quoted CSV.
    """
    log = consolidate(spark, paths)
    if csv_path:
        write_csv(log, csv_path)
    builds: dict[TableSpec, DataFrame] = {
        SESSION_ITEMS: session_items(log, WRITE_ORDER),
        USER_SESSIONS: user_sessions(log, WRITE_ORDER),
        SONG_USERS: song_users(log, WRITE_ORDER),
    }
    for spec, rows in builds.items():
        write_table(rows, spec, root)
    return read_tables(spark, QUERY_TABLES, root)


def heard_at(session_items_table: DataFrame, session_id: int, item: int) -> DataFrame:
    return look_up(
        session_items_table, ["artist_name", "song_title", "song_length"], session_id=session_id, item_in_session=item
    )


def heard_by(user_sessions_table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    return look_up(
        user_sessions_table,
        ["artist_name", "song_title", "user_firstname", "user_lastname"],
        order_by=["item_in_session"],
        user_id=user_id,
        session_id=session_id,
    )


def listeners_of(song_users_table: DataFrame, song_title: str) -> DataFrame:
    return look_up(song_users_table, ["user_firstname", "user_lastname"], song_title=song_title)
