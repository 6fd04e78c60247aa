"""The music-play star: users, songs, artists, time and the songplays fact.

All builders take staged rows: a log of `LOG_RAW` and a catalogue of
`CATALOGUE_RAW`. `load_star` stages the raw files and writes every table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import md5_key
from ..functions.timeparts import calendar_columns, calendar_dim, from_epoch_millis
from ..operators.dedup import distinct_rows, drop_full_duplicates, earliest_by_key
from ..operators.joins import join_on, look_up_first, orphan_keys, whole_equal
from ..operators.quality import require_no_nulls, require_rows
from ..operators.rows import has_key, only_page
from ..operators.upsert import reduce_upserts
from ..schemas import (
    ARTISTS, CATALOGUE_RAW, LOG_RAW, MUSIC_STAR, SONGPLAYS, SONGS, TIME, USERS, TableSpec,
)
from ..scratch import materialise
from ..sinks.versions import Change
from ..sources.files import read_json, read_tables
from ..sources.ledger import load_unseen
from ..sources.staging import stage_json_files

# The page that marks a play, and the staged log's field paths
# in their declared column order.
PLAY_PAGE = "NextSong"
LOG_MAPPING: Mapping[str, tuple[str, str]] = {
    f.name: (f"$['{f.name}']", f.dataType.simpleString()) for f in LOG_RAW.fields
}

MATCHES = ("song", "song_whole_seconds", "title", "artist")


def stage_log(
    spark: SparkSession,
    paths: str | Sequence[str],
    mapping: Mapping[str, tuple[str, str]] | None = None,
    page: str | None = None,
) -> DataFrame:
    """The log, by name or through a mapping, without exact repeats.

    Rows of other pages than `page` go before the rows are shuffled to find
    the repeats.
    """
    if mapping is None:
        raw = read_json(spark, paths, LOG_RAW, recursive=True)
    else:
        raw = stage_json_files(spark, paths, mapping, recursive=True)
    return drop_full_duplicates(only_page(raw, page))


def stage_catalogue(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return drop_full_duplicates(read_json(spark, paths, CATALOGUE_RAW, recursive=True))


def plays(log: DataFrame, page: str | None = PLAY_PAGE) -> DataFrame:
    return only_page(log, page).withColumn("start_time", from_epoch_millis("ts"))


_SEEN_ORDER = ["ts", "sessionId", "itemInSession"]
_PLACE = ["location", "latitude", "longitude"]


def _users_seen(log: DataFrame, page: str | None = PLAY_PAGE) -> DataFrame:
    return has_key(only_page(log, page), "userId").select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender", "level", "ts", "sessionId", "itemInSession",
    )


def users_dim(log: DataFrame, page: str | None = PLAY_PAGE) -> DataFrame:
    """One row per user: first seen names, latest level."""
    reduced = reduce_upserts(_users_seen(log, page), ["user_id"], _SEEN_ORDER, ["level"])
    return reduced.select(USERS.schema.fieldNames())


def users_distinct(log: DataFrame, page: str | None = PLAY_PAGE) -> DataFrame:
    """Distinct user rows: a user who changed level stands there twice."""
    columns = ["userId", "firstName", "lastName", "gender", "level"]
    return distinct_rows(has_key(only_page(log, page), "userId"), columns).toDF(*USERS.schema.fieldNames())


def songs_dim(catalogue: DataFrame) -> DataFrame:
    """One row per song; of differing repeats the smallest row stays."""
    others = ["title", "artist_id", "year", "duration"]
    songs = has_key(catalogue, "song_id").select("song_id", *others)
    return earliest_by_key(songs, ["song_id"], others)


def songs_distinct(catalogue: DataFrame) -> DataFrame:
    """Distinct song rows: a song told in two ways stands there twice."""
    return distinct_rows(has_key(catalogue, "song_id"), SONGS.schema.fieldNames())


def artists_distinct(catalogue: DataFrame) -> DataFrame:
    """Distinct artist rows: an artist told in two ways stands there twice."""
    return distinct_rows(_artists_seen(catalogue), ARTISTS.schema.fieldNames())


def _artists_seen(catalogue: DataFrame) -> DataFrame:
    return has_key(catalogue, "artist_id").select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
        "song_id",
    )


def artists_dim(catalogue: DataFrame) -> DataFrame:
    """One row per artist: first name, last place and coordinates, by song id."""
    reduced = reduce_upserts(_artists_seen(catalogue), ["artist_id"], ["song_id"], _PLACE)
    return reduced.select(ARTISTS.schema.fieldNames())


def time_dim(log: DataFrame, page: str | None = PLAY_PAGE, weekday_style: str = "name") -> DataFrame:
    """One row per distinct play time, or per event time with `page=None`."""
    return calendar_dim(plays(log, page), "start_time", weekday_style)


def songplays_fact(
    log: DataFrame,
    catalogue: DataFrame,
    match: str = "song",
    how: str = "left",
    page: str | None = PLAY_PAGE,
    whole_seconds: bool = False,
) -> DataFrame:
    """Plays with the song and artist they resolve to.

    `match` says which catalogue rows belong to a play:
    - `song`: title, artist and length; the first such song, so a left join
      keeps one row per play
    - `song_whole_seconds`: the same on whole seconds, every such song
    - `title`: title and artist, every such song once
    - `artist`: artist alone, every song of theirs

    With `whole_seconds` the start time loses its fraction and the key is made
    of session and start time only, so plays of a session in one second share
    theirs; the calendar of such a fact is `calendar_dim(fact, "start_time")`.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}, not {match!r}")
    start = F.date_trunc("second", "start_time").cast("timestamp_ntz") if whole_seconds else F.col("start_time")
    events = plays(log, page).select(
        start.alias("start_time"), F.col("userId").alias("user_id"), "level",
        F.col("sessionId").alias("session_id"), F.col("itemInSession").alias("item"),
        "location", F.col("userAgent").alias("user_agent"),
        F.col("song").alias("_song"), F.col("artist").alias("_artist"), F.col("length").alias("_length"),
    )
    known = catalogue.select("song_id", "artist_id", "title", "artist_name", "duration")
    if match == "song":
        measured = known.withColumn("duration", F.col("duration").try_cast("decimal(18,5)"))
        found = look_up_first(
            events.withColumn("_length", F.col("_length").try_cast("decimal(18,5)")),
            measured,
            {"_song": "title", "_artist": "artist_name", "_length": "duration"},
            ["song_id", "artist_id"],
        )
        if how == "inner":
            found = found.filter(F.col("song_id").isNotNull())
    else:
        conditions = [F.col("_artist") == F.col("artist_name")]
        if match != "artist":
            conditions.append(F.col("_song") == F.col("title"))
        if match == "song_whole_seconds":
            conditions.append(whole_equal(F.col("_length"), F.col("duration")))
        found = join_on(events, known, conditions, how)
        if match == "title":
            found = found.distinct()
    parts = ["session_id", "item", "start_time"] + ([] if match == "song" else ["song_id"])
    if whole_seconds:
        parts = ["session_id", "start_time"]
    calendar = calendar_columns("start_time")
    return found.select(
        md5_key(parts).alias("songplay_id"),
        "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent",
        calendar["year"].alias("year"), calendar["month"].alias("month"),
    )


def build_star(log: DataFrame, catalogue: DataFrame, match: str = "song", how: str = "left") -> dict[TableSpec, DataFrame]:
    """All five tables, dimensions before the fact that refers to them.

    The fact has every play, those without a user too; its declaration refuses
    them when it is written.
    """
    return {
        USERS: users_dim(log),
        SONGS: songs_dim(catalogue),
        ARTISTS: artists_dim(catalogue),
        TIME: time_dim(log),
        SONGPLAYS: songplays_fact(log, catalogue, match, how),
    }


def fact_spec(keep_unknown_users: bool = False) -> TableSpec:
    """The fact's declaration, with or without its refusal of plays that have no user."""
    return replace(SONGPLAYS, not_null=("songplay_id", "start_time")) if keep_unknown_users else SONGPLAYS


_PLAY_ORDER = ["start_time", "session_id", "user_id", "level", "song_id", "artist_id", "location", "user_agent"]


def first_plays(fact: DataFrame) -> DataFrame:
    """One play per key of the fact: of several, the least by user, level, song, artist, place and agent."""
    return earliest_by_key(fact, list(SONGPLAYS.key), _PLAY_ORDER).select(SONGPLAYS.schema.fieldNames())


def _fill_star(change: Change, log: DataFrame, catalogue: DataFrame, fact: TableSpec, match: str, how: str) -> None:
    for spec, rows in build_star(log, catalogue, match, how).items():
        if spec is SONGPLAYS:
            change.replace(first_plays(rows), fact)
        else:
            change.replace(rows, spec)


def _add_to_star(change: Change, log: DataFrame, catalogue: DataFrame, fact: TableSpec, match: str, how: str) -> None:
    """Merge one run's rows into the stored tables; the same rows again change nothing."""
    change.upsert(_users_seen(log), USERS, _SEEN_ORDER, ["level"])
    change.insert_new(songs_dim(catalogue), SONGS, ["title", "artist_id", "year", "duration"])
    change.upsert(_artists_seen(catalogue), ARTISTS, ["song_id"], _PLACE)
    change.insert_new(time_dim(log), TIME, ["start_time"])
    change.insert_new(songplays_fact(log, catalogue, match, how), fact, _PLAY_ORDER)


def load_star(
    spark: SparkSession,
    log_paths: str | Sequence[str],
    catalogue_paths: str | Sequence[str],
    root: str,
    match: str = "song",
    how: str = "left",
    mapping: Mapping[str, tuple[str, str]] | None = None,
    append_fact: bool = False,
    keep_unknown_users: bool = False,
    run: str | None = None,
) -> dict[str, DataFrame]:
    """Stage, load dimensions, load the fact, check, publish; returns the stored tables.

    Both inputs are staged as Parquet once, so each load reads its own columns
    of them instead of parsing the JSON again. `append_fact` adds this run's
    rows (say those of one day's path, see `render_path`) to the stored star:
    facts and times by key, users and artists as upserts, so a load may be
    repeated. Plays with the same key are one play, in the first load as in
    later ones (`first_plays`). Plays without a user are counted and refused
    before any table is touched, or kept with `keep_unknown_users`.

    All five tables change in one version: their new rows are written and
    audited beside the stored ones, and readers see them together or, if a check
    fails, never. The audit reads the keys of the new rows only.

    With the name of a `run` only log files that no earlier run has loaded are
    read, and the run's are noted in the ledger by the same version
    (`sources.ledger`): a run may be repeated, and runs come in any order.
    """
    if run is not None:
        load_unseen(
            spark, root, log_paths, run,
            lambda change, paths: _load(change, paths, catalogue_paths, match, how, mapping, append_fact, keep_unknown_users),
        )
    else:
        with Change(spark, root) as change:
            _load(change, log_paths, catalogue_paths, match, how, mapping, append_fact, keep_unknown_users)
    return read_tables(spark, MUSIC_STAR, root)


def _load(change: Change, log_paths, catalogue_paths, match, how, mapping, append_fact, keep_unknown_users) -> None:
    spark = change.spark
    log = materialise(stage_log(spark, log_paths, mapping, PLAY_PAGE), "staged-log")
    catalogue = materialise(stage_catalogue(spark, catalogue_paths), "staged-catalogue")
    require_rows(log, "log")
    require_rows(catalogue, "catalogue")
    fact = fact_spec(keep_unknown_users)
    if not keep_unknown_users:
        require_no_nulls(plays(log), "plays", ["userId"])
    add = append_fact and all(change.stored(spec) for spec in MUSIC_STAR)
    (_add_to_star if add else _fill_star)(change, log, catalogue, fact, match, how)
    for spec in MUSIC_STAR:
        # An inner-joined fact may rightly be empty; rows to add were chosen for new keys.
        change.audit(fact if spec is SONGPLAYS else spec, may_be_empty=add or (spec is SONGPLAYS and how == "inner"), new_keys=add)


def star_orphans(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Fact keys each dimension lacks; the NULL song of an unmatched play is one."""
    fact = star["songplays"]
    return {
        "users": orphan_keys(fact, "user_id", star["users"], "user_id"),
        "songs": orphan_keys(fact, "song_id", star["songs"], "song_id"),
        "artists": orphan_keys(fact, "artist_id", star["artists"], "artist_id"),
        "time": orphan_keys(fact, "start_time", star["time"], "start_time"),
    }


__all__ = [
    "LOG_MAPPING", "MATCHES", "PLAY_PAGE", "artists_dim", "artists_distinct", "build_star", "fact_spec", "first_plays", "load_star", "plays",
    "songplays_fact", "songs_dim", "songs_distinct", "stage_catalogue", "stage_log", "star_orphans", "time_dim", "users_dim",
    "users_distinct",
]
