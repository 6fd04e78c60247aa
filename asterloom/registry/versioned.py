"""Stored tables in versions: loads that readers see whole or not at all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.counting import Counted, null_figures
from ..operators.quality import QualityError
from ..plans import arrivals
from ..schemas import SESSION_ITEMS, SONG_USERS, USER_SESSIONS, TableSpec, schema_of
from ..scratch import scratch_path
from ..sinks.checked import load_json_checked
from ..sinks.versions import Change, clean_up
from ..sources.files import read_json, read_table
from ..sources.labels import read_scripts
from ..sources.ledger import load_unseen
from ..sources.rejects import REJECTS
from .base import query

_LEVELS = TableSpec("levels", schema_of("user_id bigint, level string"))
_USERS = TableSpec("members", schema_of("user_id bigint, first_id bigint, level string"), key=("user_id",), not_null=("user_id",))
_DAYS = TableSpec(
    "days", schema_of("user_id bigint, first_id bigint, level string, day date"), key=("day", "user_id"), partition_by=("day",))
_NOON = "2024-01-16 12:00:00"


def _rows(t):
    return t.events.select(
        "user_id", F.col("event_id").alias("first_id"), F.col("event_type").alias("level"), F.col("ts").cast("date").alias("day"),
        "ts", "event_id",
    )


@query("""
    SELECT 'before' AS seen, user_id, event_type AS level FROM events
    UNION ALL SELECT DISTINCT 'after', user_id, event_type FROM events
""")
def versioned_reload(t):
    """Truncate and insert beside a reader: who began before reads the old rows, who begins after the new ones."""
    root = scratch_path(t.spark, "versions")
    rows = t.events.select("user_id", F.col("event_type").alias("level"))
    with Change(t.spark, root) as change:
        change.append(rows, _LEVELS)
    before = read_table(t.spark, _LEVELS, root)
    with Change(t.spark, root) as change:
        change.replace(change.table(_LEVELS).distinct(), _LEVELS)
    after = read_table(t.spark, _LEVELS, root)
    return before.select(F.lit("before").alias("seen"), "*").unionAll(after.select(F.lit("after"), "*"))


@query("""
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_id, arg_max(event_type, (ts, event_id)) AS level,
           CAST(ts AS DATE) AS day
    FROM events GROUP BY user_id, CAST(ts AS DATE)
""")
def versioned_upsert(t):
    """Two batches upserted in versions, the second into the days it touches; what no version needs goes."""
    root = scratch_path(t.spark, "versions")
    rows, noon = _rows(t), F.lit(_NOON).cast("timestamp_ntz")
    for batch in (rows.filter(F.col("ts") < noon), rows.filter(F.col("ts") >= noon)):
        with Change(t.spark, root) as change:
            change.upsert(batch, _DAYS, ["ts", "event_id"], ["level"])
            change.audit(_DAYS, may_be_empty=True)
    clean_up(t.spark, root)
    return read_table(t.spark, _DAYS, root)


@query("""
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_id, arg_min(event_type, (ts, event_id)) AS level
    FROM events GROUP BY user_id
""")
def refused_load(t):
    """A load with repeated keys is written, audited and refused; the stored rows stay."""
    root = scratch_path(t.spark, "versions")
    rows = _rows(t)
    with Change(t.spark, root) as change:
        change.insert_new(rows, _USERS, ["ts", "event_id"])
        change.audit(_USERS, may_be_empty=True)
    try:
        with Change(t.spark, root) as change:
            change.replace(rows.unionAll(rows), _USERS)
            change.audit(_USERS, may_be_empty=True)
    except QualityError:
        pass
    return read_table(t.spark, _USERS, root)


_EVENTS = TableSpec("kept_events", schema_of("event_id bigint, user_id bigint"))


@query("""
    SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS reason
    FROM events WHERE event_type NOT IN ('error', 'purchase', 'signup')
    UNION ALL SELECT NULL, NULL, '{"event_id":' || event_id || ',"user_id":"u', 'malformed' FROM events WHERE event_type = 'error'
    UNION ALL SELECT NULL, NULL, '{"event_id":' || event_id || ',"user_id":"u' || user_id || '"}', 'bad user_id'
              FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT NULL, NULL, '[' || event_id || ']', 'not an object' FROM events WHERE event_type = 'signup'
""")
def json_rejects(t):
    """JSON lines, of which some are cut off, no objects or of wrong types: loaded rows and kept rejects."""
    root = scratch_path(t.spark, "rejects")
    kind, event, user = F.col("event_type"), F.col("event_id").cast("string"), F.col("user_id").cast("string")
    head = F.concat(F.lit('{"event_id":'), event, F.lit(',"user_id":'))
    line = (
        F.when(kind == "error", F.concat(head, F.lit('"u')))
        .when(kind == "purchase", F.concat(head, F.lit('"u'), user, F.lit('"}')))
        .when(kind == "signup", F.concat(F.lit("["), event, F.lit("]")))
        .otherwise(F.concat(head, user, F.lit("}")))
    )
    t.events.select(line.alias("value")).write.text(f"{root}/raw")
    figures = load_json_checked(t.spark, f"{root}/raw", _EVENTS, root)
    if figures["loaded"] + figures["rejected"] != figures["lines"]:
        raise QualityError(f"lines are missing: {figures}")
    none = F.lit(None).cast("string")
    kept = read_table(t.spark, _EVENTS, root).select("event_id", "user_id", none.alias("line"), none.alias("reason"))
    number = F.lit(None).cast("bigint")
    return kept.unionAll(read_table(t.spark, REJECTS, root).select(number, number, "line", "reason"))


_RUNS = TableSpec("run_events", schema_of("event_id bigint, user_id bigint, run string"), key=("event_id",))


@query("""
    SELECT event_id, user_id, CASE WHEN day(ts) <= 10 THEN 'first' WHEN day(ts) <= 20 THEN 'second' ELSE 'third' END AS run FROM events
""")
def ledger_loads(t):
    """Ten days' files a run, runs in any order and one of them twice: every file counts once, under its first run."""
    root = scratch_path(t.spark, "ledger")
    day = F.dayofmonth("ts")
    part = F.when(day <= 10, "first").when(day <= 20, "second").otherwise("third")
    t.events.select("event_id", "user_id", part.alias("part")).write.partitionBy("part").json(f"{root}/raw")
    schema = schema_of("event_id bigint, user_id bigint")
    for run, folder in (("third", "third"), ("first", "first"), ("again", "first"), ("second", "second"), ("all", "*")):
        load_unseen(
            t.spark, f"{root}/star", f"{root}/raw/part={folder}", run,
            lambda change, paths, run=run: change.insert_new(
                read_json(t.spark, paths, schema).withColumn("run", F.lit(run)), _RUNS, ["user_id"]),
        )
    return read_table(t.spark, _RUNS, f"{root}/star")


@query("""
    SELECT 'days' AS tbl, count(*) AS n_source, count(DISTINCT (user_id, CAST(ts AS DATE))) AS n_target, count(*) - count(user_id) AS null_user_id
    FROM events
""")
def load_counts(t):
    """Rows read, NULLs met and rows written, counted by the load itself: no table is scanned for them."""
    root = scratch_path(t.spark, "counts")
    source = Counted(_rows(t), **null_figures(["user_id"]))
    with Change(t.spark, root) as change:
        written = change.insert_new(source.df, _DAYS, ["ts", "event_id"])
    found = source.get()
    return t.spark.range(1).select(
        F.lit("days").alias("tbl"), F.lit(found["rows"]).cast("bigint").alias("n_source"), F.lit(written).cast("bigint").alias("n_target"),
        F.lit(found["null_user_id"]).cast("bigint").alias("null_user_id"))


def _played(t):
    part = t.part.select("p_partkey", "p_name", "p_brand")
    return t.lineitem.filter(F.col("l_returnflag") == "R").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("int").alias("session_id"), F.col("l_linenumber").cast("int").alias("item_in_session"),
        F.col("p_brand").alias("artist_name"), F.col("p_name").alias("song_title"), F.col("l_quantity").cast("double").alias("song_length"),
        F.col("l_suppkey").cast("int").alias("user_id"), F.concat(F.lit("first "), "l_suppkey").alias("user_firstname"),
        F.concat(F.lit("last "), "l_suppkey").alias("user_lastname"),
    )


def _looked_up(t, spec, order_by, columns):
    """The stored rows of the table's first key, which the filter finds by bloom filters and page statistics."""
    root = scratch_path(t.spark, "look-ups")
    with Change(t.spark, root) as change:
        change.insert_new(_played(t), spec, order_by)
    stored = read_table(t.spark, spec, root)
    key = stored.agg(F.min(F.struct(*columns)).alias("k")).first()["k"]
    for c in columns:
        stored = stored.filter(F.col(c) == F.lit(key[c]))
    return stored


_PLAYED_SQL = """
    SELECT CAST(l_orderkey AS INTEGER) AS session_id, CAST(l_linenumber AS INTEGER) AS item_in_session, p_brand AS artist_name,
           p_name AS song_title, CAST(l_quantity AS DOUBLE) AS song_length, CAST(l_suppkey AS INTEGER) AS user_id,
           'first ' || l_suppkey AS user_firstname, 'last ' || l_suppkey AS user_lastname
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'
"""


@query(f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT session_id, item_in_session, artist_name, song_title, song_length,
               row_number() OVER (PARTITION BY session_id, item_in_session ORDER BY artist_name, song_title, song_length) AS rn
        FROM ({_PLAYED_SQL}) p) q
    WHERE rn = 1 ORDER BY session_id, item_in_session LIMIT 1
""")
def stored_session_item(t):
    """One item of one session, from the stored table of session items."""
    return _looked_up(t, SESSION_ITEMS, ["artist_name", "song_title", "song_length"], ["session_id", "item_in_session"])


@query(f"""
    SELECT * EXCLUDE (rn, first) FROM (
        SELECT user_id, session_id, item_in_session, artist_name, song_title, user_firstname, user_lastname,
               row_number() OVER (PARTITION BY user_id, session_id, item_in_session ORDER BY artist_name, song_title) AS rn,
               rank() OVER (ORDER BY user_id, session_id) AS first
        FROM ({_PLAYED_SQL}) p) q
    WHERE rn = 1 AND first = 1
""")
def stored_user_session(t):
    """One user's one session in order, from the stored table of user sessions."""
    found = _looked_up(t, USER_SESSIONS, ["artist_name", "song_title"], ["user_id", "session_id"])
    return found.orderBy("item_in_session")


@query(f"""
    SELECT DISTINCT song_title, user_id, user_firstname, user_lastname FROM ({_PLAYED_SQL}) p
    WHERE song_title = (SELECT min(song_title) FROM ({_PLAYED_SQL}) q)
""")
def stored_song_listeners(t):
    """Who heard one song, from the stored table of listeners."""
    return _looked_up(t, SONG_USERS, ["user_firstname"], ["song_title"])


_NUMBERED = TableSpec("numbered", schema_of("number bigint, event_id bigint, day date"), key=("number",), partition_by=("day",))


@query("""
    SELECT CAST(row_number() OVER (ORDER BY CASE WHEN ts < TIMESTAMP '2024-01-16 12:00:00' THEN 0 ELSE 1 END, event_id) AS BIGINT) + 99 AS number,
           event_id, CAST(ts AS DATE) AS day
    FROM events
""")
def identity_continues(t):
    """Two appends, by time: the second's numbers go on where the first's end."""
    root = scratch_path(t.spark, "numbered")
    noon = F.lit(_NOON).cast("timestamp_ntz")
    rows = t.events.select("event_id", F.col("ts").cast("date").alias("day"), "ts")
    for batch in (rows.filter(F.col("ts") < noon), rows.filter(F.col("ts") >= noon)):
        with Change(t.spark, root) as change:
            change.append_numbered(batch.drop("ts"), _NUMBERED, "number", ["event_id"], start=100)
            change.audit(_NUMBERED, new_keys=True)
    return read_table(t.spark, _NUMBERED, root)


@query("""
    SELECT 'country_code' AS list, CAST(n_nationkey AS VARCHAR) AS code, n_name || ', by air' AS label FROM nation
    UNION ALL SELECT 'port_code', 'P' || s_suppkey, s_name || '''S PIER' FROM supplier
    UNION ALL SELECT 'state_code', upper(substr(r_name, 1, 2)), r_name FROM region
    UNION ALL SELECT 'travel_code', CAST(p_size AS VARCHAR), 'size ' || p_size FROM (SELECT DISTINCT p_size FROM part) p
    UNION ALL SELECT 'visa_code', CAST(r_regionkey AS VARCHAR), r_name FROM region
""")
def code_lists(t):
    """The five code lists of one script, four from its blocks and one from a comment."""

    def block(rows, code, label, name, comment=False):
        entry = F.concat(F.lit("   "), code, F.lit(" = "), label)
        # In ranges of one folder a file holds the whole block; the script is one text.
        listed = rows.select(entry.alias("entry")).agg(F.array_join(F.array_sort(F.collect_set("entry")), "\n").alias("body"))
        start, end = (f"/* {name} - in a comment:\n", "\n*/\n") if comment else (f"value {name}\n", " ;\n\n")
        return listed.select(F.concat(F.lit(start), "body", F.lit(end)).alias("value"))

    def quoted(c):
        return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))

    def text(c):
        return F.col(c).cast("string")

    blocks = [
        block(t.nation, text("n_nationkey"), quoted(F.concat("n_name", F.lit(", by air   "))), "i94cntyl"),
        block(t.supplier, quoted(F.concat(F.lit("P"), text("s_suppkey"))), quoted(F.concat("s_name", F.lit("'S PIER"))), "$i94prtl"),
        block(t.region, quoted(F.upper(F.substring("r_name", 1, 2))), quoted(F.col("r_name")), "i94addrl"),
        block(t.part, text("p_size"), quoted(F.concat(F.lit("size "), text("p_size"))), "i94model"),
        block(t.region, text("r_regionkey"), F.col("r_name"), "I94VISA", comment=True),
    ]
    script = blocks[0].select(F.col("value").alias("v0"))
    for k, other in enumerate(blocks[1:], 1):
        script = script.withColumn("one", F.lit(1)).join(
            other.select(F.col("value").alias(f"v{k}"), F.lit(1).alias("one")), "one").drop("one")
    root = scratch_path(t.spark, "script")
    script.select(F.concat(*[f"v{k}" for k in range(5)]).alias("value")).write.text(root)
    lists = arrivals.code_tables(read_scripts(t.spark, f"{root}/*.txt"))
    found = [
        df.select(F.lit(spec.name).alias("list"), text("code").alias("code"), F.col(df.columns[1]).alias("label"))
        for spec, df in lists.items()
    ]
    return reduce(DataFrame.unionAll, found)
