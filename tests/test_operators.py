from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asterloom.operators import analysis, dedup, joins, keys, quality, upsert
from asterloom.operators import rows as row_ops
from asterloom.schemas import TableSpec, schema_of

from .conftest import rows


def test_row_filters(spark):
    df = spark.createDataFrame([("NextSong", "a"), ("Home", ""), ("NextSong", None)], "page string, v string")
    assert row_ops.only_page(df, "NextSong").count() == 2
    assert row_ops.only_page(df, None).count() == 3
    assert rows(row_ops.not_blank(df, "v")) == [("NextSong", "a")]
    assert row_ops.has_key(df, "v", "page").count() == 2
    assert row_ops.matching(df, page=["Home", "x"]).count() == 1
    assert row_ops.matching(df, page="NextSong", v="a").count() == 1


def test_positional_rename_stops_at_the_shorter_list(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert row_ops.rename_positional(df, ["x", "y"]).columns == ["x", "y", "c"]


def test_full_and_projected_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, v string")
    assert rows(dedup.drop_full_duplicates(df)) == [(1, "a"), (1, "b"), (None, "a")]
    assert rows(dedup.distinct_rows(df, ["k"])) == [(1,), (None,)]


USERS = "user_id int, name string, level string, ts int, seq int"


def test_first_and_last_by_key(spark):
    df = spark.createDataFrame(
        [(1, "A", "paid", 9, 0), (1, "B", "free", 1, 0), (1, "C", None, 9, 1), (2, None, "free", 5, 0)], USERS
    )
    assert rows(dedup.earliest_by_key(df, ["user_id"], ["ts", "seq"], ["name", "level"])) == [(1, "B", "free"), (2, None, "free")]
    assert rows(dedup.latest_by_key(df, ["user_id"], ["ts", "seq"], ["name", "level"])) == [(1, "C", None), (2, None, "free")]


def replay(target, batch, update):
    """Upsert row by row, as a keyed store would."""
    state = {r[0]: list(r) for r in target}
    for user_id, name, level, _, _ in sorted(batch, key=lambda r: (r[3], r[4])):
        if user_id not in state:
            state[user_id] = [user_id, name, level]
        else:
            if "name" in update:
                state[user_id][1] = name
            if "level" in update:
                state[user_id][2] = level
    return sorted((tuple(r) for r in state.values()), key=repr)


users = st.lists(
    st.tuples(st.integers(1, 4), st.sampled_from(["A", "B", None]), st.sampled_from(["free", "paid", None]), st.integers(0, 3)),
    max_size=12,
)
stored = st.dictionaries(st.integers(1, 6), st.tuples(st.sampled_from(["X", None]), st.sampled_from(["free", None])), max_size=4)


@pytest.mark.parametrize("update", [["level"], ["name", "level"]])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=users, target=stored)
def test_upsert_equals_row_by_row(spark, update, batch, target):
    batch = [(*r, i) for i, r in enumerate(batch)]
    held = [(k, *v) for k, v in target.items()]
    u = spark.createDataFrame(batch, USERS)
    t = spark.createDataFrame(held, "user_id int, name string, level string")
    once = upsert.upsert(t, u, ["user_id"], ["ts", "seq"], update)
    assert rows(once) == replay(held, batch, update)
    # A repeated batch changes nothing more.
    assert rows(upsert.upsert(once, u, ["user_id"], ["ts", "seq"], update)) == rows(once)


def test_insert_ignore_keeps_what_is_there(spark):
    t = spark.createDataFrame([(1, "old")], "k int, v string")
    u = spark.createDataFrame([(1, "new", 0), (2, "late", 5), (2, "early", 1)], "k int, v string, ts int")
    assert rows(upsert.insert_ignore(t, u, ["k"], ["ts"])) == [(2, "early")]


def test_replace_rows_takes_the_last_write_whole(spark):
    t = spark.createDataFrame([(1, "a", "b")], "k int, v string, w string")
    u = spark.createDataFrame([(1, None, "x", 2), (1, "y", "y", 1)], "k int, v string, w string, ts int")
    assert rows(upsert.replace_rows(t, u, ["k"], ["ts"])) == [(1, None, "x")]


def test_identity_is_dense_and_ordered(spark):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    # A third of the rows share the leading key.
    df = spark.createDataFrame([(7 if v % 3 == 0 else v, v) for v in values], "a int, b int").repartition(8)
    got = keys.identity_key(df, "id", ["a", "b"], start=10).collect()
    ordered = sorted(got, key=lambda r: r.id)
    assert [r.id for r in ordered] == list(range(10, 5010))
    assert [(r.a, r.b) for r in ordered] == sorted((r.a, r.b) for r in got)


def test_identity_of_nothing(spark):
    assert keys.identity_key(spark.createDataFrame([], "a int"), "id", ["a"]).collect() == []


def test_monotonic_ids_are_unique(spark):
    df = keys.monotonic_key(spark.range(1000).repartition(7), "k")
    assert df.select("k").distinct().count() == 1000


CATALOGUE = "song_id string, artist_id string, title string, name string, duration double"
SONGS = [
    ("S2", "A1", "one", "ann", 246.3), ("S1", "A1", "one", "ann", 246.3), ("S3", "A1", "one", "ann", 246.9),
    ("S4", "A2", "one", "bob", 246.3), ("S5", "A1", "two", "ann", 100.0),
]


def test_look_up_first_never_fans_out(spark):
    plays = spark.createDataFrame(
        [(1, "one", "ann", 246.3), (2, "one", "ann", 1.0), (3, None, "ann", 246.3), (4, "one", "bob", 246.3)],
        "id int, song string, artist string, length double",
    )
    catalogue = spark.createDataFrame(SONGS, CATALOGUE)
    on = {"song": "title", "artist": "name", "length": "duration"}
    found = joins.look_up_first(plays, catalogue, on, ["song_id", "artist_id"])
    assert rows(found.select("id", "song_id", "artist_id")) == [
        (1, "S1", "A1"), (2, None, None), (3, None, None), (4, "S4", "A2"),
    ]


def test_decimal_and_whole_equality(spark):
    df = spark.createDataFrame([(246.300000001, 246.3, 246.9), (None, None, None)], "a double, b double, c double")
    got = [tuple(r) for r in df.select(
        joins.decimal_equal(F.col("a"), F.col("b")), joins.decimal_equal(F.col("b"), F.col("c")),
        joins.whole_equal(F.col("b"), F.col("c")), joins.whole_equal(F.col("b"), F.lit(246)),
    ).collect()]
    assert got == [(True, False, False, True), (None, None, None, None)]


def test_orphans_include_the_null_key(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert rows(joins.orphan_keys(fact, "k", dim, "id")) == [(2,), (None,)]


def test_label_or_self(spark):
    cities = spark.createDataFrame([("ATLANTA",), ("NOWHERE",), (None,)], "city string")
    names = spark.createDataFrame([("ATLANTA", "ATL")], "name string, code string")
    assert rows(joins.label_or_self(cities, "city", names, "name", "code", "c")) == [
        ("ATLANTA", "ATL"), ("NOWHERE", "NOWHERE"), (None, None),
    ]


PEOPLE = [(1, "F"), (1, "M"), (2, "M"), (3, None), (9, "F"), (None, "F")]


def test_count_labels_counts_null_group_as_zero(spark):
    people = spark.createDataFrame(PEOPLE, "code int, gender string")
    codes = spark.createDataFrame([(1, "UK"), (2, "UK"), (3, "JP")], "code int, country string")
    assert rows(analysis.count_labels(people, "code", codes, "code", "country")) == [("JP", 1), ("UK", 3), (None, 0)]
    by = analysis.count_labels(people, "code", codes, "code", "country", by=["gender"], how="inner")
    assert rows(by) == [("JP", None, 1), ("UK", "F", 1), ("UK", "M", 2)]


def test_count_values_and_popularity(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "y int")
    assert rows(analysis.count_values(df, "y")) == [(1, 2), (2, 1), (None, 0)]
    assert [r[0] for r in analysis.by_popularity(df, "y").collect()] == [1, None, 2]


def test_count_per_member_equals_join_then_count(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (8,), (None,)], "user_id int")
    dim = spark.createDataFrame([(1, "free"), (2, "paid"), (3, "paid")], "id int, level string")
    assert rows(analysis.count_per_member(fact, "user_id", dim, "id", ["level"])) == [(1, "free", 2), (2, "paid", 1)]


def test_top_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3)], "k string, n int")
    assert [r[0] for r in analysis.top(df, 2, "n", ["k"]).collect()] == ["c", "a"]


def test_pivots(spark):
    df = spark.createDataFrame([("X", "r1", 5), ("X", "r2", 7), ("Y", "r1", 1), ("Y", "r1", 2)], "city string, race string, n int")
    names = {"r1": "one", "r2": "two", "r3": "three"}
    assert rows(analysis.pivot_counts(df, ["city"], "race", names)) == [("X", 1, 1, 0), ("Y", 2, 0, 0)]
    assert rows(analysis.pivot_values(df, ["city"], "race", "n", names)) == [("X", 5, 7, None), ("Y", 3, None, None)]


def test_look_up_in_order(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 0, "z")], "s int, i int, v string")
    assert [r[0] for r in analysis.look_up(df, ["v"], order_by=["i"], s=1).collect()] == ["a", "b"]


def test_distinct_count(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "d int")
    assert tuple(analysis.distinct_count(df, "d").first()) == (2, 3)
    assert tuple(analysis.distinct_count(df, "d", exact=False).first()) == (2, 3)


def test_quality_reports(spark):
    a = spark.createDataFrame([(1, None), (1, 2), (None, None)], "k int, v int")
    empty = a.limit(0)
    assert rows(quality.row_counts({"a": a, "e": empty})) == [("a", 3, True), ("e", 0, False)]
    assert tuple(quality.null_counts(a, ["k", "v"]).first()) == (1, 2)
    assert rows(quality.duplicate_keys(a, ["k"])) == [(1, 2)]
    assert tuple(quality.completeness(a, empty).first()) == (3, 0)
    assert tuple(quality.completeness(empty, empty).first()) == (0, 0)


def test_quality_guards_fire(spark):
    a = spark.createDataFrame([(1, None), (1, 2)], "k int, v int")
    with pytest.raises(quality.QualityError, match="no rows"):
        quality.require_rows(a.limit(0), "a")
    with pytest.raises(quality.QualityError, match="NULL"):
        quality.require_no_nulls(a, "a", ["k", "v"])
    with pytest.raises(quality.QualityError, match="same"):
        quality.require_unique(a, "a", ["k"])
    with pytest.raises(quality.QualityError, match="2 rows in the source, 0"):
        quality.require_complete(a, a.limit(0), "a")
    with pytest.raises(quality.QualityError, match="v is int, not string"):
        quality.require_schema(a, "a", schema_of("k int, v string"))
    quality.require_no_nulls(a, "a", ["k"])
    quality.require_complete(a, a, "a")
    ok = spark.createDataFrame([(1, 2)], "k int, v int")
    quality.require_spec(ok, TableSpec("t", schema_of("k int, v int"), key=("k",), not_null=("v",)))


def test_schema_report(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "k int, d date")
    assert rows(quality.schema_report({"t": df})) == [("t", 0, "k", "int"), ("t", 1, "d", "date")]
    assert quality.schema_differences(df, schema_of("k int, d date")) == []
    assert quality.schema_differences(df, schema_of("k int, e date")) == ["missing e date", "unexpected d date"]
