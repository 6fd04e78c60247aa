from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from asterloom.functions import casts, text, timeparts
from asterloom.schemas import schema_of
from asterloom.sources.labels import parse_comment_list, parse_value_blocks, pick_list, reverse_list
from asterloom.sources.staging import path_steps, stage_json

from .conftest import rows


def one(spark, schema, *values):
    return spark.createDataFrame([values], schema)


def test_casts_give_null_for_bad_input(spark):
    df = spark.createDataFrame([("12",), ("x",), ("",), (None,), ("12.7",), ("1.5E3",)], "s string")
    got = [tuple(r) for r in df.select(casts.to_int("s"), casts.text_to_whole("s"), casts.to_float("s")).collect()]
    assert got == [(12, 12, 12.0), (None, None, None), (None, None, None), (None, None, None),
                   (None, 12, pytest.approx(12.7)), (None, 1500, 1500.0)]


def test_text_to_whole_keeps_every_digit(spark):
    df = one(spark, "s string", "9223372036854775807")
    assert df.select(casts.text_to_whole("s")).first()[0] == 9223372036854775807


def test_scale_zero_rounds_or_truncates(spark):
    df = spark.createDataFrame([(246.3,), (246.9,), (0.5,)], "d double")
    got = [tuple(r) for r in df.select(casts.whole_rounded("d"), casts.whole_truncated("d")).collect()]
    assert got == [(Decimal(246), 246), (Decimal(247), 246), (Decimal(1), 0)]


def test_conform_orders_casts_and_refuses_missing(spark):
    df = spark.createDataFrame([("7", "1.5", "x")], "b string, a string, extra string")
    got = casts.conform(df, schema_of("a double, b int"))
    assert got.schema == schema_of("a double, b int")
    assert tuple(got.first()) == (1.5, 7)
    with pytest.raises(ValueError, match="missing"):
        casts.conform(df, schema_of("c int"))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_does_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = one(spark, "ms bigint", 1541052920350)
        r = df.select(timeparts.from_epoch_millis("ms"), timeparts.from_epoch_seconds("ms")).first()
        assert r[0] == dt.datetime(2018, 11, 1, 6, 15, 20, 350000)
        assert r[1] == dt.datetime(2018, 11, 1, 6, 15, 20)
        back = df.select(timeparts.to_epoch_millis(timeparts.from_epoch_millis("ms"))).first()
        assert back[0] == 1541052920350
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_weekday_styles(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 11, 4, 2, 30),), (dt.datetime(2018, 11, 1),)], "t timestamp_ntz")
    got = [tuple(r) for r in df.select(*[timeparts.weekday("t", s) for s in timeparts.WEEKDAY_STYLES]).collect()]
    assert got == [("Sunday", 0, 1), ("Thursday", 4, 5)]
    with pytest.raises(ValueError):
        timeparts.weekday("t", "iso")


def test_calendar_dim_has_each_time_once(spark):
    t = dt.datetime(2018, 12, 31, 23, 5)
    df = spark.createDataFrame([(t,), (t,), (None,)], "t timestamp_ntz")
    assert rows(timeparts.calendar_dim(df, "t")) == [(t, 23, 31, 1, 12, 2018, "Monday")]


def test_sas_days(spark):
    df = spark.createDataFrame([(20574.0,), (None,), (0.0,)], "d double")
    got = [r[0] for r in df.select(timeparts.from_sas_days("d")).collect()]
    assert got == [dt.date(2016, 4, 30), None, dt.date(1960, 1, 1)]


def test_text_to_date(spark):
    df = spark.createDataFrame([("1743-11-01",), ("never",), (None,)], "s string")
    assert [r[0] for r in df.select(timeparts.text_to_date("s")).collect()] == [dt.date(1743, 11, 1), None, None]


def test_splitting(spark):
    df = spark.createDataFrame([("-84.4, 33.6", "US-GA"), ("bad", "GA"), (None, None)], "c string, r string")
    lon, lat = text.lon_lat("c")
    got = [tuple(r) for r in df.select(lon, lat, text.region_part("r")).collect()]
    assert got[0] == (pytest.approx(-84.4), pytest.approx(33.6), "GA")
    assert got[1:] == [(None, None, None), (None, None, None)]


def test_separator_is_no_pattern(spark):
    df = one(spark, "s string", "a.b|c")
    assert tuple(df.select(text.split_part("s", ".", 0), text.split_part("s", "|", 1)).first()) == ("a", "c")


def test_clean_label(spark):
    df = spark.createDataFrame([("\t'QUAY BAY, ZZ     ' ;",), (" O'HARE ",)], "s string")
    assert [r[0] for r in df.select(text.clean_label("s")).collect()] == ["QUAY BAY, ZZ", "O'HARE"]


def test_md5_key_null_rules(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    safe = [r[0] for r in df.select(text.md5_key(["x", "y"])).collect()]
    assert None not in safe and len(set(safe)) == 3
    plain = [r[0] for r in df.select(text.md5_key(["x", "y"], sep="", null_safe=False)).collect()]
    assert plain[0] is None and plain[2] == "187ef4436122d1cc2f40dc2b92f0eba0"


def test_row_key_tells_null_columns_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(text.row_key(["x", "y", "z"]).alias("k")).distinct().count() == 2


LABELS = """libname library 'x' ;
/* COUNTRIES - a comment with value and 7 = 'NOT THIS' */
  value i94cntyl
   711 =  'NORTHMARK by Ferry, and Not Named (N-1, no other ways)'
   412 =  'EASTMARK'
   903 =  'Unlisted Place (903)' ;

/* ports */
  value $i94prtl
   'QAB'\t=\t'QUAY BAY, ZZ             '
   'ONE'\t=\t'O''NEIL PIER, ZY     '
   'XP '\t=\t'Pier Not Named (XP)'
   'HBR' \t=\t'HARBOUR, ZX'
   'HB2'\t=\t'HARBOUR, ZX; second'
;
value i94model
\t4 = 'Ferry'
\t8 = 'On foot' ;
value i94addrl
\t'ZX'='ZEXIA'
\t'ZY'='ZEYLAND'\x20
\t'98'='Somewhere Else' ;

/* I94VISA - a list that stands in a comment only:
   5 = Trade
   6 = Holiday
   7 = School
*/
"""


def test_label_blocks(spark):
    scripts = one(spark, "value string", LABELS)
    parsed = parse_value_blocks(scripts)
    assert rows(pick_list(parsed, "i94cntyl", "country", "int")) == [
        (412, "EASTMARK"), (711, "NORTHMARK by Ferry, and Not Named (N-1, no other ways)"), (903, "Unlisted Place (903)"),
    ]
    assert rows(pick_list(parsed, "i94prtl", "port")) == [
        ("HB2", "HARBOUR, ZX; second"), ("HBR", "HARBOUR, ZX"), ("ONE", "O'NEIL PIER, ZY"), ("QAB", "QUAY BAY, ZZ"),
        ("XP", "Pier Not Named (XP)"),
    ]
    assert rows(pick_list(parsed, "i94model", "travel", "int")) == [(4, "Ferry"), (8, "On foot")]
    assert rows(pick_list(parsed, "i94addrl", "state")) == [("98", "Somewhere Else"), ("ZX", "ZEXIA"), ("ZY", "ZEYLAND")]


def test_comment_list(spark):
    parsed = parse_comment_list(one(spark, "value string", LABELS), "I94VISA")
    assert rows(pick_list(parsed, "i94visa", "visa", "int")) == [(5, "Trade"), (6, "Holiday"), (7, "School")]


def test_reverse_list_later_wins(spark):
    ports = parse_value_blocks(one(spark, "value string", LABELS)).filter(F.col("block") == "i94prtl")
    assert dict(rows(reverse_list(ports, "label", "pos")))["HARBOUR"] == "HB2"


def test_repeated_code_keeps_last_label(spark):
    script = one(spark, "value string", "value x\n 1 = 'old'\n 2 = 'two'\n 1 = 'new' ;")
    assert rows(pick_list(parse_value_blocks(script), "x", "label", "int")) == [(1, "new"), (2, "two")]


def test_path_steps():
    assert path_steps("$.a.b") == ("a", "b")
    assert path_steps("$['a b']['c']") == ("a b", "c")
    for bad in ("a.b", "$", "$.a[0]", "$.a b"):
        with pytest.raises(ValueError):
            path_steps(bad)


def test_stage_json_mapping(spark):
    lines = spark.createDataFrame(
        [('{"userId":"39","n":{"ts":1541052920350},"length":246.3}',), ('{"userId":"","n":{}}',), ("broken",)], "value string"
    )
    mapping = {
        "length": ("$.length", "double"), "user_id": ("$['userId']", "int"),
        "start": ("$.n.ts", "epoch_millis"), "ts": ("$.n.ts", "bigint"),
    }
    got = stage_json(lines, "value", mapping)
    assert got.columns == ["length", "user_id", "start", "ts"]
    assert [tuple(r) for r in got.collect()] == [
        (246.3, 39, dt.datetime(2018, 11, 1, 6, 15, 20, 350000), 1541052920350),
        (None, None, None, None), (None, None, None, None),
    ]
    with pytest.raises(ValueError, match="both"):
        stage_json(lines, "value", {"a": ("$.n", "string"), "b": ("$.n.ts", "string")})


def test_text_to_real_accepts_what_a_cast_does(spark):
    df = spark.createDataFrame([(s,) for s in ("246.3", " 1e3 ", "-.5", "5.", "NaN", "-Infinity", "", "x", "1 2", None)], "s string")
    got = [tuple(r) for r in df.select(casts.text_to_real("s").cast("string"), F.col("s").try_cast("double").cast("string")).collect()]
    assert [a for a, _ in got] == [b for _, b in got]
