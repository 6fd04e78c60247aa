"""Checked loads, the ledger of loaded files, counts taken by a load, and look-ups that skip what they don't need."""

from __future__ import annotations

import json
import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from asterloom.operators.counting import Counted, null_figures
from asterloom.operators.quality import QualityError
from asterloom.registry import loaded, stars
from asterloom.scans import scanned
from asterloom.schemas import SESSION_ITEMS, TableSpec, schema_of
from asterloom.sinks.checked import load_json_checked
from asterloom.sinks.files import bloom_options
from asterloom.sinks.versions import Change
from asterloom.sources.files import read_json, read_table
from asterloom.sources.ledger import LEDGER, load_unseen
from asterloom.sources.rejects import REJECTS, read_json_checked
from asterloom.versions import version_numbers

from .conftest import rows

SPEC = TableSpec("found", schema_of("id bigint, name string, at timestamp_ntz, amount decimal(10,2)"))
GOOD = '{"id": "7", "name": "x", "at": "2024-01-02 03:04:05", "amount": 1.5}'
BAD = {
    '{"id": 1, "name"': "malformed",
    "nonsense": "not an object",
    '[{"id": 1}]': "not an object",
    '"text"': "not an object",
    '{"id": "one", "at": "never", "amount": "1,5", "name": 5}': "bad id, at, amount",
    '{"id": 99999999999999999999}': "bad id",
}


def test_rejects_are_kept_with_file_and_reason(spark, local, folder):
    (local / "in").mkdir()
    (local / "in/a.json").write_text("\n".join([GOOD, *BAD, "", "   ", "{}", '{"id": null, "name": "", "more": 1}']) + "\n")
    (local / "in/b.json").write_text(GOOD)
    figures = load_json_checked(spark, f"{folder}/in", SPEC, folder)
    assert figures == {"lines": 10, "loaded": 4, "rejected": 6}
    assert [r[:2] for r in rows(read_table(spark, SPEC, folder))] == [(7, "x"), (7, "x"), (None, ""), (None, None)]
    kept = read_table(spark, REJECTS, folder)
    assert {r["line"]: r["reason"] for r in kept.collect()} == BAD
    assert {(r["source"], r["file"].rsplit("/", 1)[1]) for r in kept.collect()} == {("found", "a.json")}


def test_more_rejects_than_allowed(spark, local, folder):
    (local / "a.json").write_text("\n".join([GOOD, *BAD]))
    with pytest.raises(QualityError, match="6 of 7 lines rejected, at most 5"):
        load_json_checked(spark, f"{folder}/a.json", SPEC, folder, most_rejects=5)
    assert read_table(spark, REJECTS, folder).count() == 6
    assert not (local / "found").exists()
    assert load_json_checked(spark, f"{folder}/a.json", SPEC, folder, most_rejects=6)["loaded"] == 1


def test_checked_reading_gives_the_values_of_plain_reading(spark, local, folder):
    (local / "a.json").write_text("\n".join([GOOD, '{"ID": 3, "amount": "2"}', '{"id": "4.0", "name": "é", "extra": [1]}']))
    checked = read_json_checked(spark, f"{folder}/a.json", SPEC.schema)
    assert rows(checked.filter("_reason is null").select("name", "at", "amount")) == rows(
        read_json(spark, f"{folder}/a.json", SPEC.schema).select("name", "at", "amount"))
    empty = local / "none"
    empty.mkdir()
    (empty / "a.json").write_text("")
    assert load_json_checked(spark, str(empty), SPEC, folder) == {"lines": 0, "loaded": 0, "rejected": 0}


KEYED = TableSpec("keyed", schema_of("id bigint, v string, run string"), key=("id",))


def load_run(spark, folder, where, run):
    return load_unseen(
        spark, f"{folder}/out", f"{folder}/{where}", run,
        lambda change, paths: change.upsert(
            read_json(spark, paths, schema_of("id bigint, v string")).withColumn("run", F.lit(run)), KEYED, ["v"], ["v", "run"]),
    )


def put(path, *values):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps({"id": i, "v": v}) + "\n" for i, v in values))


def test_a_run_loads_each_file_once(spark, local, folder):
    put(local / "in/01/a.json", (1, "a"), (2, "b"))
    put(local / "in/02/a.json", (3, "c"))
    assert len(load_run(spark, folder, "in/01", "one")) == 1
    versions = version_numbers(spark, f"{folder}/out")
    assert load_run(spark, folder, "in/01", "one") == [] and version_numbers(spark, f"{folder}/out") == versions
    # A run over everything takes what is left.
    assert [p.rsplit("/", 2)[1] for p in load_run(spark, folder, "in", "all")] == ["02"]
    assert rows(read_table(spark, KEYED, f"{folder}/out")) == [(1, "a", "one"), (2, "b", "one"), (3, "c", "all")]
    assert rows(read_table(spark, LEDGER, f"{folder}/out").groupBy("run").count()) == [("all", 1), ("one", 1)]


def test_a_changed_file_is_loaded_again(spark, local, folder):
    put(local / "in/a.json", (1, "a"))
    load_run(spark, folder, "in", "one")
    put(local / "in/a.json", (1, "A"), (4, "d"))
    os.utime(local / "in/a.json", (2_000_000_000, 2_000_000_000))
    assert len(load_run(spark, folder, "in", "two")) == 1 and load_run(spark, folder, "in", "three") == []
    assert rows(read_table(spark, KEYED, f"{folder}/out")) == [(1, "A", "two"), (4, "d", "two")]


def test_runs_in_any_order_give_one_table(spark, local, folder):
    for day in ("1", "2", "3"):
        put(local / f"in/{day}/a.json", (int(day), day), (int(day) + 10, day))
    tables = []
    for order in ("123", "312"):
        for day in order:
            load_unseen(spark, f"{folder}/{order}", f"{folder}/in/{day}", day, lambda change, paths, day=day: change.insert_new(
                read_json(spark, paths, schema_of("id bigint, v string")).withColumn("run", F.lit(day)), KEYED, ["v"]))
        tables.append(rows(read_table(spark, KEYED, f"{folder}/{order}")))
    assert tables[0] == tables[1] and len(tables[0]) == 6


def test_a_lost_run_has_loaded_and_noted_nothing(spark, local, folder):
    put(local / "in/a.json", (1, "a"))

    def lost(change, paths):
        change.append(spark.createDataFrame([(1, "a", "x")], KEYED.schema), KEYED)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        load_unseen(spark, f"{folder}/out", f"{folder}/in", "one", lost)
    assert len(load_run(spark, folder, "in", "one")) == 1
    assert rows(read_table(spark, KEYED, f"{folder}/out")) == [(1, "a", "one")]


def test_a_load_counts_what_it_reads_and_writes(spark, folder):
    source = Counted(spark.range(1000).selectExpr("id % 100 as id", "if(id < 30, null, 'v') as v", "'r' as run"), **null_figures(["v"]))
    with Change(spark, folder) as change:
        assert change.insert_new(source.df, KEYED, ["v"]) == 100
    assert source.get() == {"rows": 1000, "null_v": 30}
    nothing = Counted(spark.createDataFrame([], KEYED.schema), **null_figures(["v"]))
    nothing.df.write.format("noop").mode("overwrite").save()
    assert nothing.rows == 0


def test_look_ups_skip_files_row_groups_and_pages(spark, folder):
    """200,000 rows in ranges of sessions: a look-up reads a few thousand, one of a missing key none."""
    played = spark.range(200_000).selectExpr(
        "cast(id div 10 as int) as session_id", "cast(id % 10 as int) as item_in_session", "concat('a', id % 977) as artist_name",
        "concat('s', id) as song_title", "1.0D as song_length")
    with Change(spark, folder) as change:
        change.append(played.repartition(8), SESSION_ITEMS)
    stored = read_table(spark, SESSION_ITEMS, folder)
    assert scanned(stored)["rows"] == 200_000
    one = stored.filter("session_id = 12345 and item_in_session = 3")
    assert one.count() == 1 and 0 < scanned(one)["rows"] <= 40_000
    assert scanned(stored.filter("session_id = -5"))["rows"] == 0


def test_bloom_filters_answer_for_columns_without_order(spark, folder):
    rows_ = spark.range(0, 400_000, 2).selectExpr("hash(id) as k", "id").repartition(4)
    for name, options in (("with", bloom_options(["id"])), ("without", {})):
        rows_.write.options(**options).option("parquet.block.size", 1 << 18).parquet(f"{folder}/{name}")
    read = {n: scanned(spark.read.parquet(f"{folder}/{n}").filter("id = 100001"))["rows"] for n in ("with", "without")}
    # No row has the odd number, but every row group's range holds it.
    assert read["with"] == 0 < read["without"]


@pytest.mark.parametrize("load", ["log", "reload"])
def test_raw_files_are_small_and_give_every_row(spark, folder, monkeypatch, load):
    """The raw log takes a fraction of its text on disk, no file more lines than a task should read, and no row is lost."""
    n = 6000
    part = spark.range(40).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("part "), "id").alias("p_name"), F.concat(F.lit("Brand#"), F.col("id") % 5).alias("p_brand"),
        F.lit("TYPE").alias("p_type"), F.lit(1).alias("p_size"), F.lit(9.5).alias("p_retailprice"))
    lineitem = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"),
        F.lit("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
        F.expr("timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("l_shipdate"))
    t = SimpleNamespace(spark=spark, part=part, lineitem=lineitem)
    monkeypatch.setattr(loaded, "scratch_path", lambda *_: f"{folder}/raw-files")
    monkeypatch.setattr(stars, "RAW_LINES", 100, raising=False)
    plain = sum(len(r.value) + 1 for r in stars._log(t).select(F.to_json(F.struct("*")).alias("value")).collect())
    assert (loaded._staged_log(t) if load == "log" else loaded.star_reload(t)).count() == n
    raw = Path(folder.removeprefix("file:")) / "raw-files" / ("" if load == "log" else "raw/log")
    files = [p for p in raw.iterdir() if p.name.startswith("part-")]
    assert len(files) >= n // 100
    assert sum(p.stat().st_size for p in files) < plain / 3
