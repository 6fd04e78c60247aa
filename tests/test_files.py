from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from asterloom import scratch
from asterloom.operators.quality import QualityError
from asterloom.schemas import LOG_RAW, TableSpec, schema_of
from asterloom.session import estimated_bytes
from asterloom.sinks import catalog, files as sinks
from asterloom.sources import files as sources
from asterloom.sources.staging import stage_files

from .conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_json_tree_by_name(spark, local, folder):
    write(local / "2018/11/a.json", '{"userId":"39","ts":1541052920350,"page":"Home","new":1}\n{"userId":"","ts":"x"}\n')
    write(local / "2018/12/b.json", '{"page":"NextSong","length":246.3,"itemInSession":2}\n')
    write(local / "2018/12/notes.txt", "no json")
    got = sources.read_json(spark, folder, LOG_RAW, recursive=True, glob="*.json")
    assert got.schema == LOG_RAW
    assert rows(got.select("userId", "ts", "page", "length", "itemInSession")) == [
        (39, 1541052920350, "Home", None, None), (None, None, "NextSong", 246.3, 2), (None, None, None, None, None),
    ]
    by_glob = sources.read_json(spark, f"{folder}/*/11/*json", LOG_RAW)
    assert by_glob.count() == 2


def test_csv_directory_is_one_set(spark, local, folder):
    write(local / "a/1.csv", 'artist,length,other,userId\n"Faithless, live",495.3073,x,95\n,,,\n')
    write(local / "b/2.csv", 'artist,length,other,userId\n"say ""hi""",1.5E2,,5748517.0\n')
    schema = schema_of("userId int, artist string, length double")
    got = sources.read_csv(spark, folder, schema)
    assert rows(got) == [(5748517, 'say "hi"', 150.0), (95, "Faithless, live", 495.3073), (None, None, None)]


def test_csv_semicolon_and_no_header(spark, local, folder):
    write(local / "c.csv", "City;State Code\nNew York;NY\n")
    assert rows(sources.read_csv(spark, folder, schema_of("`State Code` string"), sep=";")) == [("NY",)]
    plain = sources.read_csv(spark, folder, schema_of("a string, b string"), sep=";", header=False)
    assert plain.count() == 2


@pytest.mark.parametrize("skip", [0, 1, 3])
def test_csv_skipping_lines_per_file(spark, local, folder, skip):
    for name, n in (("a", 2), ("b", 500), ("c", 0)):
        write(local / f"{name}.csv", "".join(f"head{i}|0\n" for i in range(skip)) + "".join(f"{name}{i}|{i}\n" for i in range(n)))
    got = sources.read_csv_skipping(spark, folder, schema_of("k string, v int"), skip, sep="|")
    assert rows(got) == sorted([(f"{c}{i}", i) for c, n in (("a", 2), ("b", 500)) for i in range(n)], key=repr)


def test_csv_skipping_survives_splits(spark, local, folder):
    body = "".join(f"row{i},{i}\n" for i in range(20000))
    write(local / "big.csv", "junk\nmore junk, with, commas\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        got = sources.read_csv_skipping(spark, folder, schema_of("k string, v int"), 2)
        assert got.rdd.getNumPartitions() > 1
        assert got.agg(F.count("k"), F.min("v"), F.max("v")).first()[:] == (20000, 0, 19999)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stage_files(spark, local, folder):
    write(local / "j/a.json", '{"a":{"b":"1"},"c":"x"}\n')
    write(local / "v/a.csv", "h1,h2\nh3,h4\n1,x\n")
    schema = schema_of("n int, s string")
    mapped = stage_files(spark, f"{folder}/j", "json", schema, {"s": ("$.c", "string"), "n": ("$.a.b", "int")})
    assert rows(mapped) == [(1, "x")]
    assert rows(stage_files(spark, f"{folder}/v", "csv", schema, skip_lines=2)) == [(1, "x")]
    with pytest.raises(ValueError, match="cannot stage 'xml'"):
        stage_files(spark, folder, "xml", schema)


def test_render_path():
    assert sources.render_path("log/{year}/{month}", {"year": 2018, "month": 11}) == "log/2018/11"
    with pytest.raises(KeyError):
        sources.render_path("log/{year}", {})


def test_code_list_and_process_files(spark, local, folder):
    codes = sources.code_list(spark, {1: "Air", 2: "Sea"}, "code int, travel string")
    assert rows(codes) == [(1, "Air"), (2, "Sea")]
    assert codes.schema == schema_of("code int, travel string") and estimated_bytes(codes) < 1000
    assert sources.code_list(spark, [], "code int, travel string").count() == 0
    write(local / "a.json", '{"k":1}\n{"k":1}\n')
    got = sources.process_files(lambda p: sources.read_json(spark, p, schema_of("k int")), [folder], lambda df: df.distinct())
    assert rows(got) == [(1,)]


STATES = TableSpec(
    "states", schema_of("id int, v string, state_code string"), key=("id",), partition_by=("state_code",), cluster_by=("id",)
)


def states(spark, *values):
    return spark.createDataFrame(list(values), "state_code string, v string, id bigint, extra int")


def test_partition_values_keep_their_type(spark, folder, local):
    df = states(spark, ("07", "a", 1, 0), (None, "b", 2, 0), ("GA", "c", 3, 0))
    sinks.write_table(df, STATES, folder)
    assert (local / "states/state_code=07").is_dir()
    back = sources.read_table(spark, STATES, folder)
    assert back.schema == STATES.schema
    assert rows(back) == [(1, "a", "07"), (2, "b", None), (3, "c", "GA")]


def test_small_partitions_get_one_file(spark, folder, local):
    df = spark.range(1000).repartition(8).select((F.col("id") / 500).cast("int").cast("string").alias("state_code"),
                                                 F.lit("x").alias("v"), "id")
    sinks.write_table(df, STATES, folder)
    assert [len(list(d.glob("*.parquet"))) for d in sorted((local / "states").glob("state_code=*"))] == [1, 1]


def test_write_modes(spark, folder):
    one, two = states(spark, ("A", "x", 1, 0)), states(spark, ("B", "y", 2, 0))
    sinks.write_table(one, STATES, folder)
    sinks.write_table(two, STATES, folder, "append")
    assert sources.read_table(spark, STATES, folder).count() == 2
    sinks.write_table(two, STATES, folder)
    assert rows(sources.read_table(spark, STATES, folder)) == [(2, "y", "B")]
    with pytest.raises(ValueError):
        sinks.write_table(two, STATES, folder, "ignore")


def test_load_table_takes_rows_text_or_function(spark, folder):
    states(spark, ("A", "x", 1, 0)).createOrReplaceTempView("staged_states")
    sinks.load_table(spark, STATES, folder, "SELECT * FROM staged_states")
    sinks.load_table(spark, STATES, folder, lambda s: s.table("staged_states"))
    sinks.load_table(spark, STATES, folder, spark.table("staged_states"))
    assert sources.read_table(spark, STATES, folder).count() == 3
    sinks.load_table(spark, STATES, folder, "SELECT * FROM staged_states", truncate=True)
    assert sources.read_table(spark, STATES, folder).count() == 1


def test_insert_positional(spark, folder):
    df = spark.createDataFrame([("7", "A")], "x string, y string")
    sinks.insert_positional(df, ["id", "state_code"], STATES, folder)
    assert rows(sources.read_table(spark, STATES, folder)) == [(7, None, "A")]
    with pytest.raises(ValueError, match="2 values for 1"):
        sinks.insert_positional(df, ["id"], STATES, folder)


def test_upsert_and_insert_into_stored_table(spark, folder):
    sinks.write_table(states(spark, ("A", "x", 1, 0), ("B", "y", 2, 0)), STATES, folder)
    batch = states(spark, ("Z", "x2", 1, 5), ("C", "z", 3, 1), ("D", "z2", 3, 2))
    sinks.upsert_table(batch, STATES, folder, ["extra"], ["v"])
    want = [(1, "x2", "A"), (2, "y", "B"), (3, "z2", "C")]
    assert rows(sources.read_table(spark, STATES, folder)) == want
    sinks.insert_new(states(spark, ("Q", "q", 1, 0), ("E", "e", 4, 0)), STATES, folder, ["extra"])
    assert rows(sources.read_table(spark, STATES, folder)) == want + [(4, "e", "E")]


DAYS = TableSpec("days", schema_of("k int, v string, day string"), key=("day", "k"), partition_by=("day",))


def test_upsert_rewrites_touched_partitions_only(spark, folder, local):
    def batch(*values):
        return spark.createDataFrame(list(values), "k int, v string, day string, ts int")

    sinks.write_table(batch((1, "a", "01", 0), (1, "b", "02", 0), (2, "c", None, 0)), DAYS, folder)
    before = {p.name for p in (local / "days/day=01").glob("*.parquet")}
    sinks.upsert_table(batch((1, "B", "02", 1), (3, "d", "02", 1), (3, "e", "03", 1), (2, "C", None, 2)), DAYS, folder, ["ts"], ["v"])
    assert {p.name for p in (local / "days/day=01").glob("*.parquet")} == before
    assert rows(sources.read_table(spark, DAYS, folder)) == [
        (1, "B", "02"), (1, "a", "01"), (2, "C", None), (2, "c", None), (3, "d", "02"), (3, "e", "03"),
    ]


def test_clustered_table_keeps_key_ranges_apart(spark, folder, local):
    import pyarrow.parquet as pq

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spec = TableSpec("items", schema_of("s bigint, i bigint"), cluster_by=("s", "i"))
        sinks.write_table(spark.range(4000).selectExpr("id % 100 as s", "id as i").repartition(8), spec, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spans = sorted(
        (stats.min, stats.max)
        for p in (local / "items").glob("*.parquet")
        for stats in [pq.ParquetFile(p).metadata.row_group(0).column(0).statistics]
    )
    assert len(spans) > 2 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_csv_with_another_header_is_refused(spark, local, folder):
    write(local / "1.csv", "a,b\n1,2\n")
    write(local / "2.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        sources.read_csv(spark, folder, schema_of("a int, b int")).collect()


def test_copy_keeps_layout(spark, folder, local):
    sinks.write_table(states(spark, ("07", "a", 1, 0), ("GA", "c", 3, 0)), STATES, f"{folder}/a")
    sinks.copy_tables(spark, [STATES], f"{folder}/a", f"{folder}/b")
    assert (local / "b/states/state_code=07").is_dir()
    tables = sources.read_tables(spark, [STATES], f"{folder}/b")
    assert rows(tables["states"]) == [(1, "a", "07"), (3, "c", "GA")]


def test_quoted_csv_round_trip(spark, folder, local):
    df = spark.createDataFrame([('a "quoted", x', "", 1), (None, "b", 2)], "s string, t string, n int")
    sinks.write_csv(df, f"{folder}/q")
    lines = "".join(p.read_text() for p in (local / "q").glob("*.csv")).splitlines()
    assert '"a ""quoted"", x","","1"' in lines and '"s","t","n"' in lines
    back = sources.read_csv(spark, f"{folder}/q", df.schema)
    assert rows(back) == [('a "quoted", x', None, 1), (None, "b", 2)]


def test_create_reset_drop(spark, folder):
    catalog.create_tables(spark, [STATES], folder, "t_")
    catalog.create_tables(spark, [STATES], folder, "t_")
    assert spark.table("t_states").schema.fieldNames() == STATES.schema.fieldNames()
    states(spark, ("A", "x", 1, 0)).selectExpr("cast(id as int) id", "v", "state_code").write.insertInto("t_states")
    assert rows(spark.table("t_states")) == [(1, "x", "A")]
    catalog.reset_tables(spark, [STATES], folder, "t_")
    assert spark.table("t_states").isEmpty()
    catalog.drop_tables(spark, [STATES], "t_")
    catalog.drop_tables(spark, [STATES], "t_")
    assert not spark.catalog.tableExists("t_states")


def test_bucketed_tables_join_without_shuffle(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = catalog.write_bucketed(spark.range(500).withColumnRenamed("id", "k"), "bucket_a", f"{folder}/a", ["k"], 8)
        b = catalog.write_bucketed(spark.range(0, 500, 2).withColumnRenamed("id", "k"), "bucket_b", f"{folder}/b", ["k"], 8)
        joined = a.join(b, "k").groupBy("k").count()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 250
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS bucket_a")
        spark.sql("DROP TABLE IF EXISTS bucket_b")


def test_look_up_reads_sorted_groups_only(spark, folder):
    """A clustered table's filter reaches the scan."""
    sinks.write_table(states(spark, ("A", "x", 1, 0), ("B", "y", 2, 0)), STATES, folder)
    plan = sources.read_table(spark, STATES, folder).filter("state_code = 'A' and id = 1")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,1)" in text and "state_code" in text.split("PartitionFilters")[1]


def test_materialise_fixes_values(spark):
    df = scratch.materialise(spark.range(100).withColumn("r", F.rand()))
    assert rows(df) == rows(df)


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch.scratch_path(spark, "x")
    assert path != scratch.scratch_path(spark, "x")
    if named:
        assert path.startswith(named)
    assert json.dumps(path)


def test_doubled_quotes_and_line_breaks_in_fields(spark, folder, local):
    (local / "a.csv").write_text('k,v,n\n1,"Al ""Big"" Bo, x",2\n3,"two\nlines",4\n')
    schema = schema_of("k int, v string, n int")
    got = rows(sources.read_csv(spark, folder, schema, multi_line=True))
    assert got == [(1, 'Al "Big" Bo, x', 2), (3, "two\nlines", 4)]


@pytest.mark.parametrize("text", ["a int;b string", "a int, b strng", "a", "a decimal", "a int(3,2)", "a int,"])
def test_a_badly_spelled_schema_is_an_error(text):
    with pytest.raises(ValueError, match="known type"):
        schema_of(text)


def test_schema_text_may_be_spaced_freely():
    assert schema_of("a int,b  string , `c d` decimal(18, 5)").fieldNames() == ["a", "b", "c d"]


_GUARDED = TableSpec("guarded", schema_of("k int, v string"), key=("k",), not_null=("k",))


def _guarded(spark, *values):
    return spark.createDataFrame(list(values), _GUARDED.schema)


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_null_in_a_required_column_leaves_the_table(spark, folder, mode):
    sinks.write_table(_guarded(spark, (1, "a")), _GUARDED, folder)
    with pytest.raises(Exception, match="guarded.k must not be NULL"):
        sinks.write_table(_guarded(spark, (2, "b"), (None, "c")), _GUARDED, folder, mode)
    assert rows(sources.read_table(spark, _GUARDED, folder)) == [(1, "a")]


def test_repeated_key_is_refused_on_request(spark, folder):
    sinks.write_table(_guarded(spark, (1, "a")), _GUARDED, folder, unique=True)
    with pytest.raises(QualityError, match="rows with the same"):
        sinks.write_table(_guarded(spark, (2, "b"), (2, "c")), _GUARDED, folder, unique=True)
    assert rows(sources.read_table(spark, _GUARDED, folder)) == [(1, "a")]


def test_an_upsert_lost_half_way_is_finished_by_the_next_load(spark, folder, monkeypatch):
    sinks.write_table(_guarded(spark, (1, "a"), (2, "b")), _GUARDED, folder)

    def lost(stored, spec, root, mode="overwrite"):
        spark.createDataFrame([], spec.schema).write.mode("overwrite").parquet(sinks.table_path(spec, root))
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "_store", lost)
        with pytest.raises(RuntimeError, match="lost"):
            sinks.upsert_table(_guarded(spark, (2, "B"), (3, "c")), _GUARDED, folder, ["v"], ["v"])
    assert sources.read_table(spark, _GUARDED, folder).isEmpty()
    sinks.upsert_table(_guarded(spark, (4, "d")), _GUARDED, folder, ["v"], ["v"])
    assert rows(sources.read_table(spark, _GUARDED, folder)) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_heads_longer_than_a_split(spark, local, folder):
    """A head of many splits in one file, a short file that is all head, an empty one: no row goes through Python."""
    head = "".join(f"# line {i} {'x' * 50}\n" for i in range(300))
    write(local / "a.csv", head + "".join(f"a{i},{i}\n" for i in range(2000)))
    write(local / "b.csv", "".join(f"b{i},{i}\n" for i in range(120)))
    write(local / "c.csv", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = sources.read_csv_skipping(spark, folder, schema_of("k string, v int"), 300)
        assert got.rdd.getNumPartitions() > 1
        assert rows(got) == sorted([(f"a{i}", i) for i in range(2000)], key=repr)
        assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()
        assert sources.read_csv_skipping(spark, folder, schema_of("k string, v int"), 3).count() == 297 + 2000 + 117
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
