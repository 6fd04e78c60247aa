"""Versions of stored tables: readers see old or new, never a mixture, whatever is lost half way."""

from __future__ import annotations

import threading

import pytest

from asterloom.operators.quality import QualityError
from asterloom.schemas import TableSpec, schema_of
from asterloom.sinks import files as sinks
from asterloom.sinks import versions as writing
from asterloom.sinks.versions import Change, VersionConflict, change_table, clean_up
from asterloom.sources.files import read_table, read_tables
from asterloom.versions import current, version_numbers
from .conftest import rows

PLAIN = TableSpec("plain", schema_of("k int, v string"), key=("k",), not_null=("k",))
OTHER = TableSpec("other", schema_of("k int, v string"), key=("k",))
DAYS = TableSpec("days", schema_of("k int, v string, day string"), key=("day", "k"), partition_by=("day",))


def made(spark, spec, *values):
    return spark.createDataFrame(list(values), spec.schema)


def put(spark, root, spec, *values):
    with Change(spark, root) as change:
        change.replace(made(spark, spec, *values), spec)


def stored_bytes(local):
    return {p: p.read_bytes() for p in sorted(local.rglob("*")) if p.is_file()}


def test_reader_keeps_the_version_it_began_with(spark, folder):
    put(spark, folder, PLAIN, (1, "a"), (2, "b"))
    old = read_table(spark, PLAIN, folder)
    with Change(spark, folder) as change:
        assert change.replace(change.table(PLAIN).selectExpr("k + 10 as k", "v"), PLAIN) == 2
        # Written, not published.
        assert rows(read_table(spark, PLAIN, folder)) == [(1, "a"), (2, "b")]
        assert rows(change.table(PLAIN)) == [(11, "a"), (12, "b")]
    assert rows(old) == [(1, "a"), (2, "b")]
    assert rows(read_table(spark, PLAIN, folder)) == [(11, "a"), (12, "b")]


def test_readers_during_replacements_see_one_whole_version(spark, folder):
    """A thread reads all the time while the table is replaced again and again."""
    put(spark, folder, PLAIN, *[(k, "0") for k in range(50)])
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(rows(read_table(spark, PLAIN, folder).groupBy("v").count()))

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(1, 6):
            put(spark, folder, PLAIN, *[(k, str(n)) for k in range(50 + n)])
    finally:
        done.set()
        reader.join()
    assert seen and all(len(s) == 1 and s[0][1] == 50 + int(s[0][0]) for s in seen)
    assert [int(s[0][0]) for s in seen] == sorted(int(s[0][0]) for s in seen)


@pytest.mark.parametrize("lost", ["write", "publish"])
def test_a_killed_replacement_changes_nothing(spark, folder, monkeypatch, lost):
    """The process dies: nothing after the loss runs, not even the clean-up of the block."""
    put(spark, folder, PLAIN, (1, "a"))
    put(spark, folder, OTHER, (5, "e"))

    def die(*_):
        raise KeyboardInterrupt

    change = Change(spark, folder)
    change.replace(made(spark, PLAIN, (2, "b")), PLAIN)
    with monkeypatch.context() as m:
        m.setattr(writing, "publish" if lost == "publish" else "required", die)
        with pytest.raises(KeyboardInterrupt):
            change.publish() if lost == "publish" else change.replace(made(spark, OTHER, (6, "f")), OTHER)
    both = read_tables(spark, [PLAIN, OTHER], folder)
    assert rows(both["plain"]) == [(1, "a")] and rows(both["other"]) == [(5, "e")]
    put(spark, folder, PLAIN, (3, "c"))
    assert rows(read_table(spark, PLAIN, folder)) == [(3, "c")]
    assert len(clean_up(spark, folder)) >= 2
    assert rows(read_table(spark, PLAIN, folder)) == [(3, "c")] and rows(read_table(spark, OTHER, folder)) == [(5, "e")]


def test_refused_rows_leave_every_byte(spark, folder, local):
    put(spark, folder, PLAIN, (1, "a"))
    before = stored_bytes(local)
    for bad, error in (([(2, "b"), (2, "c")], QualityError), ([(None, "x")], Exception), ([(1, "again")], QualityError)):
        with pytest.raises(error), Change(spark, folder) as change:
            change.append(made(spark, PLAIN, *bad), PLAIN)
            change.append(made(spark, OTHER, (9, "fine")), OTHER)
            change.audit(PLAIN)
    assert stored_bytes(local) == before


def test_empty_tables_are_refused_on_audit(spark, folder):
    with pytest.raises(QualityError, match="holds no rows"), Change(spark, folder) as change:
        change.replace(made(spark, PLAIN), PLAIN)
        change.audit(PLAIN)
    with Change(spark, folder) as change:
        change.replace(made(spark, PLAIN), PLAIN)
        change.replace(made(spark, DAYS), DAYS)
        change.audit(PLAIN, may_be_empty=True)
    assert read_table(spark, PLAIN, folder).isEmpty() and read_table(spark, DAYS, folder).isEmpty()


def test_upsert_and_insert_by_touched_partition(spark, folder, local):
    put(spark, folder, DAYS, (1, "a", "01"), (1, "b", "02"), (2, "c", None), (7, "x", ""))
    first = current(spark, folder).tables["days"].loads
    with Change(spark, folder) as change:
        batch = made(spark, DAYS, (1, "B", "02"), (3, "d", "02"), (3, "e", "03"))
        assert change.upsert(batch, DAYS, ["v"], ["v"]) == 3
        change.audit(DAYS)
    assert rows(read_table(spark, DAYS, folder)) == [
        (1, "B", "02"), (1, "a", "01"), (2, "c", None), (3, "d", "02"), (3, "e", "03"), (7, "x", None),
    ]
    state = current(spark, folder).tables["days"]
    assert state.loads[:1] == first and len(state.loads) == 2 and len(state.since) == 2
    # Replaced files aren't read: of three files of the first load two are left, two are new.
    read = read_table(spark, DAYS, folder)
    assert len({r[0] for r in read.selectExpr("input_file_name()").collect()}) == 4
    with Change(spark, folder) as change:
        assert change.insert_new(made(spark, DAYS, (1, "Q", "01"), (4, "f", "01")), DAYS, ["v"]) == 1
    assert (4, "f", "01") in rows(read_table(spark, DAYS, folder)) and read_table(spark, DAYS, folder).count() == 7


def test_appends_are_compared_with_touched_partitions_only(spark, folder):
    put(spark, folder, DAYS, (1, "a", "01"), (1, "b", "02"))
    with pytest.raises(QualityError, match="already holds"), Change(spark, folder) as change:
        change.append(made(spark, DAYS, (1, "c", "02")), DAYS)
        change.audit(DAYS)
    with Change(spark, folder) as change:
        change.append(made(spark, DAYS, (2, "c", "02")), DAYS)
        change.audit(DAYS)
        stored = writing.near(change.table(DAYS), change.staged(DAYS), DAYS)
        assert {r["f"].split("day=")[1][:2] for r in stored.selectExpr("input_file_name() as f").collect()} == {"02"}
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_two_runs_at_once(spark, folder):
    """Of two changes of one table the second is refused; changes of different tables both count."""
    put(spark, folder, PLAIN, (1, "a"))
    one, two, three = (Change(spark, folder) for _ in range(3))
    one.append(made(spark, PLAIN, (2, "b")), PLAIN)
    two.append(made(spark, PLAIN, (3, "c")), PLAIN)
    three.append(made(spark, OTHER, (4, "d")), OTHER)
    one.publish()
    with pytest.raises(VersionConflict):
        two.publish()
    three.publish()
    assert rows(read_table(spark, PLAIN, folder)) == [(1, "a"), (2, "b")]
    assert rows(read_table(spark, OTHER, folder)) == [(4, "d")]
    assert version_numbers(spark, folder) == [1, 2, 3]


def test_a_table_without_versions_is_taken_over(spark, folder):
    sinks.write_table(made(spark, DAYS, (1, "a", "07"), (2, "b", None)), DAYS, folder)
    change_table(spark, folder, DAYS, lambda c: c.upsert(made(spark, DAYS, (1, "A", "07"), (3, "c", "08")), DAYS, ["v"], ["v"]))
    assert rows(read_table(spark, DAYS, folder)) == [(1, "A", "07"), (2, "b", None), (3, "c", "08")]
    clean_up(spark, folder)
    assert rows(read_table(spark, DAYS, folder)) == [(1, "A", "07"), (2, "b", None), (3, "c", "08")]


NUMBERED = TableSpec("numbered", schema_of("n bigint, v string"), key=("n",))


def test_numbers_go_on_and_a_lost_run_takes_none(spark, folder):
    def load(*values, lost=False):
        with Change(spark, folder) as change:
            change.append_numbered(spark.createDataFrame([(v,) for v in values], "v string"), NUMBERED, "n", ["v"], start=5)
            change.audit(NUMBERED)
            if lost:
                raise RuntimeError("lost")

    load("b", "a")
    with pytest.raises(RuntimeError, match="lost"):
        load("x", "y", "z", lost=True)
    load("d", "c")
    assert rows(read_table(spark, NUMBERED, folder)) == [(5, "a"), (6, "b"), (7, "c"), (8, "d")]
    put(spark, folder, PLAIN, (1, "a"))
    load("e")
    assert rows(read_table(spark, NUMBERED, folder))[-1] == (9, "e")
