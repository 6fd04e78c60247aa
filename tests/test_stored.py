"""Stored files against their declaration."""

from __future__ import annotations

import pytest

from asterloom.operators.quality import QualityError
from asterloom.operators.stored import require_stored_schema, stored_files, stored_schema_differences
from asterloom.schemas import schema_of

KINDS = schema_of("id bigint, price double")


def write(spark, path, select, mode="append"):
    spark.range(4).selectExpr(*select).coalesce(1).write.mode(mode).parquet(path)


def test_one_file_of_another_type_is_named(spark, folder):
    for day in range(5):
        write(spark, f"{folder}/t/day={day}", ["id", "cast(id as double) price"])
    assert len(stored_files(spark, f"{folder}/t")) == 5
    assert stored_schema_differences(spark, f"{folder}/t", KINDS) == []
    require_stored_schema(spark, f"{folder}/t", "t", KINDS)
    write(spark, f"{folder}/t/day=3", ["id", "cast(id as string) price"])
    (file, difference), = stored_schema_differences(spark, f"{folder}/t", KINDS)
    assert "/day=3/" in file and difference == "price is string, not double"
    with pytest.raises(QualityError, match="t: price is string, not double in .*/day=3/"):
        require_stored_schema(spark, f"{folder}/t", "t", KINDS)


def test_more_and_fewer_columns(spark, folder):
    write(spark, f"{folder}/t", ["id", "cast(id as double) price"])
    write(spark, f"{folder}/t", ["id", "cast(id as double) price", "1 as extra"])
    (_, difference), = stored_schema_differences(spark, f"{folder}/t", KINDS)
    assert difference == "unexpected extra int"
    write(spark, f"{folder}/u", ["id"])
    (_, difference), = stored_schema_differences(spark, f"{folder}/u", KINDS)
    assert difference == "missing price double"


def test_an_empty_folder_has_no_differences(spark, folder):
    assert stored_schema_differences(spark, folder, KINDS) == []


def test_released_tables_are_gone(spark, folder):
    from asterloom.scratch import exists, materialise, release

    table = materialise(spark.range(3), "spent")
    path = table._scratch_path
    assert exists(spark, path) and table.count() == 3
    release(table)
    assert not exists(spark, path)
