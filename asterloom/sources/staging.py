"""Staging of JSON text through a field-to-column mapping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import conform, text_to, text_to_whole
from ..functions.timeparts import from_epoch_millis
from ..schemas import schema_of
from .files import read_csv, read_csv_skipping, read_json

EPOCH_MILLIS = "epoch_millis"
_STEP = re.compile(r"\.([A-Za-z_]\w*)|\['([^']+)'\]")


def path_steps(path: str) -> tuple[str, ...]:
    """Field names of `$.a.b` or `$['a']['b']`."""
    body = path[1:] if path.startswith("$") else ""
    steps, at = [], 0
    for m in _STEP.finditer(body):
        if m.start() != at:
            break
        steps.append(m.group(1) or m.group(2))
        at = m.end()
    if not steps or at != len(body):
        raise ValueError(f"not a field path: {path!r}")
    return tuple(steps)


def _nested_schema(paths: Sequence[tuple[str, ...]]) -> T.StructType:
    """Struct that holds a text leaf per path."""
    children: dict[str, list[tuple[str, ...]]] = {}
    for head, *rest in paths:
        children.setdefault(head, []).append(tuple(rest))
    fields = []
    for name, tails in children.items():
        if () in tails and any(tails):
            raise ValueError(f"{name!r} is mapped both as a value and as an object")
        inner = T.StringType() if () in tails else _nested_schema(tails)
        fields.append(T.StructField(name, inner))
    return T.StructType(fields)


def _as_type(c: Column, dtype: str) -> Column:
    if dtype == EPOCH_MILLIS:
        return from_epoch_millis(text_to_whole(c))
    return text_to(c, schema_of(f"c {dtype}")[0].dataType)


def stage_json(
    df: DataFrame,
    column: str,
    mapping: Mapping[str, tuple[str, str]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed columns from a column of JSON text, in the order of `mapping`.

    `mapping` is `{column: (path, type)}`. The text is parsed once for all
    paths; a value that does not fit its type becomes NULL. Store the result
    (`materialise`) before filtering it: Spark moves a filter below the parse,
    and then parses once more for each column the filter names.
    """
    steps = {name: path_steps(path) for name, (path, _) in mapping.items()}
    schema = _nested_schema(list(dict.fromkeys(steps.values())))
    parsed = df.select(*keep, F.from_json(column, schema).alias("_j"))
    picked = []
    for name, (_, dtype) in mapping.items():
        c = F.col("_j")
        for step in steps[name]:
            c = c.getField(step)
        picked.append(_as_type(c, dtype).alias(name))
    return parsed.select(*keep, *picked)


def stage_json_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    mapping: Mapping[str, tuple[str, str]],
    recursive: bool = False,
) -> DataFrame:
    """`stage_json` over files of JSON lines."""
    lines = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(paths)
    return stage_json(lines, "value", mapping)


STAGE_FORMATS = ("json", "csv")


def stage_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_type: str,
    schema: T.StructType,
    mapping: Mapping[str, tuple[str, str]] | None = None,
    sep: str = ",",
    skip_lines: int = 1,
) -> DataFrame:
    """One staging table from raw files.

    JSON goes through `mapping`, or by field name without one. CSV skips
    `skip_lines` lines per file. An unknown type is refused before anything
    is read or cleared.
    """
    if file_type == "json":
        if mapping is None:
            return read_json(spark, paths, schema, recursive=True)
        return conform(stage_json_files(spark, paths, mapping, recursive=True), schema)
    if file_type == "csv":
        if skip_lines == 1:
            return read_csv(spark, paths, schema, sep=sep)
        return read_csv_skipping(spark, paths, schema, skip_lines, sep=sep)
    raise ValueError(f"cannot stage {file_type!r}; known types are {STAGE_FORMATS}")
