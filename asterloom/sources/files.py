"""JSON, CSV and Parquet readers with declared schemas."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import conform
from ..schemas import TableSpec, schema_of
from ..versions import current, read_state


# A quote inside a quoted field is doubled, as the writers do it.
QUOTING = {"quote": '"', "escape": '"'}


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def read_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    recursive: bool = False,
    glob: str | None = None,
) -> DataFrame:
    """JSON lines, fields matched by name, as `schema`.

    Values are taken as text and then cast, so `"39"` and `39` both become a
    number and a bad value becomes NULL. `paths` may hold globs; `recursive`
    reads a whole tree instead.
    """
    reader = spark.read.schema(as_text(schema)).option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return conform(reader.json(paths), schema)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    recursive: bool = True,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """CSV files or whole directories of them as one set of `schema`.

    With a header, columns are found by name and files may hold more columns
    than declared; a file whose header differs from the first one's fails the
    read. Without a header, `schema` lists all columns in order. Types are
    never inferred. Empty text reads as NULL. A doubled quote inside a quoted
    field is one quote. `multi_line` is for files with line breaks in fields;
    each of them is read by one task.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("header", header)
        .option("enforceSchema", not header)
        .option("recursiveFileLookup", str(recursive).lower())
        .option("multiLine", multi_line)
        .options(**{**QUOTING, **options})
    )
    if not header:
        reader = reader.schema(as_text(schema))
    return conform(reader.csv(paths), schema)


def read_csv_skipping(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    skip_lines: int,
    sep: str = ",",
) -> DataFrame:
    """CSV whose first `skip_lines` lines of every file are not data.

    Files stay splittable. A first pass counts the lines of every split; the
    counts of a file's earlier splits tell how much of the head lies in each,
    so a head may be longer than a split. The second pass leaves out the lines
    that are numbered below that. One row per split that has a part of a head
    is joined, and no row goes through Python. Fields must not contain line
    breaks.
    """
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    lines = spark.read.text(paths).select("value", *split, F.monotonically_increasing_id().alias("_n"))
    counted = lines.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_many"), F.min("_n").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_many").over(earlier), F.lit(0))
    heads = counted.withColumn("_skip", F.least(F.lit(skip_lines) - before, "_many")).filter(F.col("_skip") > 0)
    heads = heads.select("_file", "_start", (F.col("_first") + F.col("_skip")).alias("_from"))
    data = lines.join(heads, ["_file", "_start"], "left").filter(F.col("_from").isNull() | (F.col("_n") >= F.col("_from")))
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = data.select(F.from_csv("value", ddl, {"sep": sep, **QUOTING}).alias("r"))
    return conform(parsed.select("r.*"), schema)


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet, whole or partitioned.

    Pass the schema for a partitioned table: without it the partition value
    `07` comes back as the number 7.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_table(spark: SparkSession, spec: TableSpec, root: str) -> DataFrame:
    """One declared table under `root`, in its newest version if it has versions."""
    return read_tables(spark, [spec], root)[spec.name]


def read_tables(spark: SparkSession, specs: Sequence[TableSpec], root: str) -> dict[str, DataFrame]:
    """Every declared table under `root`, by name, all of one version. Reads metadata only."""
    version = current(spark, root)
    return {
        spec.name: read_state(spark, spec, root, version.tables[spec.name]) if spec.name in version.tables
        else read_parquet(spark, f"{root.rstrip('/')}/{spec.name}", spec.schema)
        for spec in specs
    }


def render_path(template: str, values: Mapping[str, object]) -> str:
    """`log_data/{year}/{month}` for one run; a missing value is an error."""
    return template.format(**values)


def code_list(
    spark: SparkSession,
    pairs: Mapping[object, str] | Sequence[tuple[object, str]],
    schema: str | T.StructType,
) -> DataFrame:
    """A small code table from literal pairs.

    Built from Arrow, so that Spark knows its size and can broadcast it; from
    plain rows it would be of unknown size, and the other side of a join
    would be shuffled.
    """
    rows = list(pairs.items()) if isinstance(pairs, Mapping) else list(pairs)
    schema = schema_of(schema) if isinstance(schema, str) else schema
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.fieldNames())}
    return spark.createDataFrame(pa.table(columns), schema)


def process_files(
    read: Callable[[Sequence[str]], DataFrame], paths: Sequence[str], processor: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Files through a processor given as a function, all files at once."""
    return read(paths).transform(processor)
