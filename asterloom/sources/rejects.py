"""JSON lines that can't be loaded: kept with file and reason, counted, limited."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import text_to
from ..schemas import TableSpec, schema_of
from .files import as_text

REJECTS = TableSpec("rejects", schema_of("source string, file string, line string, reason string"))
FILE, LINE, REASON = "_file", "_line", "_reason"
_CORRUPT = "_corrupt"
MALFORMED, NO_OBJECT = "malformed", "not an object"


def read_json_checked(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, recursive: bool = False, glob: str | None = None
) -> DataFrame:
    """JSON lines as `schema`, and for each its file, its text and the reason to reject it.

    `_reason` is NULL for a good line, whose `_line` is NULL too. Others are
    `malformed`, `not an object`, or `bad a, b`: the fields whose text is no value
    of their type, where `read_json` would silently give NULL. Lines of white
    space are no lines. Parsed once; a file is split as any text file.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(paths).select(F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE))
    text = T.StructType([*as_text(schema).fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.filter(F.col(LINE).rlike(r"\S")).withColumn("_r", F.from_json(LINE, text, options))
    typed = parsed.select(LINE, FILE, "_r", *[text_to(F.col("_r").getField(f.name), f.dataType).alias(f.name) for f in schema.fields])
    bad = [
        F.when(F.col("_r").getField(f.name).rlike(r"\S") & F.col(f"`{f.name}`").isNull(), f.name)
        for f in schema.fields if not isinstance(f.dataType, T.StringType)
    ]
    wrong = F.array_join(F.array_compact(F.array(*bad)), ", ") if bad else F.lit("")
    reason = (
        F.when(~F.ltrim(LINE).startswith("{"), NO_OBJECT)
        .when(F.col("_r").isNull() | F.col("_r").getField(_CORRUPT).isNotNull(), MALFORMED)
        .when(wrong != "", F.concat(F.lit("bad "), wrong))
    )
    judged = typed.withColumn(REASON, reason)
    return judged.select(
        *[F.col(f"`{n}`") for n in schema.fieldNames()], FILE, F.when(F.col(REASON).isNotNull(), F.col(LINE)).alias(LINE), REASON)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(FILE, LINE, REASON)


def rejected(checked: DataFrame, source: str) -> DataFrame:
    """The lines to keep apart, as rows of `REJECTS`."""
    return checked.filter(F.col(REASON).isNotNull()).select(
        F.lit(source).alias("source"), F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.col(REASON).alias("reason"))
