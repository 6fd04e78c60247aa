"""Casts that turn bad input into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: ColumnOrName) -> Column:
    return _col(c).try_cast("int")


def to_long(c: ColumnOrName) -> Column:
    return _col(c).try_cast("bigint")


def to_float(c: ColumnOrName) -> Column:
    return _col(c).try_cast("float")


# What a number may look like. A cast that fails costs an exception per value,
# many times the price of this test, and raw files are full of blanks.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_NUMBER_OR_NAN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"


def text_to_whole(c: ColumnOrName, dtype: str | T.DataType = "bigint") -> Column:
    """Whole number from text that may be spelled `5748517.0` or `1.5E12`.

    A direct cast of such text gives NULL; the decimal step keeps all digits.
    """
    return F.when(_col(c).rlike(_NUMBER), _col(c).try_cast("decimal(38,18)").try_cast(dtype))


def text_to_real(c: ColumnOrName, dtype: str | T.DataType = "double") -> Column:
    """Float, double or decimal from text."""
    return F.when(_col(c).rlike(_NUMBER_OR_NAN), _col(c).try_cast(dtype))


def text_to(c: ColumnOrName, dtype: T.DataType) -> Column:
    """Text as any declared type, NULL where it does not fit."""
    if isinstance(dtype, _WHOLE):
        return text_to_whole(c, dtype)
    if isinstance(dtype, T.FractionalType):
        return text_to_real(c, dtype)
    return _col(c) if isinstance(dtype, T.StringType) else _col(c).try_cast(dtype)


def whole_rounded(c: ColumnOrName) -> Column:
    """Scale-0 decimal, rounded half up (what a SQL cast does)."""
    return _col(c).try_cast("decimal(18,0)")


def whole_truncated(c: ColumnOrName) -> Column:
    """Whole number, fraction dropped (what a bulk load does)."""
    return _col(c).try_cast("bigint")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Align by name, cast to the declared types, put columns in order.

    A declared column the input lacks is a mistake of the caller, not a NULL.
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    absent = [f.name for f in schema.fields if f.name.lower() not in have]
    if absent:
        raise ValueError(f"columns missing from input: {absent}")
    return df.select([_typed(have[f.name.lower()], f) for f in schema.fields])


def _typed(source: T.StructField, target: T.StructField) -> Column:
    c = F.col(f"`{source.name}`")
    if isinstance(source.dataType, T.StringType):
        c = text_to(c, target.dataType)
    elif source.dataType != target.dataType:
        c = c.try_cast(target.dataType)
    return c.alias(target.name)
