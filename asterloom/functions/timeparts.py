"""Calendar parts and conversions of stored day and epoch numbers.

Results are zone-free timestamps computed without the session time zone, so
the same input gives the same output on every worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .casts import ColumnOrName, _col

WEEKDAY_STYLES = ("name", "sun0", "sun1")
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def weekday(ts: ColumnOrName, style: str = "name") -> Column:
    """English name, or a number with Sunday as 0 (`sun0`) or 1 (`sun1`)."""
    if style == "name":
        return F.date_format(_col(ts).cast("date"), "EEEE")
    if style == "sun0":
        return F.dayofweek(_col(ts)) - 1
    if style == "sun1":
        return F.dayofweek(_col(ts))
    raise ValueError(f"weekday style must be one of {WEEKDAY_STYLES}, not {style!r}")


def calendar_columns(ts: ColumnOrName, weekday_style: str = "name") -> dict[str, Column]:
    """hour, day, ISO week, month, year and weekday of one timestamp."""
    c = _col(ts)
    return {
        "hour": F.hour(c),
        "day": F.dayofmonth(c),
        "week": F.weekofyear(c),
        "month": F.month(c),
        "year": F.year(c),
        "weekday": weekday(c, weekday_style),
    }


def calendar_dim(df: DataFrame, ts: str, weekday_style: str = "name") -> DataFrame:
    """One row per distinct time. Distinct first: only `ts` is shuffled."""
    times = df.select(F.col(ts).alias("start_time")).filter(F.col("start_time").isNotNull()).distinct()
    return times.withColumns(calendar_columns("start_time", weekday_style))


def from_epoch_millis(ms: ColumnOrName) -> Column:
    """Timestamp with the millis kept."""
    return F.timestamp_add("MILLISECOND", _col(ms).cast("bigint"), F.expr(_EPOCH))


def from_epoch_seconds(ms: ColumnOrName) -> Column:
    """Timestamp of the whole second; the millis are dropped, not rounded."""
    return F.timestamp_add("SECOND", F.floor(_col(ms) / 1000).cast("bigint"), F.expr(_EPOCH))


def to_epoch_millis(ts: ColumnOrName) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), _col(ts).cast("timestamp_ntz"))


def from_sas_days(days: ColumnOrName) -> Column:
    """Date from a count of days since 1960-01-01; NULL stays NULL."""
    return F.date_add(F.to_date(F.lit("1960-01-01")), _col(days).try_cast("int"))


def text_to_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Date from text, NULL where the text is no date."""
    return F.try_to_date(_col(c), fmt)
