"""Text cleaning, splitting and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import ColumnOrName, _col

# Stands for NULL inside a key, so that NULL and '' give different keys.
NULL_MARK = "\\N"


def split_part(c: ColumnOrName, sep: str, index: int) -> Column:
    """Part `index` (from 0) of a text; NULL where there is no such part.

    `sep` is plain text, not a pattern.
    """
    return F.get(F.split(_col(c), _literal(sep)), F.lit(index))


def _literal(sep: str) -> str:
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def lon_lat(c: ColumnOrName, sep: str = ", ") -> tuple[Column, Column]:
    """Longitude and latitude from one `lon, lat` text."""
    return split_part(c, sep, 0).try_cast("float"), split_part(c, sep, 1).try_cast("float")


def region_part(c: ColumnOrName) -> Column:
    """Region without its country prefix: `US-GA` gives `GA`."""
    return split_part(c, "-", 1)


def clean_label(c: ColumnOrName) -> Column:
    """Strip blanks, tabs, quotes and statement ends around a label."""
    return F.regexp_replace(_col(c), r"^[\s';]+|[\s';]+$", "")


def concat_key(parts: Sequence[ColumnOrName], sep: str = "") -> Column:
    """Plain concatenation: one NULL part makes the result NULL."""
    texts = [_col(p).cast("string") for p in parts]
    if sep:
        texts = [x for t in texts for x in (F.lit(sep), t)][1:]
    return F.concat(*texts)


def md5_key(parts: Sequence[ColumnOrName], sep: str = "|", null_safe: bool = True) -> Column:
    """md5 surrogate key over `parts`.

    `null_safe` puts a mark for NULL, so no key is lost to one missing part;
    without it a NULL part gives a NULL key, as plain concatenation does.
    """
    if null_safe:
        parts = [F.coalesce(_col(p).cast("string"), F.lit(NULL_MARK)) for p in parts]
    return F.md5(concat_key(parts, sep))


def row_key(columns: Sequence[str]) -> Column:
    """md5 over a whole row; unambiguous, as each value goes with its name."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])))
