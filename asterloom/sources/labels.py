"""Code lists out of format scripts.

A script holds blocks such as

    value $ports
       'ALC' = 'ALCAN, AK   '
    ;

and lists that stand only in a comment, `/* VISA ... 1 = Business ... */`.
Blocks are found by their names, never by line number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_by_key

_COMMENT = r"(?s)/\*.*?\*/"
_BLOCK_START = r"(?i)(?<![\w$'])value\s+(?=\$?[a-z]\w*)"
_BLOCK_NAME = r"(?i)^\$?([a-z]\w*)"
# code = 'label'; the code may be quoted, and '' stands for a quote.
_QUOTED = r"'([^']*+(?:''[^']*+)*+)'"
_ENTRY = r"(?m)(?:" + _QUOTED + r"|(?<![\w'])(-?\w++))\s*=\s*" + _QUOTED
# code = label up to the end of the line
_BARE_ENTRY = r"(?m)^[ \t]*(\w+)[ \t]*=[ \t]*([^\r\n]*?)[ \t]*\r?$"


def read_scripts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per script: a script is one short list of statements."""
    return spark.read.text(paths, wholetext=True)


def parse_value_blocks(scripts: DataFrame, column: str = "value") -> DataFrame:
    """(block, pos, code, label) for every entry of every `value` block."""
    plain = F.regexp_replace(F.col(column), _COMMENT, " ")
    blocks = scripts.select(F.posexplode(F.split(plain, _BLOCK_START)).alias("nth", "body")).filter("nth > 0")
    entries = blocks.select(
        F.lower(F.regexp_extract("body", _BLOCK_NAME, 1)).alias("block"),
        F.posexplode(F.regexp_extract_all("body", F.lit(_ENTRY), F.lit(0))).alias("pos", "entry"),
    )
    return entries.select(
        "block",
        "pos",
        _unquote(F.concat(F.regexp_extract("entry", _ENTRY, 1), F.regexp_extract("entry", _ENTRY, 2))).alias("code"),
        _unquote(F.regexp_extract("entry", _ENTRY, 3)).alias("label"),
    )


def parse_comment_list(scripts: DataFrame, name: str, column: str = "value") -> DataFrame:
    """(block, pos, code, label) for a list inside the comment named `name`."""
    comment = F.regexp_extract(F.col(column), rf"(?is)/\*\s*{name}\b(.*?)\*/", 1)
    entries = scripts.select(
        F.posexplode(F.regexp_extract_all(comment, F.lit(_BARE_ENTRY), F.lit(0))).alias("pos", "entry")
    )
    return entries.select(
        F.lit(name.lower()).alias("block"),
        "pos",
        F.trim(F.regexp_extract("entry", _BARE_ENTRY, 1)).alias("code"),
        F.trim(F.regexp_extract("entry", _BARE_ENTRY, 2)).alias("label"),
    )


def _unquote(c):
    return F.trim(F.replace(c, F.lit("''"), F.lit("'")))


def pick_list(parsed: DataFrame, block: str, label: str, code_type: str = "string") -> DataFrame:
    """(code, `label`) of one block; a code listed twice keeps its last label."""
    rows = parsed.filter(F.col("block") == block.lower())
    last = latest_by_key(rows, ["code"], ["pos"], columns=["label"])
    return last.select(F.col("code").try_cast(code_type).alias("code"), F.col("label").alias(label))


def reverse_list(codes: DataFrame, label: str, order_by: str, sep: str = ",") -> DataFrame:
    """(name, code): the label before `sep` back to its code, later ones win."""
    named = codes.withColumn("name", F.trim(F.get(F.split(label, sep), F.lit(0))))
    return latest_by_key(named, ["name"], [order_by], columns=["code"])
