"""Loads that keep what they reject beside what they store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.counting import ROWS, Counted
from ..operators.quality import QualityError
from ..schemas import TableSpec
from ..scratch import materialise
from ..sources.rejects import REASON, REJECTS, accepted, read_json_checked, rejected
from .versions import Change


def load_json_checked(
    spark: SparkSession, paths: str | Sequence[str], spec: TableSpec, root: str, most_rejects: int | None = None,
    recursive: bool = False, glob: str | None = None,
) -> dict[str, int]:
    """Append JSON lines to a table and what can't be read to the table of rejects, in one version.

    Returns lines, loaded and rejected, counted by the one pass that parses. With
    more than `most_rejects` rejects nothing is loaded and QualityError is raised,
    but the rejects are stored, to be looked at.
    """
    counted = Counted(
        read_json_checked(spark, paths, spec.schema, recursive, glob), rejected=F.count_if(F.col(REASON).isNotNull()))
    checked = materialise(counted.df, "checked")
    found = counted.get()
    lines, rejects = found[ROWS], found["rejected"] or 0
    too_many = most_rejects is not None and rejects > most_rejects
    with Change(spark, root) as change:
        if not too_many:
            change.append(accepted(checked), spec)
            change.audit(spec, may_be_empty=True)
        if rejects:
            change.append(rejected(checked, spec.name), REJECTS)
    if too_many:
        raise QualityError(f"{spec.name}: {rejects} of {lines} lines rejected, at most {most_rejects} allowed")
    return {"lines": lines, "loaded": lines - rejects, "rejected": rejects}
