"""What a query read, to see whether its filters reached the files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def scanned(df: DataFrame) -> dict[str, int]:
    """Runs the query; files and rows that its scans gave, after row groups and pages were skipped."""
    df._jdf.collectToPython()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.finalPhysicalPlan()
    leaves, found = plan.collectLeaves(), {"files": 0, "rows": 0}
    for k in range(leaves.size()):
        metrics = leaves.apply(k).metrics()
        for name, metric in (("files", "numFiles"), ("rows", "numOutputRows")):
            if metrics.contains(metric):
                found[name] += metrics.apply(metric).value()
    return found
