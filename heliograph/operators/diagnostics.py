"""Counters beside a result, and failures as a table of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and counters that are known once an action has run over them: ``rows``, and a sum or count for each metric.

    Counters are gathered by the pass that makes the result, not by another one.  Each
    metric is an aggregate, as ``F.count_if(...)``.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()]), seen


def split_failures(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows without an error, and the others: a reader that turns failures into rows feeds both from one written table."""
    return rows.filter(F.col(error).isNull()).drop(error), rows.filter(F.col(error).isNotNull())


def run_report(rows: DataFrame, target: str = "target", error: str = "error", warning: str | None = None) -> DataFrame:
    """target, rows, errors, warnings, status, messages: one row for each target of a run.  A target with an error has failed; up to five of its messages are kept, in order."""
    warn = F.count_if(F.col(warning).isNotNull()) if warning else F.lit(0).cast("long")
    worst = F.slice(F.array_sort(F.collect_set(error)), 1, 5)
    out = rows.groupBy(target).agg(F.count_if(F.col(error).isNull()).alias("rows"), F.count_if(F.col(error).isNotNull()).alias("errors"), warn.alias("warnings"), worst.alias("messages"))
    status = F.when(F.col("errors") > 0, "failed").when(F.col("warnings") > 0, "warned").otherwise("done")
    return out.select(target, "rows", "errors", "warnings", status.alias("status"), "messages")


def may_advance(report: DataFrame, explicit_window: bool = False) -> bool:
    """A checkpoint moves only after a run in which no target failed and that wasn't told its window."""
    return not explicit_window and report.filter("status = 'failed'").isEmpty()
