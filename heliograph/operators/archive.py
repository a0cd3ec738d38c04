"""The searchable archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions.text import compact, search_score


def archive(items: DataFrame, summary_characters: int = 320) -> DataFrame:
    """The archive's columns, newest first by (discovered_at, id) as text."""
    out = items.withColumn("summary", compact(F.col("summary"), summary_characters))
    if "reportable" in out.columns:
        out = out.withColumn("reportable", ~F.col("reportable").eqNullSafe(F.lit(False)))
    return out.orderBy(F.desc("discovered_at"), F.desc("id"))


def filters(topics: list[str] | None = None, sources: list[str] | None = None, kinds: list[str] | None = None, since: Column | None = None, include_hidden: bool = False, columns: dict[str, str] | None = None) -> Column:
    """A condition with each filter that is given; topics must all be there."""
    c = {"topics": "topics", "source": "source", "kind": "kind", "ts": "ts", "reportable": "reportable"} | (columns or {})
    out = F.lit(True)
    if topics:
        out = out & (F.size(F.array_except(F.array(*map(F.lit, topics)), F.col(c["topics"]))) == 0)
    if sources:
        out = out & F.col(c["source"]).isin(*sources)
    if kinds:
        out = out & F.col(c["kind"]).isin(*kinds)
    if since is not None:
        out = out & (F.col(c["ts"]) >= since)
    if not include_hidden:
        out = out & ~F.col(c["reportable"]).eqNullSafe(F.lit(False))
    return out


def search(records: DataFrame, query: str, limit: int, title: Column, extra: Column, summary: Column, ts: str, key: str, most: int = 200) -> DataFrame:
    """Records by score, newest first, then key; without a query by time.  Fields are compared in lower case."""
    if not 1 <= limit <= most:
        raise ValueError(f"the limit must be from 1 to {most}")
    words = query.lower().split()
    if not words:
        return records.withColumn("score", F.lit(0)).orderBy(F.desc(ts), key).limit(limit)
    scored = records.withColumn("score", search_score(words, " ".join(words), F.lower(title), F.lower(extra), F.lower(summary)))
    return scored.filter("score > 0").orderBy(F.desc("score"), F.desc(ts), key).limit(limit)
