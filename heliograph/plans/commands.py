"""Commands over a work folder: the digest of a day, the archive's search, the trends; and where they read and write."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import UTC, date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.times import half_open, report_window
from heliograph.operators import archive, ranking
from heliograph.plans.reports import digest_report, trends_markdown
from heliograph.schema import event_time, with_metadata
from heliograph.sources.items import read_items
from heliograph.storage import write_text


@dataclass(frozen=True)
class Layout:
    """Folders below a root, which can be on any file system Spark reads."""

    root: str

    def __getattr__(self, name: str) -> str:
        below = {"items": "data/items", "state": "data/state", "entities": "data/entities", "ranking": "data/ranking", "analytics": "data/analytics", "archive": "data/archive", "daily": "reports/daily", "trends": "reports/trends", "data": "data", "reports": "reports"}
        if name not in below:
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{below[name]}"


def report_date(text: str | None, zone: str = "Asia/Tokyo", now: datetime | None = None) -> date:
    """A date as YYYY-MM-DD, or today where the reports are made."""
    if text:
        return date.fromisoformat(text)
    return (now or datetime.now(UTC)).astimezone(ZoneInfo(zone)).date()


def since(text: str | None) -> Column | None:
    """From a day on, or from an instant on; times without a zone are UTC."""
    if text is None:
        return None
    at = datetime.fromisoformat(text)
    return F.lit((at if at.tzinfo else at.replace(tzinfo=UTC)).astimezone(UTC).isoformat()).cast("timestamp")


def link_time(items: DataFrame) -> Column:
    """The latest discovery, the epoch without any; an aggregate."""
    return F.coalesce(F.max("discovered_at"), F.lit("1970-01-01T00:00:00Z"))


def ranked_items(items: DataFrame, start: Column, end: Column, how: ranking.Ranking = ranking.Ranking()) -> DataFrame:
    """Items of a window with signals, total, label and section, but for those the digest leaves out."""
    out = event_time(with_metadata(items)).filter(half_open(F.col("ts"), start, end))
    found = (F.col("kind") == "repository") & F.col("m.discovery_modes").isNotNull()
    watched = F.col("priority")["source"] >= 1.0
    out = out.select(
        "*", ranking.priority(F.col("priority")["source"], F.col("source"), F.col("venue"), how).alias("s_priority"), ranking.relevance(F.col("scores")["relevance"], F.col("topics"), how).alias("s_relevance"),
        ranking.research(F.col("scores")["research_relevance"], found).alias("s_research"), ranking.freshness(F.col("ts"), end, how.half_life_hours).alias("freshness"), ranking.novelty(F.col("kind"), F.col("m.action"), how).alias("s_novelty"),
        ranking.popularity(F.col("m.stars_delta"), how.reference_delta).alias("s_popularity"), F.coalesce(watched, F.lit(False)).alias("watched"), found.alias("found"),
    )
    signals = {"priority": "s_priority", "relevance": "s_relevance", "freshness": "freshness", "novelty": "s_novelty", "popularity": "s_popularity"}
    out = out.withColumn("total", ranking.total({k: F.col(c) for k, c in signals.items()}, how))
    out = out.filter(ranking.included(F.col("m.reportable"), F.col("watched"), F.col("found"), F.col("s_research"), F.col("total"), how))
    out = out.withColumn("label", ranking.change_label(F.col("kind"), F.col("m.action"), F.col("m.status"), F.col("found")))
    return out.withColumn("section", ranking.section_of(F.col("watched"), F.col("label"), F.col("kind")))


#: How many items a section shows; a watched one is always shown.
SECTION_LIMITS = {"priority_watch": 0, "accepted_papers": 30, "new_papers": 40, "new_repositories": 30, "models_and_demos": 20, "research_announcements": 20, "project_updates": 25, "other": 20}


def build_digest(spark: SparkSession, work: str, day: str | None = None, entities: DataFrame | None = None, zone: str = "Asia/Tokyo") -> str:
    """Renders the digest of a day and replaces its file; returns the text.  ``entities``: item, entity_id."""
    where, on = Layout(work), report_date(day, zone)
    start, end = report_window(F.lit(on.isoformat()).cast("date"), zone)
    ranked = ranked_items(read_items(spark, where.items), start, end)
    if entities is not None:
        ranked = ranked.join(entities.select(F.col("item").alias("id"), "entity_id"), "id", "left")
        ranked = ranking.best_per_entity(ranked, "entity_id", F.col("kind") == "paper", ranking.digest_order())
    shown = ranking.sections(ranked, "section", SECTION_LIMITS, ranking.digest_order(), 20)
    bounds = spark.range(1).select(*[F.date_format(F.from_utc_timestamp(x, zone), "yyyy-MM-dd HH:mm") for x in (start, end)]).first()
    text = digest_report("Research digest", on.isoformat(), (bounds[0], bounds[1], zone), shown)
    write_text(spark, f"{where.daily}/{on.isoformat()}.md", text)
    return text


def build_trends(spark: SparkSession, work: str, day: str, tables: dict[str, DataFrame]) -> str:
    text = trends_markdown(day, tables)
    write_text(spark, f"{Layout(work).trends}/{day}.md", text)
    return text


def search_archive(spark: SparkSession, work: str, query: str = "", topics: list[str] | None = None, sources: list[str] | None = None, kinds: list[str] | None = None, start: str | None = None, include_hidden: bool = False, limit: int = 20) -> str:
    """The best records as a JSON text with their number."""
    rows = event_time(with_metadata(read_items(spark, Layout(work).items))).withColumn("reportable", F.col("m.reportable"))
    kept = rows.filter(archive.filters(topics, sources, kinds, since(start), include_hidden))
    found = archive.search(kept, query, limit, F.col("title"), F.concat_ws(" ", "source", "kind", F.array_join("topics", " ")), F.coalesce("summary", F.lit("")), "ts", "id")
    records = [{"id": r.id, "title": r.title, "url": r.url, "source": r.source, "kind": r.kind, "discovered_at": r.discovered_at} for r in found.select("id", "title", "url", "source", "kind", "discovered_at").collect()]  # at most ``limit`` rows
    return json.dumps({"count": len(records), "records": records}, indent=2, ensure_ascii=False)
