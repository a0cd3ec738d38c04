"""Scores, gates, labels and sections of the daily digest."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.numbers import clamp, compensated_sum, round_even


@dataclass(frozen=True)
class Ranking:
    """Weights, defaults and thresholds."""

    minimum_total: float = 0.35
    minimum_research: float = 0.40
    weights: dict[str, float] = field(default_factory=lambda: {"priority": 0.30, "relevance": 0.30, "freshness": 0.15, "novelty": 0.20, "popularity": 0.05})
    source_priority: dict[str, float] = field(default_factory=lambda: {"github": 0.10, "arxiv": 0.20, "openreview": 0.25, "cvf": 0.30, "huggingface": 0.15, "research_blog": 0.20})
    venue_priority: dict[str, float] = field(default_factory=lambda: {"core": 0.70, "secondary": 0.40})
    fallback_relevance: float = 0.55
    half_life_hours: float = 72.0
    reference_delta: float = 100.0
    novelty: dict[str, float] = field(default_factory=lambda: {"repository": 1.0, "paper": 0.9, "release": 1.0, "tag": 0.65, "commit": 0.45, "event": 0.55, "model": 0.85, "project": 0.5, "article": 0.7})
    action_novelty: dict[str, float] = field(default_factory=lambda: {"created": 1.0, "discovered": 1.0, "released": 1.0, "status_changed": 0.95, "metadata_updated": 0.55, "default_branch_advanced": 0.45, "tagged": 0.65, "published": 0.75, "updated": 0.55, "missing_from_account": 0.35})


def case_of(column: Column, values: dict[str, float], otherwise: Column | float | None = None) -> Column:
    """A small fixed map as CASE: constant folding reaches it, a join or map lookup would not be."""
    out = F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    for k, v in values.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def priority(explicit: Column, source: Column, venue: Column, how: Ranking = Ranking()) -> Column:
    zero = F.lit(0.0)
    return clamp(F.greatest(F.coalesce(explicit, zero), case_of(source, how.source_priority, 0.0), case_of(venue, how.venue_priority, 0.0)))


def relevance(value: Column, topics: Column, how: Ranking = Ranking()) -> Column:
    return clamp(F.coalesce(value, F.when(F.size(topics) > 0, how.fallback_relevance).otherwise(0.0)))


def research(value: Column, discovered_repository: Column) -> Column:
    return F.when(discovered_repository, clamp(F.coalesce(value, F.lit(0.0)))).otherwise(F.lit(1.0))


def freshness(ts: Column, end: Column, half_life_hours: float = 72.0, round_to=round_even) -> Column:
    age = F.greatest((F.unix_micros(end) - F.unix_micros(ts)) / 3.6e9, F.lit(0.0))
    return round_to(F.pow(F.lit(0.5), age / half_life_hours), 4)


def novelty(kind: Column, action: Column, how: Ranking = Ranking()) -> Column:
    return clamp(case_of(action, how.action_novelty, case_of(kind, how.novelty, 0.0)))


def popularity(delta: Column, reference: float = 100.0) -> Column:
    return F.when(delta > 0, F.least(F.log1p(delta) / F.log1p(F.lit(reference)), F.lit(1.0))).otherwise(0.0)


def total(signals: dict[str, Column], how: Ranking = Ranking(), round_to=round_even) -> Column:
    """The weighted mean of the configured signals."""
    return round_to(compensated_sum([signals[k] * F.lit(w) for k, w in how.weights.items()]) / sum(how.weights.values()), 4)


def change_label(kind: Column, action: Column, status: Column, discovered: Column) -> Column:
    return (
        F.when((action == "status_changed") & (status == "accepted"), "ACCEPTED")
        .when((kind == "release") | (action == "released"), "RELEASED")
        .when((kind == "repository") & discovered, "DISCOVERED")
        .when((action == "created") | (kind.isin("paper", "article", "project") & action.isNull()), "NEW")
        .otherwise("UPDATED")
    )


def included(reportable: Column, watched: Column, discovered_repository: Column, research_score: Column, total_score: Column, how: Ranking = Ranking()) -> Column:
    """Hidden first, then watched, then the research gate, then the total; in that order."""
    return (
        F.when(reportable.eqNullSafe(F.lit(False)), False)
        .when(F.coalesce(watched, F.lit(False)), True)
        .when(discovered_repository & (research_score < how.minimum_research), False)
        .otherwise(total_score >= how.minimum_total)
    )


def digest_order(total_score: str = "total", fresh: str = "freshness", item: str = "id") -> list[Column]:
    return [F.desc(total_score), F.desc(fresh), F.asc(item)]


def best_per_entity(ranked: DataFrame, entity: str, applies: Column, order: list[Column]) -> DataFrame:
    """Of rows to which ``applies`` and that have an entity, the best of each; all others pass."""
    through = ranked.filter(~F.coalesce(applies, F.lit(False)) | F.col(entity).isNull())
    best = ranked.filter(F.coalesce(applies, F.lit(False)) & F.col(entity).isNotNull())
    best = best.withColumn("__r", F.row_number().over(Window.partitionBy(entity).orderBy(*order))).filter("__r = 1").drop("__r")
    return through.unionByName(best)


def section_of(watched: Column, label: Column, kind: Column) -> Column:
    """The digest's section: watched first, then accepted papers, then by kind."""
    return (
        F.when(F.coalesce(watched, F.lit(False)), "priority_watch")
        .when(label == "ACCEPTED", "accepted_papers")
        .when(kind == "paper", "new_papers")
        .when(kind == "repository", "new_repositories")
        .when(kind.isin("model", "project"), "models_and_demos")
        .when(kind == "article", "research_announcements")
        .when(kind.isin("release", "tag", "commit", "event"), "project_updates")
        .otherwise("other")
    )


def sections(ranked: DataFrame, section: str, limits: dict[str, int], order: list[Column], default: int | None = None) -> DataFrame:
    """The first rows of each section with their rank, and how many of it are hidden; no limit, or none above 0, shows all.

    Sections are counted by an aggregate and, as they are few, joined by a broadcast.
    The rank is filtered by the largest limit first, so each task keeps that many rows
    of a section before the shuffle; a section that shows all is never ranked in part.
    """
    limit = case_of(F.col(section), limits, F.lit(default).cast("int"))
    limit = F.when(limit > 0, limit)
    counted = ranked.groupBy(section).agg(F.count("*").alias("__n")).withColumn("__limit", limit)
    shown = ranked.withColumn("__open", limit.isNull())
    w = Window.partitionBy(section).orderBy(*order)
    most = max([x for x in [*limits.values(), default or 0] if x and x > 0], default=1)
    short = shown.filter(~F.col("__open")).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)
    whole = shown.filter("__open").withColumn("rank", F.row_number().over(w))
    out = short.unionByName(whole).drop("__open").join(F.broadcast(counted), section)  # a row for each section
    out = out.filter(F.col("__limit").isNull() | (F.col("rank") <= F.col("__limit")))
    return out.withColumn("hidden", F.greatest(F.col("__n") - F.coalesce("__limit", "__n"), F.lit(0))).drop("__n", "__limit")
