"""Settings with the checks that keep them consistent.  Dimensions are small and stay on the driver until broadcast."""

from __future__ import annotations

from collections.abc import Iterable


class SettingsError(ValueError):
    pass


def _unique(values: Iterable[str], what: str) -> set[str]:
    seen: set[str] = set()
    for v in values:
        if v in seen:
            raise SettingsError(f"{what} {v} occurs twice")
        seen.add(v)
    return seen


def check_taxonomy(taxonomy: dict) -> dict:
    """Unique groups and topics; each topic's group exists."""
    groups = _unique((g["id"] for g in taxonomy["groups"]), "group")
    _unique((t["id"] for t in taxonomy["topics"]), "topic")
    for t in taxonomy["topics"]:
        if t["group"] not in groups:
            raise SettingsError(f"topic {t['id']} names the unknown group {t['group']}")
    return taxonomy


def check_queries(queries: list[dict], taxonomy: dict) -> list[dict]:
    """Unique queries whose topics exist, and a query for each topic."""
    _unique((q["id"] for q in queries), "query")
    topics = {t["id"] for t in taxonomy["topics"]}
    named = {t for q in queries for t in q.get("topics", [])}
    if named - topics:
        raise SettingsError(f"queries name unknown topics: {sorted(named - topics)}")
    if topics - named:
        raise SettingsError(f"topics without a query: {sorted(topics - named)}")
    return queries


def check_profiles(settings: dict, taxonomy: dict) -> dict:
    """One profile a topic, ordered thresholds, sensible n-grams."""
    topics = {t["id"] for t in taxonomy["topics"]}
    if _unique((p["topic"] for p in settings["profiles"]), "profile") != topics:
        raise SettingsError("profiles and topics differ")
    m, c = settings["model"], settings["classification"]
    if not (0 < m["word_ngram_min"] <= m["word_ngram_max"] and 0 < m["char_ngram_min"] <= m["char_ngram_max"]):
        raise SettingsError("n-gram bounds are out of order")
    if not c["minimum_topic_similarity"] <= c["acceptance_similarity"] <= c["full_scale_similarity"]:
        raise SettingsError("similarity thresholds are out of order")
    return settings


def check_analytics(settings: dict) -> dict:
    """The history covers two of the longest windows and the lookback."""
    longest = max(settings["trend_windows_days"])
    if settings["history_days"] < max(2 * longest, settings["recurring_entities"]["lookback_days"]):
        raise SettingsError("the history is shorter than two windows or the lookback")
    return settings


def check_source(settings: dict, venues: Iterable[str] = ()) -> dict:
    if settings["lookback_hours"] > settings["most_catch_up_hours"]:
        raise SettingsError("the first lookback exceeds the longest catch-up")
    _unique((f["url"] for f in settings.get("feeds", [])), "feed")
    known = set(venues)
    for f in settings.get("feeds", []):
        if f.get("venue") and f["venue"] not in known:
            raise SettingsError(f"feed {f['url']} names the unknown venue {f['venue']}")
    return settings
