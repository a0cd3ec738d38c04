"""Rendered reports: ordered rows within section limits are collected, then written as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.functions.text import compact, escape_markdown

#: The order of sections and their headings.
HEADINGS = {
    "priority_watch": "Priority Watch", "accepted_papers": "Accepted Papers", "new_papers": "New Papers", "new_repositories": "Repositories", "models_and_demos": "Models & Demos",
    "research_announcements": "Research Announcements", "project_updates": "Project Updates", "other": "Other",
}


def item_block(r, labels: dict[str, str] | None = None) -> list[str]:
    """An item's lines: label and title, where it is from and what it is about, summary, resources, related records."""
    about = [r.source]
    if r.venue:
        name = r.venue.upper() if len(r.venue) <= 6 else r.venue
        about.append(f"{name} {r.venue_year}" if r.venue_year else name)
    if r.topics:
        about.append(", ".join((labels or {}).get(t, t) for t in r.topics[:5]))
    about.append(f"score {r.total:.2f}")
    out = [f"- **[{r.label}] [{r.title}]({r.url})**", f"  - {' · '.join(about)}"]
    if r.summary:
        out.append(f"  - {r.summary}")
    links = [f"[{name}]({many[0]})" for name, many in (("Project", r.project_urls), ("Code", r.code_urls)) if many]
    if links:
        out.append(f"  - {' · '.join(links)}")
    if r.related_items:
        out.append("  - Related records: " + ", ".join(f"`{x}`" for x in r.related_items[:6]))
    return [*out, ""]


def digest_report(title: str, day: str, window: tuple[str, str, str], shown: DataFrame, labels: dict[str, str] | None = None, summary_characters: int = 280) -> str:
    """``shown``: ranked items with section, rank, hidden and label, within their limits, so rows are few."""
    lines = [f"# {title} — {day}", "", f"Window: {window[0]} - {window[1]} {window[2]}", ""]
    text = shown.select(
        "section", "rank", "hidden", "label", escape_markdown(F.col("title")).alias("title"), "url", "source", "venue", F.col("m.venue_year").alias("venue_year"), "topics", "total",
        compact(F.col("summary"), summary_characters, True).alias("summary"), F.col("m.project_urls").alias("project_urls"), F.col("m.code_urls").alias("code_urls"), "related_items",
    )
    by: dict[str, list] = {}
    for r in text.orderBy("section", "rank").collect():
        by.setdefault(r.section, []).append(r)
    if not by:
        return "\n".join([*lines, "No items met the reporting threshold for this window.", ""])
    for key, heading in HEADINGS.items():
        rows = by.get(key, [])
        if rows:
            lines += [f"## {heading}", "", *(line for r in rows for line in item_block(r, labels))]
            if rows[0].hidden:
                lines += [f"_+{rows[0].hidden} more items omitted by section limit._", ""]
    return "\n".join(lines).rstrip() + "\n"


def trends_markdown(day: str, tables: dict[str, DataFrame]) -> str:
    """Each bounded table under its name."""
    lines = [f"# Trends — {day}", ""]
    for name, df in tables.items():
        lines += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in df.collect()] + [""]
    return "\n".join(lines)
