"""Feeds, indexes and API pages as rows.

Each reader takes a DataFrame with a column of raw text (one document a row) and returns
one row an entry, by an Arrow-batched Python function: documents are parsed where they lie.
"""

from __future__ import annotations

import html
import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.shipping import ship


def _rows(df: DataFrame, column: str, parse: Callable[[str], list[dict]], schema: str) -> DataFrame:
    ship(df.sparkSession, "heliograph")
    names = [x.strip().split()[0] for x in re.sub(r"<[^>]*>", "", schema).split(",")]

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [row for text in batch[column] if text for row in parse(text)]
            yield pd.DataFrame(found, columns=names)

    return df.select(column).mapInPandas(each, schema)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _kids(node: ET.Element, name: str) -> list[ET.Element]:
    return [k for k in node if _local(k.tag) == name]


def _text(node: ET.Element, *names: str) -> str | None:
    for name in names:
        for k in _kids(node, name):
            value = " ".join("".join(k.itertext()).split())
            if value:
                return value
    return None


# --- Atom of a preprint archive --------------------------------------------------------

PREPRINTS = "paper_id string, version int, title string, summary string, published string, updated string, authors array<string>, categories array<string>, primary_category string, comment string, journal_ref string, doi string, url string, pdf_url string, total int"


def parse_preprints(text: str) -> list[dict]:
    root = ET.fromstring(text)
    total = int(_text(root, "totalResults") or 0)
    out = []
    for e in _kids(root, "entry"):
        raw = (_text(e, "id") or "").rpartition("/abs/")[2]
        m = re.fullmatch(r"(.+?)(?:v(\d+))?", raw)
        links = _kids(e, "link")
        url = next((x.get("href") for x in links if x.get("rel") == "alternate"), None)
        pdf = next((x.get("href") for x in links if x.get("title") == "pdf" or x.get("type") == "application/pdf"), None)
        cats = [c.get("term") for c in _kids(e, "category") if c.get("term")]
        first = next((c.get("term") for c in _kids(e, "primary_category")), cats[0] if cats else None)
        out.append({
            "paper_id": m[1] if m else None, "version": int(m[2] or 1) if m else None, "title": _text(e, "title"), "summary": _text(e, "summary"), "published": _text(e, "published"),
            "updated": _text(e, "updated"), "authors": [n for a in _kids(e, "author") if (n := _text(a, "name"))], "categories": cats, "primary_category": first,
            "comment": _text(e, "comment"), "journal_ref": _text(e, "journal_ref"), "doi": _text(e, "doi"), "url": url, "pdf_url": pdf, "total": total,
        })
    return out


def read_preprints(df: DataFrame, column: str = "xml") -> DataFrame:
    return _rows(df, column, parse_preprints, PREPRINTS)


def merge_categories(papers: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row a paper found in several categories: all categories, distinct, and the fields of the newest version.

    Categories come in the order of ``arrival`` (a column that says when a row was
    read) and then of each row; without one, in order of the alphabet.
    """
    rest = [c for c in papers.columns if c not in ("paper_id", "categories", arrival)]
    newest = F.max_by(F.struct(*rest), F.struct("updated", "version")).alias("x")
    if arrival is None:
        several = F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories"))))  # a paper is in a few categories
    else:
        several = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(arrival).alias("a"), F.col("categories").alias("c")))), lambda x: x["c"])))
    return papers.groupBy("paper_id").agg(several.alias("categories"), newest).select("paper_id", "categories", "x.*")


# --- RSS and Atom feeds -----------------------------------------------------------------

FEED = "entry_id string, title string, url string, published string, summary string, authors array<string>, categories array<string>"


def parse_feed(text: str) -> list[dict]:
    """Entries with a title, a link and an identifier; others are dropped."""
    root = ET.fromstring(text)
    kind = _local(root.tag)
    if kind not in ("rss", "RDF", "feed"):
        raise ValueError(f"neither RSS nor Atom: {kind}")
    out = []
    entries = [n for n in root.iter() if _local(n.tag) == ("entry" if kind == "feed" else "item")]
    for e in entries:
        if kind == "feed":
            links = _kids(e, "link")
            url = next((x.get("href") for x in links if x.get("rel", "alternate") == "alternate"), None)
            authors = [n for a in _kids(e, "author") if (n := _text(a, "name"))]
            cats = [c.get("term") for c in _kids(e, "category") if c.get("term")]
            key, when, body = _text(e, "id") or url, _text(e, "published", "updated"), _text(e, "summary", "content")
        else:
            url = _text(e, "link")
            authors = [n for name in ("creator", "author") for a in _kids(e, name) if (n := " ".join("".join(a.itertext()).split()))]
            cats = [" ".join("".join(c.itertext()).split()) for c in _kids(e, "category")]
            key, when, body = _text(e, "guid") or url, _text(e, "pubDate", "date"), _text(e, "description", "encoded")
        title = _text(e, "title")
        if title and url and key:
            out.append({"entry_id": key, "title": html.unescape(title), "url": url, "published": when, "summary": body, "authors": authors, "categories": cats})
    return out


def read_feed(df: DataFrame, column: str = "xml") -> DataFrame:
    return _rows(df, column, parse_feed, FEED)


# --- proceedings in HTML ------------------------------------------------------------------

INDEX = "title string, path string, authors array<string>"
DETAIL = "title string, authors array<string>, abstract string, pdf string, supplement string, bibtex string"
#: Elements without an end tag.
VOID = frozenset(("br", "hr", "img", "input", "link", "meta"))


class _Tree(HTMLParser):
    """A flat list of (event, tag, attributes or text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, dict]] = []

    def handle_starttag(self, tag, attrs):
        self.events.append(("start", tag, dict(attrs)))

    def handle_endtag(self, tag):
        self.events.append(("end", tag, {}))

    def handle_data(self, data):
        self.events.append(("text", data, {}))


def _events(text: str) -> list[tuple[str, str, dict]]:
    p = _Tree()
    p.feed(text)
    p.close()
    return p.events


def split_names(text: str) -> list[str]:
    return [n for x in text.split(",") if (n := " ".join(x.split()))]


def parse_index(text: str) -> list[dict]:
    """Titles with links, each with the names that follow it."""
    out, title, names, inside = [], None, [], ""
    for event, what, attrs in _events(text):
        if event == "start" and what == "dt" and "ptitle" in (attrs.get("class") or ""):
            if title:
                out.append(title | {"authors": split_names(" ".join(names))})
            title, names, inside = {"title": "", "path": None}, [], "title"
        elif event == "start" and what == "dd":
            inside = "names" if title and inside in ("title", "names") and not names else "other"
        elif event == "start" and what == "a" and inside == "title" and title is not None and not title["path"]:
            title["path"] = attrs.get("href")
        elif event == "end" and what == "dd" and "".join(names).strip():
            inside = "other"
        elif event == "text" and inside == "title" and title is not None:
            title["title"] = " ".join(f"{title['title']} {what}".split())
        elif event == "text" and inside == "names":
            names.append(what)
    if title:
        out.append(title | {"authors": split_names(" ".join(names))})
    return [r for r in out if r["title"] and r["path"]]


def parse_detail(text: str) -> list[dict]:
    """Title, names, abstract and the first link of each kind."""
    parts: dict[str, list[str]] = {"papertitle": [], "authors": [], "abstract": []}
    links: dict[str, str] = {}
    where, depth = "", 0
    for event, what, attrs in _events(text):
        if event == "start" and what not in VOID:
            if attrs.get("id") in parts:
                where, depth = attrs["id"], 0
            depth += 1
            href = attrs.get("href") or ""
            kind = "supplement" if "supp" in href.lower() else "pdf" if href.lower().endswith(".pdf") else "bibtex" if "bib" in href.lower() else None
            if what == "a" and kind:
                links.setdefault(kind, href)
        elif event == "end":
            depth -= 1
            if depth <= 0:
                where = ""
        elif event == "text" and where:
            parts[where].append(what)
    flat = {k: " ".join(" ".join(v).split()) for k, v in parts.items()}
    names = split_names(flat["authors"].partition(";")[0])
    return [{"title": flat["papertitle"] or None, "authors": names, "abstract": flat["abstract"] or None, **{k: links.get(k) for k in ("pdf", "supplement", "bibtex")}}]


def read_index(df: DataFrame, column: str = "html") -> DataFrame:
    return _rows(df, column, parse_index, INDEX)


def read_detail(df: DataFrame, column: str = "html") -> DataFrame:
    return _rows(df, column, parse_detail, DETAIL)


# --- review notes and models in JSON, without Python ----------------------------------------


def _content(key: str, kind: str) -> Column:
    """A note's field, wrapped in value or bare."""
    return F.coalesce(F.try_variant_get("v", f"$.content.{key}.value", kind), F.try_variant_get("v", f"$.content.{key}", kind))


def read_notes(df: DataFrame, column: str = "json") -> DataFrame:
    """Notes of pages of the form {"notes": [...]}."""
    notes = df.select(F.explode(F.from_json(F.get_json_object(column, "$.notes"), "array<string>")).alias("n"))
    v = notes.select(F.try_parse_json("n").alias("v"))
    ms = lambda k: F.timestamp_millis(F.try_variant_get("v", f"$.{k}", "bigint"))
    invitations = F.lower(F.array_join(F.coalesce(F.try_variant_get("v", "$.invitations", "array<string>"), F.array().cast("array<string>")), " "))
    out = v.select(
        F.try_variant_get("v", "$.id", "string").alias("id"), ms("tcdate").alias("created"), F.coalesce(ms("tmdate"), ms("tcdate")).alias("updated"), ms("pdate").alias("published"),
        _content("title", "string").alias("title"), _content("abstract", "string").alias("abstract"), _content("authors", "array<string>").alias("authors"),
        _content("keywords", "array<string>").alias("keywords"), F.coalesce(_content("venue", "string"), F.lit("")).alias("venue"), F.coalesce(_content("venueid", "string"), F.lit("")).alias("venueid"), invitations.alias("invitations"),
    )
    return out.withColumn("status", note_status(F.col("venue"), F.col("venueid")))


def note_status(venue: Column, venueid: Column) -> Column:
    both = F.lower(F.concat(venue, F.lit(" "), venueid))
    return F.when(F.contains(both, F.lit("withdrawn")), "withdrawn").when(F.contains(both, F.lit("reject")), "rejected").when(F.contains(both, F.lit("submitted")) | F.contains(both, F.lit("submission")) | (F.trim(both) == ""), "submitted").otherwise("accepted")


def read_models(df: DataFrame, column: str = "json") -> DataFrame:
    """Models of search pages: the latest revision of each."""
    v = df.select(F.explode(F.from_json(column, "array<string>")).alias("m")).select(F.try_parse_json("m").alias("v"))
    get = lambda k, kind: F.try_variant_get("v", f"$.{k}", kind)
    out = v.select(F.coalesce(get("id", "string"), get("modelId", "string")).alias("id"), get("lastModified", "string").alias("last_modified"), get("createdAt", "string").alias("created"), get("author", "string").alias("author"), get("tags", "array<string>").alias("tags"), get("pipeline_tag", "string").alias("task"), get("likes", "bigint").alias("likes"), get("downloads", "bigint").alias("downloads"))
    return out.filter("id is not null").groupBy("id").agg(F.max_by(F.struct(*[c for c in out.columns if c != "id"]), F.coalesce("last_modified", F.lit(""))).alias("x")).select("id", "x.*")


def card_summary(text: Column) -> Column:
    """A model card's first paragraph that is no heading, without front matter, at most 1000 characters."""
    body = F.regexp_replace(text, r"(?s)\A---\s*\n.*?\n---\s*(?:\n|\z)", "")
    paragraphs = F.transform(F.split(body, r"\n\s*\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " ")))
    good = F.filter(paragraphs, lambda p: (p != "") & ~p.rlike(r"^(?:#|<|!\[|\||```|\[!)"))
    return F.substring(F.get(good, F.lit(0)), 1, 1000)


def to_json(row: dict) -> str:
    return json.dumps(row, sort_keys=True, ensure_ascii=False)
