"""Source records as items.  Rows carry what classification found: topics, matched_terms, relevance, evidence (JSON), and run_at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions.times import format_iso
from heliograph.functions.urls import extract_urls, short_hash
from heliograph.operators.identifiers import venue_of
from heliograph.schema import ITEM_SCHEMA
from heliograph.sources.parsers import card_summary


def _items(rows: DataFrame, said: list[Column], **fields: Column) -> DataFrame:
    """Items of fields and metadata; what isn't given is null, or an empty list or map."""
    evidence = [F.col("evidence").alias("classification")] if "evidence" in rows.columns else []
    fields = {"discovered_at": F.col("run_at"), "topics": F.col("topics"), "matched_terms": F.col("matched_terms"), "scores": F.create_map(F.lit("relevance"), F.col("relevance")), "metadata": F.to_json(F.struct(*said, *evidence))} | fields
    out = []
    for f in ITEM_SCHEMA.fields:
        kind = f.dataType.simpleString()
        value = fields.get(f.name, F.lit(None))
        empty = F.array() if kind.startswith("array") else F.create_map() if kind.startswith("map") else None
        out.append((value.cast(kind) if empty is None else F.coalesce(value.cast(kind), empty.cast(kind))).alias(f.name))
    return rows.select(*out)


def preprint_items(papers: DataFrame, venues: list[tuple[str, list[str]]] = ()) -> DataFrame:
    """``papers`` as from ``read_preprints``; a venue is taken from comment and journal."""
    number = F.col("paper_id")
    said = [F.concat(number, F.lit("v"), F.col("version").cast("string")).alias("versioned_id"), *map(F.col, ("categories", "primary_category", "comment", "journal_ref", "doi", "pdf_url"))]
    venue = venue_of(F.col("comment"), F.col("journal_ref"), list(venues))
    return _items(papers, said, id=F.concat(F.lit("arxiv:paper:"), number), source=F.lit("arxiv"), source_id=number, kind=F.lit("paper"), title=F.col("title"), url=F.col("url"), published_at=F.col("published"), updated_at=F.col("updated"), summary=F.col("summary"), authors=F.col("authors"), venue=venue)


def note_items(notes: DataFrame) -> DataFrame:
    """``notes`` as from ``read_notes``, with venue_name, year and group of the edition."""
    said = [F.col("status"), F.col("year").alias("venue_year"), F.col("group").alias("openreview_venue_id"), F.when(F.col("venue") != "", F.col("venue")).alias("venue_label"), F.col("keywords")]
    return _items(notes, said, id=F.concat(F.lit("openreview:paper:"), F.col("id")), source=F.lit("openreview"), source_id=F.col("id"), kind=F.lit("paper"), title=F.coalesce("title", F.lit("")), url=F.concat(F.lit("https://openreview.net/forum?id="), F.col("id")), published_at=format_iso(F.coalesce("published", "created")), updated_at=format_iso(F.col("updated")), summary=F.when(F.col("abstract") != "", F.col("abstract")), authors=F.col("authors"), venue=F.col("venue_name"))


def status_items(moves: DataFrame) -> DataFrame:
    """An event for each note whose status moved: notes with previous_status."""
    moved = moves.filter(F.col("previous_status").isNotNull() & (F.col("previous_status") != F.col("status")))
    at = F.coalesce("updated", "published", "created")
    key = F.coalesce(F.unix_millis(at).cast("string"), F.col("run_at"))
    source_id = F.concat_ws(":", F.col("id"), F.lit("status"), "previous_status", "status", key)
    page = F.concat(F.lit("https://openreview.net/forum?id="), F.col("id"))
    said = [F.lit("status_changed").alias("action"), F.col("id").alias("paper_id"), page.alias("paper_url"), F.col("previous_status"), F.col("status"), F.col("year").alias("venue_year"), F.col("group").alias("openreview_venue_id")]
    return _items(moved, said, id=F.concat(F.lit("openreview:event:"), source_id), source=F.lit("openreview"), source_id=source_id, kind=F.lit("event"), title=F.coalesce("title", F.lit("")), url=page, published_at=F.coalesce(format_iso(at), F.col("run_at")), updated_at=format_iso(at), summary=F.when(F.col("abstract") != "", F.col("abstract")), authors=F.col("authors"), venue=F.col("venue_name"))


def index_items(papers: DataFrame) -> DataFrame:
    """Index papers with their details: source_id, title, authors, detail_title, detail_authors, abstract, url, pdf, supplement, bibtex, edition, venue_name, year, and the three lists of ``research_links``."""
    said = [F.lit("discovered").alias("action"), F.col("year").alias("venue_year"), F.col("edition").alias("edition_id"), F.col("pdf").alias("pdf_url"), F.col("supplement").alias("supplemental_url"), F.col("bibtex").alias("bibtex_url"), *map(F.col, ("project_urls", "code_urls", "external_urls"))]
    authors = F.when(F.size("detail_authors") > 0, F.col("detail_authors")).otherwise(F.col("authors"))
    return _items(papers, said, id=F.concat(F.lit("cvf:paper:"), F.col("source_id")), source=F.lit("cvf"), source_id=F.col("source_id"), kind=F.lit("paper"), title=F.coalesce(F.when(F.col("detail_title") != "", F.col("detail_title")), F.col("title")), url=F.col("url"), summary=F.when(F.col("abstract") != "", F.col("abstract")), authors=authors, venue=F.col("venue_name"))


def model_items(models: DataFrame) -> DataFrame:
    """``models`` as from ``read_models``, with card (text or null), description (of the card's data, or null) and action."""
    key = F.concat_ws("@", "id", "last_modified")
    links = F.array_sort(F.array_distinct(extract_urls(F.coalesce("card", F.lit("")))))
    said = [F.col("action"), F.col("id").alias("repo_id"), F.col("task").alias("pipeline_tag"), F.col("tags"), F.col("downloads"), F.col("likes"), F.col("created").alias("created_at"), F.col("last_modified"), links.alias("links")]
    owner = F.when(F.contains("id", F.lit("/")), F.substring_index("id", "/", 1))
    return _items(models, said, id=F.concat(F.lit("huggingface:model:"), short_hash(key, 24)), source=F.lit("huggingface"), source_id=key, kind=F.lit("model"), title=F.col("id"), url=F.concat(F.lit("https://huggingface.co/"), F.col("id")), published_at=F.col("created"), updated_at=F.col("last_modified"), summary=F.coalesce(F.when(F.trim("description") != "", F.trim("description")), card_summary(F.col("card"))), organization=owner)


def article_items(entries: DataFrame) -> DataFrame:
    """``entries`` as from ``read_feed``, with feed_id, feed_name, organization and feed_priority."""
    digest = short_hash(F.concat_ws("\n", "feed_id", "entry_id"), 24)
    links = F.array_sort(F.array_distinct(extract_urls(F.coalesce("summary", F.lit("")))))
    said = [F.lit("published").alias("action"), F.col("feed_id"), F.col("feed_name"), F.col("categories"), links.alias("links")]
    return _items(entries, said, id=F.concat(F.lit("research_blog:article:"), digest), source=F.lit("research_blog"), source_id=F.concat_ws(":", "feed_id", digest), kind=F.lit("article"), title=F.col("title"), url=F.col("url"), published_at=F.col("published"), summary=F.when(F.col("summary") != "", F.col("summary")), authors=F.col("authors"), organization=F.col("organization"), priority=F.create_map(F.lit("source"), F.col("feed_priority").cast("double")))


def card_values(card: Column) -> Column:
    """The strings of a card's data (JSON object) and of its lists, numbers as text, in order; results of evaluations are left out."""
    v = F.map_filter(F.coalesce(F.from_json(card, "map<string, string>"), F.create_map().cast("map<string,string>")), lambda k, _: ~F.lower(k).isin("model-index", "model_index"))

    def of(x: Column) -> Column:
        many = F.filter(F.transform(F.from_json(x, "array<string>"), lambda y: y), lambda y: y.isNotNull() & ~y.rlike(r"^\s*[\[{]"))
        return F.when(x.startswith("["), F.coalesce(many, F.array().cast("array<string>"))).when(x.startswith("{") | x.rlike("^(?:true|false|-?[0-9.]+)$"), F.array().cast("array<string>")).otherwise(F.array(x))

    return F.flatten(F.transform(F.filter(F.map_values(v), lambda x: x.isNotNull()), of))


def model_text(task: Column, library: Column, tags: Column, card: Column) -> Column:
    """What a model is classified by: task, library, tags and card data, a line each, without empty ones."""
    parts = F.concat(F.array(task, library, F.array_join(F.coalesce(tags, F.array().cast("array<string>")), " ")), card_values(card))
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), "\n")
