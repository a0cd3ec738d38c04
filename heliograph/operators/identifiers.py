"""What items say they are: identifiers, links to code and projects, venues."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions import urls
from heliograph.functions.text import casefold, contains_phrase, let, normalize_words

#: Metadata keys that may hold identifiers.
SCANNED_KEYS = ("homepage", "comment", "doi", "pdf_url", "pdf", "links", "external_urls", "code_urls", "project_urls")
#: Hosts of code, hosts that aren't a project's, and what labels say.
CODE_HOSTS = ("github.com", "gitlab.com", "codeberg.org", "bitbucket.org")
PUBLISHER_HOSTS = ("arxiv.org", "doi.org", "openreview.net", "openaccess.thecvf.com", "thecvf.com", "ieeexplore.ieee.org")
PROJECT_LABELS = ("project", "homepage", "website", "webpage", "demo", "interactive")
CODE_LABELS = ("code", "repository", "repo", "github", "gitlab")


def metadata_strings(metadata: Column, keys: tuple[str, ...] = SCANNED_KEYS) -> Column:
    """The non-blank strings under the keys of a JSON object, and those in lists under them, trimmed there."""
    found = []
    v = F.try_parse_json(metadata)
    for key in keys:
        one = F.try_variant_get(v, f"$.{key}", "string")
        kind = F.schema_of_variant(F.try_variant_get(v, f"$.{key}", "variant"))
        many = F.transform(F.coalesce(F.try_variant_get(v, f"$.{key}", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.trim(F.try_variant_get(x, "$", "string"))))
        found.append(F.when(kind == "STRING", F.array(one)).when(kind.startswith("ARRAY"), many).otherwise(F.array().cast("array<string>")))
    return F.filter(F.concat(*found), lambda x: x.isNotNull() & (F.trim(x) != ""))


def _entry(identifier: Column, origin: str) -> Column:
    return F.struct(identifier.alias("identifier"), F.lit(origin).alias("origin"))


def _of_text(text: Column, repositories: bool) -> list[Column]:
    out = [_entry(urls.github_repository(text), "github_repository")] if repositories else []
    return [*out, _entry(urls.arxiv_identifier(text), "arxiv"), _entry(urls.openreview_identifier(text), "openreview"), _entry(urls.doi_identifier(text), "doi")]


def exact_identifiers(items: DataFrame) -> DataFrame:
    """id, identifier, origin: one row for each identifier of an item.  ``items``: id, source, source_id, url, metadata (JSON).

    From the source's own identifier, the url, and strings under ``SCANNED_KEYS``: the
    text as a url, urls inside it, and arXiv, OpenReview and DOI numbers in either.  An
    identifier found in several ways keeps the origin that comes last in that order.
    """
    lower, number = F.lower("source_id"), F.substring_index("source_id", ":", 1)
    own = F.array(
        _entry(F.when(F.col("source") == "arxiv", F.concat(F.lit("arxiv:"), lower)), "source_id"),
        _entry(F.when(F.col("source") == "openreview", F.concat(F.lit("openreview:"), F.col("source_id"))), "source_id"),
        _entry(F.when((F.col("source") == "github") & number.rlike("^[0-9]+$"), F.concat(F.lit("github-repository-id:"), number)), "source_id"),
    )
    texts = F.concat(F.array("url"), metadata_strings(F.col("metadata")))

    def of_text(t: Column) -> Column:
        inside = F.flatten(F.transform(urls.extract_urls(t), lambda u: F.array(_entry(F.concat(F.lit("url:"), urls.canonical_url(u)), "embedded_url"), *_of_text(u, True))))
        return F.concat(F.array(_entry(F.concat(F.lit("url:"), urls.canonical_url(t)), "url")), inside, F.array(*_of_text(t, False)))

    doi = F.trim(F.try_variant_get(F.try_parse_json("metadata"), "$.doi", "string"))
    doi = F.array(_entry(urls.doi_identifier(F.when(doi.rlike("^10\\."), doi).otherwise(F.concat(F.lit("doi:"), doi))), "doi"))
    found = items.select("id", F.posexplode(F.concat(own, F.flatten(F.transform(texts, of_text)), doi)).alias("at", "x")).filter("x.identifier is not null")
    return found.groupBy("id", F.col("x.identifier").alias("identifier")).agg(F.max_by(F.col("x.origin"), "at").alias("origin"))


def repository_name(title: Column, url: Column) -> Column:
    """What follows the last slash of a title, else of the repository in the url, else the title."""
    return F.when(F.contains(title, F.lit("/")), F.substring_index(title, "/", -1)).otherwise(F.coalesce(F.substring_index(urls.github_repository(url), "/", -1), title))


def absolute_url(base: Column, href: Column) -> Column:
    """A link as seen from a page: absolute ones stay, // takes the scheme, / the host, ? and others the folder; . and .. aren't resolved."""
    root, path = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), urls.path_of(base)
    folder = F.regexp_replace(F.when(path == "", F.lit("/")).otherwise(path), "[^/]*$", "")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(root, path, href))
        .otherwise(F.concat(root, folder, href))
    )


def research_links(links: DataFrame, key: str = "id") -> DataFrame:
    """key, project_urls, code_urls, external_urls: sorted canonical urls.  ``links``: key, base_url, href, label, context.

    Anchors, mail and scripts, and publishers' hosts are left out.  Links to code hosts,
    or said to be code, are code; of the rest, those said to be a project or standing
    in an abstract are projects; external ones are all.
    """
    raw = F.trim("href")
    out = links.filter(F.col("href").isNotNull() & (raw != "") & ~raw.rlike("^(?:mailto:|javascript:|#)"))
    out = out.select(key, urls.canonical_url(absolute_url(F.col("base_url"), raw)).alias("u"), casefold(F.concat_ws(" ", F.coalesce("label", F.lit("")), F.coalesce("context", F.lit("")))).alias("said"), (F.col("context") == "abstract").alias("abstract"))
    host = F.regexp_replace(urls.host_of(F.col("u")), r":[0-9]+$", "")
    out = out.filter(F.col("u").isNotNull() & ~host.isin(*PUBLISHER_HOSTS))
    says = lambda words: F.col("said").rlike("|".join(words))
    code = host.isin(*CODE_HOSTS) | says(CODE_LABELS)
    project = ~code & (says(PROJECT_LABELS) | F.coalesce("abstract", F.lit(False)))
    several = lambda c, name: F.array_sort(F.collect_set(F.when(c, F.col("u")))).alias(name)
    return out.groupBy(key).agg(several(project, "project_urls"), several(code, "code_urls"), several(F.lit(True), "external_urls"))


def project_items(items: DataFrame, project_urls: str = "project_urls") -> DataFrame:
    """A hidden item for each project page of an item, related to it and with its texts, topics and scores."""
    out = items.withColumn("__url", F.explode(project_urls))
    digest = urls.short_hash(F.concat_ws("\n", "id", "__url"), 20)
    said = F.to_json(F.struct(F.lit("discovered").alias("action"), F.col("id").alias("parent_item_id"), F.col("source_id").alias("parent_source_id"), F.col("source").alias("discovery_source"), F.lit(False).alias("reportable")))
    changed = {
        "id": F.concat_ws(":", F.col("source"), F.lit("project"), digest), "source_id": F.concat_ws(":", F.col("source_id"), F.lit("project"), digest),
        "kind": F.lit("project"), "title": F.concat(F.lit("Project page — "), F.col("title")), "url": F.col("__url"), "related_items": F.array("id"), "metadata": said,
    }
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in items.columns if c != project_urls])


def venue_of(comment: Column, journal: Column, venues: list[tuple[str, list[str]]]) -> Column:
    """The first venue, in order, with an alias of at least three letters or digits in either text; null if none."""
    def first(text: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, aliases in reversed(venues):
            plain = [p for p in (re.sub("[^a-z0-9]+", " ", a.casefold()).strip() for a in aliases) if len(p.replace(" ", "")) >= 3]
            if plain:
                some = F.lit(False)
                for p in plain:
                    some = some | contains_phrase(text, F.lit(p))
                out = F.when(some, F.lit(name)).otherwise(out)
        return out

    return let(normalize_words(F.concat_ws(" ", comment, journal)), first)
