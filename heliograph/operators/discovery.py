"""Finding repositories: queries, gates, research quality, and the registry of watched ones."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions.numbers import clamp, round_even
from heliograph.functions.text import casefold, let, normalize_words
from heliograph.operators.ingest import keep_first
from heliograph.storage import written


@dataclass(frozen=True)
class Quality:
    """What adds to a repository's research score, what caps it, and from where on it counts."""

    baseline: float = 0.15
    research_term: float = 0.30
    publication_link: float = 0.50
    venue: float = 0.15
    homepage: float = 0.05
    stars: tuple[tuple[int, float], ...] = ((50, 0.10), (250, 0.05), (1000, 0.05))
    collection_cap: float = 0.15
    tutorial_cap: float = 0.25
    research_from: float = 0.40
    venue_only_from: float = 0.40
    semantic_only_from: float = 0.28
    collection_terms: tuple[str, ...] = ("awesome", "curated list", "paper list", "papers list", "resource list", "reading list")
    tutorial_terms: tuple[str, ...] = ("tutorial", "introduction", "beginner", "coursework", "assignment", "student project", "hands-on introduction")
    research_terms: tuple[str, ...] = ("official implementation", "official code", "code for our paper", "code for the paper", "paper implementation", "implementation of", "research code", "benchmark", "dataset", "framework", "library", "pretrained weights", "pretrained model", "checkpoint", "arxiv", "openreview")
    publication_hosts: tuple[str, ...] = ("arxiv.org", "openreview.net", "doi.org", "openaccess.thecvf.com", "paperswithcode.com")


def _says(text: Column, terms: tuple[str, ...]) -> Column:
    """Whether normalised text has one of the terms as whole words: one compiled pattern, so a text is walked once for all terms."""
    plain = [p for p in (re.sub("[^a-z0-9]+", " ", t.casefold()).strip() for t in terms) if p]
    return F.concat(F.lit(" "), text, F.lit(" ")).rlike(f" (?:{'|'.join(plain)}) ") if plain else F.lit(False)


def research_quality(name: Column, description: Column, topics: Column, homepage: Column, stars: Column, has_venue: Column, readme: Column | None = None, how: Quality = Quality(), round_to=round_even) -> Column:
    """score, category and signals of a repository: bonuses add up, lists and tutorials are capped."""
    none = F.lit("")
    read = F.coalesce(readme, none) if readme is not None else none
    identity = normalize_words(F.concat_ws(" ", F.coalesce(name, none), F.coalesce(description, none), F.array_join(F.coalesce(topics, F.array().cast("array<string>")), " ")))
    home = F.trim(F.coalesce(homepage, none))
    links = casefold(F.concat_ws(" ", home, F.coalesce(description, none), read))

    def linked(text: Column) -> Column:
        out = F.lit(False)
        for h in how.publication_hosts:
            out = out | F.contains(text, F.lit(h.casefold()))
        return out

    found = F.struct(identity.alias("identity"), let(links, linked).alias("linked"), home.alias("home"), F.coalesce(stars, F.lit(0)).cast("long").alias("n"), F.coalesce(has_venue, F.lit(False)).alias("venue"))
    evidence = lambda x: x["identity"] if readme is None else F.concat_ws(" ", x["identity"], normalize_words(read))
    read_once = lambda x: F.struct(x["home"].alias("home"), x["linked"].alias("linked"), x["n"].alias("n"), x["venue"].alias("venue"), _says(evidence(x), how.research_terms).alias("research"), _says(x["identity"], how.collection_terms).alias("listing"), _says(x["identity"], how.tutorial_terms).alias("teaching"))

    def judged(x: Column) -> Column:
        parts = [("research_term", x["research"], how.research_term), ("publication_link", x["linked"], how.publication_link), ("venue", x["venue"], how.venue), ("homepage", x["home"] != "", how.homepage)]
        parts += [(f"stars_{least}", x["n"] >= least, bonus) for least, bonus in how.stars]
        raw, said = F.lit(how.baseline), [F.lit("baseline")]
        for label, holds, bonus in parts:
            raw = raw + F.when(holds, F.lit(bonus)).otherwise(0.0)
            said.append(F.when(holds, F.lit(label)))
        score = F.when(x["listing"], F.least(raw, F.lit(how.collection_cap))).when(x["teaching"], F.least(raw, F.lit(how.tutorial_cap))).otherwise(raw)
        category = F.when(x["listing"], "collection").when(x["teaching"], "tutorial").when(raw >= how.research_from, "research").otherwise("candidate")
        said.append(F.when(x["listing"], "collection_cap").when(x["teaching"], "tutorial_cap"))
        return F.struct(round_to(clamp(score), 4).alias("score"), category.alias("category"), F.array_compact(F.array(*said)).alias("signals"))

    return let(let(found, read_once), judged)


# --- queries and gates -----------------------------------------------------------------


def search_text(query: str, locations: list[str], mode: str, since: str, until: str, least_stars: int = 0, public: bool = True, archived: bool = False) -> str:
    """A search with its qualifiers: where to look, what to leave out, stars for pushed ones only, and the time range."""
    parts = [query, f"in:{','.join(locations)}" if locations else "", "is:public" if public else "", "" if archived else "archived:false"]
    parts.append(f"stars:>={least_stars}" if mode == "pushed" and least_stars else "")
    return " ".join([*filter(None, parts), f"{mode}:{since}..{until}"])


def unquote(term: Column) -> Column:
    """Trimmed, without a pair of double quotes around it."""
    t = F.trim(term)
    return F.when((F.length(t) >= 2) & t.startswith('"') & t.endswith('"'), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def without_forks(repositories: DataFrame, fork: str = "fork") -> DataFrame:
    return repositories.filter(~F.coalesce(F.col(fork), F.lit(False)))


def has_context(restricted: Column, unrestricted: Column, text: Column, terms: tuple[str, ...]) -> Column:
    """False only for candidates that restricted queries alone found and whose normalised text has no context term."""
    return ~(restricted & ~unrestricted) | _says(text, terms)


def passes_discovery(method: Column, similarity: Column, venue_only: Column, research: Column, how: Quality = Quality()) -> Column:
    """Semantic matches alone need a higher similarity, venue hits alone a research score."""
    semantic = (method == "semantic_profile") & ~F.coalesce(similarity >= how.semantic_only_from, F.lit(False))
    return ~semantic & ~(venue_only & (research < how.venue_only_from))


def lexical_score(best: DataFrame, key: str, query_topics: str, evidence: float = 0.10, rest_weight: float = 0.10, rest_most: float = 0.20, round_to=round_even) -> DataFrame:
    """key, score, topics.  ``best``: key, query_topics (array), topic, score: the best field of each topic that matched, or a null topic.

    Topics of the queries that found a repository count ``evidence`` without a match.
    The best topic and a bounded share of the others add up, and once more ``evidence``
    if a query's topic matched better than that.
    """
    matched = best.groupBy(key).agg(F.min(query_topics).alias("asked"), F.map_from_entries(F.collect_list(F.when(F.col("topic").isNotNull(), F.struct("topic", "score")))).alias("m"))
    asked = F.coalesce("asked", F.array().cast("array<string>"))
    topics = F.array_sort(F.array_union(F.map_keys("m"), asked))
    scores = F.transform(topics, lambda t: F.greatest(F.coalesce(F.element_at("m", t), F.lit(0.0)), F.when(F.array_contains(asked, t), F.lit(evidence)).otherwise(0.0)))
    out = matched.select(key, topics.alias("topics"), scores.alias("scores"), F.exists(asked, lambda t: F.coalesce(F.element_at("m", t) > evidence, F.lit(False))).alias("better"))
    top, all_ = F.coalesce(F.array_max("scores"), F.lit(0.0)), F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    score = top + F.least((all_ - top) * rest_weight, F.lit(rest_most)) + F.when(F.col("better"), evidence).otherwise(0.0)
    return out.select(key, round_to(F.least(score, F.lit(1.0)), 4).alias("score"), "topics")


# --- the registry ----------------------------------------------------------------------


@dataclass(frozen=True)
class AutoWatch:
    """Stars and research scores from which a repository is watched without being asked for."""

    established_stars: int = 1000
    research_score: float = 0.40
    research_stars: int = 100
    strong_score: float = 0.65
    strong_stars: int = 25
    most: int = 100


def _tiers(stars: Column, research: Column, how: AutoWatch) -> list[tuple[str, Column]]:
    s, r = F.coalesce(stars, F.lit(0)), F.coalesce(research, F.lit(0.0))
    return [("established", s >= how.established_stars), ("research_tool", (r >= how.research_score) & (s >= how.research_stars)), ("strong_research", (r >= how.strong_score) & (s >= how.strong_stars))]


def promotion_reasons(stars: Column, research: Column, how: AutoWatch = AutoWatch()) -> Column:
    return F.array_compact(F.array(*[F.when(holds, F.lit(name)) for name, holds in _tiers(stars, research, how)]))


def auto_watch_eligible(fork: Column, archived: Column, category: Column, stars: Column, research: Column, how: AutoWatch = AutoWatch()) -> Column:
    """No fork, archive, list or tutorial, and of one of the three tiers."""
    no = F.coalesce(fork, F.lit(False)) | F.coalesce(archived, F.lit(False)) | F.coalesce(category.isin("collection", "tutorial"), F.lit(False))
    return ~no & (F.size(promotion_reasons(stars, research, how)) > 0)


def update_registry(registry: DataFrame, repositories: DataFrame, observed_at: str, how: AutoWatch = AutoWatch()) -> DataFrame:
    """The registry after a run: eligible repositories are entered or renewed, and the best ``most`` are kept.

    ``registry`` and ``repositories``: repo_id, full_name, url, topics, stars, research;
    the registry also first_promoted_at, last_observed_at; repositories also fork,
    archived, category; of rows with one repo_id the one with most stars counts.  Renewed entries keep their first promotion.  The order is tier,
    research score, logarithm of stars, last observation; equal ones by identifier.
    """
    columns = ["repo_id", "full_name", "url", "topics", "stars", "research"]
    good = repositories.filter(auto_watch_eligible(F.col("fork"), F.col("archived"), F.col("category"), F.col("stars"), F.col("research"), how))
    good = good.select(*[F.array_sort(F.array_distinct("topics")).alias("topics") if c == "topics" else F.col(c) for c in columns])
    good = written(keep_first(good, ["repo_id"], [F.desc("stars"), F.desc("research"), F.asc("full_name"), F.asc("url")]))  # read twice
    new = good.join(registry.select("repo_id", "first_promoted_at"), "repo_id", "left").select(*columns, F.coalesce("first_promoted_at", F.lit(observed_at)).alias("first_promoted_at"), F.lit(observed_at).alias("last_observed_at"))
    old = registry.select(*new.columns).join(good.select("repo_id"), "repo_id", "left_anti")
    out = new.unionByName(old).withColumn("promotion_reasons", promotion_reasons(F.col("stars"), F.col("research"), how))
    tier = F.when(F.array_contains("promotion_reasons", "established"), 3).when(F.array_contains("promotion_reasons", "strong_research"), 2).otherwise(1)
    return out.withColumn("tier", tier).orderBy(F.desc("tier"), F.desc("research"), F.desc(F.log1p("stars")), F.desc("last_observed_at"), "repo_id").limit(how.most)


def registry_counts(registry: DataFrame, repositories: DataFrame, how: AutoWatch = AutoWatch()) -> DataFrame:
    """eligible, promoted (not in the registry before) and tracked (after the bound), one row."""
    good = repositories.filter(auto_watch_eligible(F.col("fork"), F.col("archived"), F.col("category"), F.col("stars"), F.col("research"), how)).select("repo_id").distinct()
    marked = good.withColumn("new", F.lit(1)).join(registry.select("repo_id").distinct().withColumn("old", F.lit(1)), "repo_id", "full")
    return marked.agg(F.count("new").alias("eligible"), F.count_if(F.col("new").isNotNull() & F.col("old").isNull()).alias("promoted"), F.least(F.count("*"), F.lit(how.most)).alias("tracked"))


def watch_targets(registry: DataFrame) -> DataFrame:
    """repo, repo_id, priority, topics, auto_watch of entries with an owner in their name."""
    return registry.filter(F.contains("full_name", F.lit("/"))).select(F.col("full_name").alias("repo"), F.coalesce("repo_id", F.lit("")).alias("repo_id"), F.lit("normal").alias("priority"), F.coalesce("topics", F.array().cast("array<string>")).alias("topics"), F.lit(True).alias("auto_watch"))


def repository_order() -> list[Column]:
    return [F.desc("relevance"), F.asc(casefold(F.col("title")))]
