"""Registered queries that make items and judge them: identifiers, links, venues, research quality, watching, classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.numbers import round_floor
from heliograph.operators import discovery, identifiers, matching, watch
from heliograph.plans.text import _CANON, _NORM
from heliograph.storage import written

_NOW = "2024-02-01T00:00:00Z"
_BEFORE = "2024-01-01T00:00:00Z"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def item_identifiers(spark, d):
    """Pages as items whose metadata name the same page again, and a DOI."""
    n = F.col("page_id").cast("string")
    said = F.to_json(F.struct(F.concat(F.lit("see <"), F.col("url"), F.lit("> or doi:10.1234/AB-"), n, F.lit(".")).alias("comment"), F.array(F.concat(F.col("url"), F.lit("#top"))).alias("links"), F.lit(7).alias("homepage")))
    items = _t(spark, d, "pages").select(F.concat(F.lit("page:"), n).alias("id"), F.lit("github").alias("source"), F.concat(n, F.lit(":x")).alias("source_id"), "url", said.alias("metadata"))
    return identifiers.exact_identifiers(items)


IDENTIFIERS = f"""WITH {_CANON}
SELECT 'page:' || page_id AS id, 'github-repository-id:' || page_id AS identifier, 'source_id' AS origin FROM pages UNION ALL
SELECT 'page:' || page_id, 'doi:10.1234/ab-' || page_id, 'doi' FROM pages UNION ALL SELECT 'page:' || page_id, 'url:' || canonical, 'embedded_url' FROM canon"""

#: Stand-ins for venues: aliases of common words; the last one's is too short to count.
VENUES = [("west", ["und die", "the work"]), ("south", ["de la", "los"]), ("north", ["und"]), ("short", ["la"])]


def venue_inference(spark, d):
    venue = identifiers.venue_of(F.col("text"), F.col("source"), VENUES)
    return _t(spark, d, "documents").select("doc_id", venue.alias("venue"))


_SAYS = lambda t, words: "(" + " OR ".join(f"contains({t}, ' {w} ')" for w in words) + ")"
VENUE_SQL = f"""SELECT doc_id, CASE WHEN {_SAYS('n', VENUES[0][1])} THEN 'west' WHEN {_SAYS('n', VENUES[1][1])} THEN 'south' WHEN {_SAYS('n', VENUES[2][1])} THEN 'north' END AS venue
FROM (SELECT doc_id, ' ' || {_NORM.format(c="text || ' ' || source")} || ' ' AS n FROM documents)"""


def research_links(spark, d):
    """Navigation links of pages, made absolute; what they say decides where they go."""
    pattern = F.lit(r'<a href="([^"]*)">([^<]*)</a>')
    both = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("label"))
    links = _t(spark, d, "pages").select("page_id", F.col("url").alias("base_url"), F.explode(both).alias("x")).select("page_id", "base_url", "x.href", F.when(F.col("x.label").startswith("t"), F.concat(F.lit("Project "), "x.label")).when(F.col("x.label").startswith("d"), F.concat("x.label", F.lit(" code"))).otherwise(F.col("x.label")).alias("label"), F.lit(None).cast("string").alias("context"))
    out = identifiers.research_links(links, "page_id")
    return out.select("page_id", F.size("project_urls").cast("long").alias("projects"), F.size("code_urls").cast("long").alias("codes"), F.array_join("external_urls", " ").alias("external_urls"))


LINKS = r"""WITH l AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\.', '') AS host, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS label FROM pages),
u AS (SELECT page_id, 'https://' || host || CASE WHEN regexp_replace(split_part(split_part(trim(href), '#', 1), '?', 1), '/+', '/', 'g') = '/' THEN '/' ELSE rtrim(regexp_replace(split_part(split_part(trim(href), '#', 1), '?', 1), '/+', '/', 'g'), '/') END AS u,
  CASE WHEN starts_with(label, 't') THEN 'project ' || lower(label) WHEN starts_with(label, 'd') THEN lower(label) || ' code' ELSE lower(label) END AS said FROM l WHERE trim(href) <> '' AND NOT starts_with(trim(href), '#')),
k AS (SELECT page_id, u, regexp_matches(said, 'code|repository|repo|github|gitlab') AS code, regexp_matches(said, 'project|homepage|website|webpage|demo|interactive') AS project FROM u)
SELECT page_id, count(DISTINCT u) FILTER (project AND NOT code) AS projects, count(DISTINCT u) FILTER (code) AS codes, array_to_string(list_sort(list_distinct(list(u))), ' ') AS external_urls FROM k GROUP BY 1"""

#: Stand-ins for terms of the texts at hand.
QUALITY = discovery.Quality(research_terms=("the", "license"), collection_terms=("los las", "und und"), tutorial_terms=("du", "ein"), publication_hosts=("example.com", "ARXIV.org"))


def _repositories(spark: SparkSession, d: str) -> DataFrame:
    """Documents as repositories."""
    docs = _t(spark, d, "documents")
    found = discovery.research_quality(F.concat_ws("/", "source", "lang"), F.col("text"), F.array("lang"), F.when(F.col("lang") == "fr", F.lit(" https://a.org ")), F.col("n_chars"), F.col("lang") == "de", how=QUALITY, round_to=round_floor)
    return docs.select("doc_id", "lang", "source", "n_chars", found.alias("q"))


def research_quality(spark, d):
    return _repositories(spark, d).select("doc_id", "q.score", "q.category", F.array_join("q.signals", ",").alias("signals"))


_STARS = [f"CASE WHEN n_chars >= {least} THEN {bonus}::DOUBLE ELSE 0::DOUBLE END" for least, bonus in QUALITY.stars]
_QUALITY = f"""
n AS (SELECT doc_id, lang, source, n_chars, ' ' || {_NORM.format(c="source || '/' || lang || ' ' || text || ' ' || lang")} || ' ' AS n, lower(text) AS l FROM documents),
f AS (SELECT *, {_SAYS('n', QUALITY.research_terms)} AS a, (contains(l, 'example.com') OR contains(l, 'arxiv.org')) AS b, {_SAYS('n', QUALITY.collection_terms)} AS c, {_SAYS('n', QUALITY.tutorial_terms)} AS t FROM n),
r AS (SELECT *, 0.15::DOUBLE + CASE WHEN a THEN 0.3::DOUBLE ELSE 0::DOUBLE END + CASE WHEN b THEN 0.5::DOUBLE ELSE 0::DOUBLE END + CASE WHEN lang = 'de' THEN 0.15::DOUBLE ELSE 0::DOUBLE END + CASE WHEN lang = 'fr' THEN 0.05::DOUBLE ELSE 0::DOUBLE END + {' + '.join(_STARS)} AS raw FROM f),
q AS (SELECT *, floor(least(CASE WHEN c THEN least(raw, 0.15::DOUBLE) WHEN t THEN least(raw, 0.25::DOUBLE) ELSE raw END, 1::DOUBLE) * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS score,
  CASE WHEN c THEN 'collection' WHEN t THEN 'tutorial' WHEN raw >= 0.4::DOUBLE THEN 'research' ELSE 'candidate' END AS category FROM r)"""
QUALITY_SQL = f"""WITH {_QUALITY}
SELECT doc_id, score, category, array_to_string(list_filter(['baseline', CASE WHEN a THEN 'research_term' END, CASE WHEN b THEN 'publication_link' END, CASE WHEN lang = 'de' THEN 'venue' END, CASE WHEN lang = 'fr' THEN 'homepage' END,
  CASE WHEN n_chars >= 50 THEN 'stars_50' END, CASE WHEN n_chars >= 250 THEN 'stars_250' END, CASE WHEN n_chars >= 1000 THEN 'stars_1000' END, CASE WHEN c THEN 'collection_cap' WHEN t THEN 'tutorial_cap' END], lambda x: x IS NOT NULL), ',') AS signals FROM q"""


def _registry(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A registry of long documents, some of which aren't eligible now, and all documents as repositories."""
    r = _repositories(spark, d).select(F.format_string("%08d", "doc_id").alias("repo_id"), F.concat_ws("/", "source", "doc_id").alias("full_name"), F.lit("u").alias("url"), F.array("lang").alias("topics"), F.col("n_chars").alias("stars"), F.col("q.score").alias("research"), (F.col("lang") == "es").alias("fork"), F.lit(False).alias("archived"), F.col("q.category").alias("category"))
    r = written(r)  # scored once, read by each side of what follows
    old = r.filter("stars > 3000").select("repo_id", "full_name", "url", "topics", "stars", "research", F.lit(_BEFORE).alias("first_promoted_at"), F.lit(_BEFORE).alias("last_observed_at"))
    return old, r


def auto_watch(spark, d):
    old, r = _registry(spark, d)
    out = discovery.update_registry(old, r, _NOW)
    return out.select("repo_id", "tier", F.array_join("promotion_reasons", ",").alias("reasons"), "first_promoted_at", "last_observed_at")


def auto_watch_counts(spark, d):
    return discovery.registry_counts(*_registry(spark, d))


_WATCH = f"""{_QUALITY},
e AS (SELECT printf('%08d', doc_id) AS repo_id, n_chars AS stars, score AS research, lang <> 'es' AND category NOT IN ('collection', 'tutorial') AND (n_chars >= 1000 OR (score >= 0.4::DOUBLE AND n_chars >= 100) OR (score >= 0.65::DOUBLE AND n_chars >= 25)) AS good, n_chars > 3000 AS old FROM q)"""
AUTO_WATCH = f"""WITH {_WATCH}
SELECT repo_id, CAST(CASE WHEN stars >= 1000 THEN 3 WHEN research >= 0.65::DOUBLE AND stars >= 25 THEN 2 ELSE 1 END AS INTEGER) AS tier,
  array_to_string(list_filter([CASE WHEN stars >= 1000 THEN 'established' END, CASE WHEN research >= 0.4::DOUBLE AND stars >= 100 THEN 'research_tool' END, CASE WHEN research >= 0.65::DOUBLE AND stars >= 25 THEN 'strong_research' END], lambda x: x IS NOT NULL), ',') AS reasons,
  CASE WHEN old THEN '{_BEFORE}' ELSE '{_NOW}' END AS first_promoted_at, CASE WHEN good THEN '{_NOW}' ELSE '{_BEFORE}' END AS last_observed_at
FROM e WHERE good OR old ORDER BY tier DESC, research DESC, stars DESC, last_observed_at DESC, repo_id LIMIT 100"""
WATCH_COUNTS = f"WITH {_WATCH} SELECT count(*) FILTER (good) AS eligible, count(*) FILTER (good AND NOT old) AS promoted, least(count(*) FILTER (good OR old), 100) AS tracked FROM e"


def discovery_gates(spark, d):
    """Which documents pass as candidates, by context and by how they were found."""
    r = _repositories(spark, d).join(_t(spark, d, "documents").select("doc_id", "text"), "doc_id")
    text = F.col("text")
    context = discovery.has_context(F.col("lang").isin("de", "es"), F.col("lang") == "es", matching.normalize_words(text), ("der", "license"))
    method = F.when(F.col("n_chars") > 800, "semantic_profile").otherwise("lexical")
    passes = discovery.passes_discovery(method, F.col("n_chars") / 4000.0, F.col("source") == "src1", F.col("q.score"))
    return r.groupBy("lang", context.alias("context"), passes.alias("passes")).agg(F.count("*").alias("n"))


GATES = f"""WITH {_QUALITY}, g AS (SELECT lang, NOT (lang IN ('de', 'es') AND lang <> 'es') OR {_SAYS("' ' || " + _NORM.format(c='text') + " || ' '", ('der', 'license'))} AS context,
  NOT (n_chars > 800 AND n_chars / 4000::DOUBLE < 0.28::DOUBLE) AND NOT (q.source = 'src1' AND score < 0.4::DOUBLE) AS passes FROM q JOIN documents USING (doc_id, lang, n_chars))
SELECT lang, context, passes, count(*) AS n FROM g GROUP BY 1, 2, 3"""


def classification_cascade(spark, d):
    """Lexical matches, enriched; an outside classifier that knows some texts and abstains on others; profiles for the rest."""
    sim = F.floor(F.col("n_chars") / 100) / 100.0
    semantic = F.when(F.col("lang") != "fr", F.array(F.struct(F.col("lang").alias("topic"), sim.alias("similarity")), F.struct(F.lit("zz").alias("topic"), (sim / 2).alias("similarity")))).otherwise(F.array().cast("array<struct<topic:string,similarity:double>>"))
    scored = _t(spark, d, "documents").select("doc_id", F.lit("").alias("title"), "text", F.when(F.col("source") == "src0", 0.5).otherwise(0.1).alias("lexical"), F.array("source").alias("lexical_topics"), semantic.alias("semantic"))
    said = lambda title, text, topics: F.when(F.contains(text, F.lit("the")), F.struct(F.lit(True).alias("relevant"), F.lit(0.75).alias("relevance"), F.array(F.get(topics, F.lit(0)), F.lit("no candidate")).alias("topics")))
    return matching.classify(scored, 0.3, said).select("doc_id", "result.accepted", "result.relevance", F.array_join("result.topics", ",").alias("topics"), "result.method")


CASCADE = """WITH s AS (SELECT doc_id, lang, source, text, source = 'src0' AS lex, CASE WHEN lang <> 'fr' THEN floor(n_chars / 100) / 100::DOUBLE ELSE 0::DOUBLE END AS b FROM documents),
m AS (SELECT *, NOT lex AND lang <> 'fr' AND b BETWEEN 0.1::DOUBLE AND 0.28::DOUBLE AND contains(text, 'the') AS asked FROM s)
SELECT doc_id, lex OR asked OR (b >= 0.16::DOUBLE AND lang <> 'fr') AS accepted,
  CASE WHEN lex THEN 0.5::DOUBLE WHEN asked THEN 0.75::DOUBLE WHEN b >= 0.16::DOUBLE AND lang <> 'fr' THEN round(least(b / 0.4::DOUBLE, 1::DOUBLE), 4) ELSE 0.1::DOUBLE END AS relevance,
  CASE WHEN lex THEN array_to_string(list_sort(list_filter([source, CASE WHEN b >= 0.22::DOUBLE THEN lang END, CASE WHEN b / 2 >= 0.22::DOUBLE THEN 'zz' END], lambda x: x IS NOT NULL)), ',')
    WHEN asked THEN lang WHEN b >= 0.16::DOUBLE AND lang <> 'fr' THEN lang || ',zz' ELSE '' END AS topics,
  CASE WHEN lex THEN CASE WHEN b >= 0.22::DOUBLE THEN 'lexical+semantic_profile' ELSE 'lexical' END WHEN asked THEN 'classifier' ELSE 'semantic_profile' END AS method FROM m"""


def repository_updates(spark, d):
    """Parts as repositories whose description and stars moved since their snapshot."""
    def record(description, stars):
        return F.from_json(F.to_json(F.struct(F.col("p_partkey").alias("id"), F.concat_ws("/", "p_brand", "p_name").alias("full_name"), F.lit("https://a.org").alias("html_url"), description.alias("description"), F.array(F.lit("b"), F.lit("a")).alias("topics"), F.lit(_NOW).alias("updated_at"), stars.cast("long").alias("stargazers_count"))), watch.REPOSITORY)

    rows = _t(spark, d, "part").select(record(F.col("p_type"), F.col("p_size")).alias("r"), F.when(F.col("p_size") > 5, record(F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lit("old")), F.col("p_size") - 3)).alias("was"))
    rows = rows.withColumn("was", F.when(F.col("was").isNotNull(), watch.snapshot(F.col("was")))).withColumn("p", watch.popularity(F.col("r"), F.col("was"))).withColumn("changes", watch.changes(F.col("was"), watch.snapshot(F.col("r"))))
    rows = rows.withColumn("topics", F.array(F.lit("t"))).withColumn("priority", F.when(F.col("p.stars") > 30, "high")).withColumn("run_at", F.lit(_NOW))
    first = watch.created_items(rows.filter("was is null"))
    out = first.unionByName(watch.updated_items(rows.filter("was is not null")))
    said = F.from_json("metadata", "action string, stars_delta long, changes map<string, struct<old: string, new: string>>")
    return out.select(F.regexp_replace("id", ":[0-9a-f]{16}$", "").alias("id"), "kind", "title", "organization", F.element_at("priority", "source").alias("priority"), said["action"].alias("action"), said["stars_delta"].alias("stars_delta"), said["changes"]["description"]["old"].alias("old_description"))


UPDATES = f"""SELECT CASE WHEN p_size <= 5 THEN 'github:repository:' || p_partkey ELSE 'github:event:' || p_partkey || ':metadata:{_NOW}' END AS id, CASE WHEN p_size <= 5 THEN 'repository' ELSE 'event' END AS kind,
  p_brand || '/' || p_name || CASE WHEN p_size <= 5 THEN '' ELSE ' repository metadata updated' END AS title, p_brand AS organization, CASE WHEN p_size > 30 THEN 1::DOUBLE ELSE 0.5::DOUBLE END AS priority,
  CASE WHEN p_size <= 5 THEN 'created' ELSE 'metadata_updated' END AS action, CAST(CASE WHEN p_size <= 5 THEN 0 ELSE 3 END AS BIGINT) AS stars_delta, CASE WHEN p_size > 5 THEN 'old' END AS old_description FROM part WHERE p_size <= 25"""


def revision_actions(spark, d):
    """Listed orders against the known ones: unchanged versions are left out."""
    o = _t(spark, d, "orders")
    listed = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("last_modified"))
    known = o.filter("o_totalprice > 100000").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_totalprice") > 200000, F.col("o_orderstatus")).otherwise(F.lit("?")).alias("last_modified"))
    return watch.revisions(listed, known).select("id", "action")


REVISIONS = "SELECT o_orderkey AS id, CASE WHEN o_totalprice > 100000 THEN 'updated' ELSE 'discovered' END AS action FROM orders WHERE o_totalprice <= 200000"

ALL = {
    "item_identifiers": (item_identifiers, IDENTIFIERS), "venue_inference": (venue_inference, VENUE_SQL), "research_links": (research_links, LINKS), "research_quality": (research_quality, QUALITY_SQL), "auto_watch": (auto_watch, AUTO_WATCH),
    "auto_watch_counts": (auto_watch_counts, WATCH_COUNTS), "discovery_gates": (discovery_gates, GATES), "classification_cascade": (classification_cascade, CASCADE), "repository_updates": (repository_updates, UPDATES), "revision_actions": (revision_actions, REVISIONS),
}
