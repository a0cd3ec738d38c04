"""Queries over links at scale: star links, entities of chains, names within titles."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from heliograph.functions import urls
from heliograph.functions.numbers import round_floor
from heliograph.operators import archive, archive_index, linking, matching
from heliograph.plans.text import _CANON, _TOKENS, SEARCH
from heliograph.storage import shared_dir


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def identifier_stars(spark, d):
    """Pages by canonical URL: a row for each URL that several pages have, with its hub."""
    p = _t(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("u"))
    return linking.stars(p, "u", "page_id")[0].select(F.col("key").alias("canonical"), "hub", "nodes")


STARS = f"WITH {_CANON} SELECT canonical, min(page_id) AS hub, count(*) AS nodes FROM canon GROUP BY canonical HAVING count(*) > 1"


def part_stars(spark, d):
    """Suppliers of the same part, each linked to the part's smallest: as many links as members, however common a part is."""
    li = _t(spark, d, "lineitem").select(F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").cast("string")).alias("k"), "l_suppkey")
    return linking.stars(li, "k", "l_suppkey")[1]


PART_STARS = """
WITH m AS (SELECT DISTINCT l_returnflag || ' ' || l_linestatus || ' ' || CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR) AS k, l_suppkey AS n FROM lineitem),
h AS (SELECT k, min(n) AS hub FROM m GROUP BY k)
SELECT DISTINCT hub AS "left", n AS "right" FROM m JOIN h USING (k) WHERE n <> hub"""


def entity_chains(spark, d):
    """Entities of orders that follow one another at a customer: each is linked to the next alone, so components are chains."""
    o = _t(spark, d, "orders").withColumn("node", F.format_string("order:%09d", "o_orderkey"))
    nxt = F.lead("node").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return linking.entity_members(o.select(F.col("node").alias("left"), nxt.alias("right")).filter("right is not null"))


ENTITY_CHAINS = """
WITH o AS (SELECT o_custkey, printf('order:%09d', o_orderkey) AS node FROM orders),
e AS (SELECT o_custkey, 'entity:' || sha256(string_agg(node, chr(10) ORDER BY node))[1:16] AS entity_id FROM o GROUP BY o_custkey HAVING count(*) > 1)
SELECT entity_id, node FROM o JOIN e USING (o_custkey)"""


def names_in_titles(spark, d):
    """Names of two words from the table of parts, within the parts' names: whole words, in any order."""
    words = F.split(F.lower("p_name"), "[^a-z0-9]+")
    p = _t(spark, d, "part").select("p_partkey", "p_name", words.alias("w"))
    names = p.filter(F.size("w") >= 2).select(F.array_distinct(F.array(F.element_at("w", 1), F.element_at("w", -1))).alias("wa")).distinct().select(F.array_join("wa", "_").alias("a"), "wa")
    hits = linking.contained_sets(names, p.select(F.col("p_partkey").alias("b"), F.array_distinct("w").alias("wb")))
    return hits.groupBy(F.col("a").alias("name")).agg(F.count("*").alias("titles"), F.min("b").alias("first"))


NAMES_IN_TITLES = """
WITH p AS (SELECT p_partkey, regexp_split_to_array(lower(p_name), '[^a-z0-9]+') AS w FROM part),
n AS (SELECT DISTINCT CASE WHEN w[1] = w[-1] THEN [w[1]] ELSE [w[1], w[-1]] END AS wa FROM p WHERE len(w) >= 2)
SELECT array_to_string(wa, '_') AS name, count(*) AS titles, min(p_partkey) AS first FROM n JOIN p ON list_has_all(p.w, n.wa) GROUP BY ALL"""

def semantic_topics(spark, d):
    """Every whole document against a profile of each benchmark item: word and character n-grams, pruned by bounds."""
    docs = _t(spark, d, "documents").select("doc_id", F.lit("").alias("title"), "text")
    profiles = _t(spark, d, "benchmark").select(F.format_string("t%04d", "item_id").alias("topic"), "text")
    out = matching.semantic_topics(docs, "doc_id", "title", "text", profiles)
    return out.select("doc_id", "topic", round_floor(F.col("similarity"), 4).alias("similarity"), F.col("rank").cast("long").alias("rank"))


def _features(table: str, key: str) -> str:
    """SQL for key, feature, tf of a table's texts."""
    words = f"(SELECT {key} AS k, {_TOKENS.format(c='text')} AS t FROM {table})"
    grams = " UNION ALL ".join(f"SELECT k, 'c:' || p[i:i + {n - 1}] AS feature FROM (SELECT k, p, unnest(range(1, len(p) - {n - 2})) AS i FROM (SELECT k, ' ' || unnest(t) || ' ' AS p FROM {words}) WHERE len(p) >= {n})" for n in (3, 4, 5))
    return f"SELECT k, feature, count(*) AS tf FROM (SELECT k, 'w:' || unnest(t) AS feature FROM {words} UNION ALL SELECT k, 'w:' || t[i] || ' ' || t[i + 1] FROM (SELECT k, t, unnest(range(1, len(t))) AS i FROM {words}) UNION ALL {grams}) GROUP BY 1, 2"


SEMANTIC = f"""
WITH pc AS ({_features('benchmark', "printf('t%04d', item_id)")}),
idf AS (SELECT feature, ln((1 + (SELECT count(DISTINCT k) FROM pc))::DOUBLE / (1 + count(*))::DOUBLE) + 1 AS idf FROM pc GROUP BY feature),
dc AS (SELECT c.* FROM ({_features('documents', 'doc_id')}) c SEMI JOIN idf USING (feature)),
pv AS (SELECT k, feature, (1 + ln(tf)) * idf * CASE WHEN starts_with(feature, 'w:') THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END AS v FROM pc JOIN idf USING (feature)),
dv AS (SELECT k, feature, (1 + ln(tf)) * idf * CASE WHEN starts_with(feature, 'w:') THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END AS v FROM dc JOIN idf USING (feature)),
pn AS (SELECT k, sqrt(sum(v * v)) AS n FROM pv GROUP BY k), dn AS (SELECT k, sqrt(sum(v * v)) AS n FROM dv GROUP BY k),
s AS (SELECT dv.k AS doc_id, pv.k AS topic, round(sum(dv.v / dn.n * pv.v / pn.n), 6) AS similarity FROM dv JOIN pv USING (feature) JOIN dn ON dn.k = dv.k JOIN pn ON pn.k = pv.k GROUP BY 1, 2),
r AS (SELECT *, max(similarity) OVER (PARTITION BY doc_id) AS best, row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, topic) AS rank FROM s)
SELECT doc_id, topic, floor(similarity * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS similarity, rank FROM r WHERE similarity >= 0.12::DOUBLE AND similarity >= best * 0.68::DOUBLE AND rank <= 4"""


def archive_search_indexed(spark, d):
    """The archive search of whole documents through an index of trigrams, written first."""
    docs = _t(spark, d, "documents").withColumn("topics", F.array("lang", "source")).withColumn("reportable", F.col("n_chars") >= 200)
    kept = docs.filter(archive.filters(topics=["en"], columns={"source": "source"}))
    head, path = F.substring_index("text", "\n", 1), f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    archive_index.write_index(docs, path, "doc_id", head, F.col("source"), F.col("text"))
    return archive_index.search_indexed(kept, path, "the and", 20, head, F.col("source"), F.col("text"), "n_chars", "doc_id").select("doc_id", "score", "n_chars")


ALL = {"archive_search_indexed": (archive_search_indexed, SEARCH), "semantic_topics": (semantic_topics, SEMANTIC), "identifier_stars": (identifier_stars, STARS), "part_stars": (part_stars, PART_STARS), "entity_chains": (entity_chains, ENTITY_CHAINS), "names_in_titles": (names_in_titles, NAMES_IN_TITLES)}
