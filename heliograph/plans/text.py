"""Registered queries over texts, pages and vectors: matching, TF-IDF, linking, archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliograph.functions import urls
from heliograph.functions.numbers import round_floor
from heliograph.functions.text import compact, normalize_words, tokens, word_ngrams
from heliograph.operators import archive, evaluation, linking, matching


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_NORM = "trim(regexp_replace(lower(replace(replace({c}, 'ß', 'ss'), 'ẞ', 'ss')), '[^a-z0-9]+', ' ', 'g'))"
_TOKENS = f"list_filter(string_split({_NORM}, ' '), lambda t: t <> '')"


def norm_text(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.sha2(normalize_words(F.col("text")), 256).alias("norm"))


def compact_summary(spark, d):
    return _t(spark, d, "documents").select("doc_id", compact(F.col("text"), 120).alias("summary"))


SUMMARY = """
WITH f AS (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g')) AS flat FROM documents)
SELECT doc_id, CASE WHEN length(flat) <= 120 THEN flat ELSE rtrim(flat[1:119]) || '…' END AS summary FROM f"""


def _aliases(spark: SparkSession, d: str) -> DataFrame:
    """First three words of the benchmark's texts stand for aliases, every fourth item for a topic."""
    words = F.slice(tokens(normalize_words(F.col("text"))), 1, 3)
    b = _t(spark, d, "benchmark").select((F.col("item_id") % 4).cast("string").alias("topic"), F.array_join(words, " ").alias("alias"), F.col("item_id").alias("ord"))
    return b.filter("alias <> ''")


_ALIASES = f"""
al AS (SELECT CAST(item_id % 4 AS VARCHAR) AS topic, array_to_string(({_TOKENS.format(c='text')})[1:3], ' ') AS alias, item_id AS ord FROM benchmark),
hit AS (SELECT d.doc_id, al.topic, al.alias, al.ord FROM (SELECT doc_id, ' ' || {_NORM.format(c='text')} || ' ' AS n FROM documents) d JOIN al ON al.alias <> '' AND contains(d.n, ' ' || al.alias || ' '))"""


def lexical_topics(spark, d):
    return matching.lexical_topics(_t(spark, d, "documents"), "doc_id", {"text": 0.6}, _aliases(spark, d), 3)[0].select("doc_id", "topic", "score", "term")


def lexical_score(spark, d):
    out = matching.lexical_topics(_t(spark, d, "documents"), "doc_id", {"text": 0.6}, _aliases(spark, d), 3)[1]
    return out.select("doc_id", round_floor(F.col("score"), 3).alias("score"))


def word_ngram_counts(spark, d):
    b = _t(spark, d, "benchmark").select("item_id", F.explode(word_ngrams(tokens(normalize_words(F.col("text"))), 1, 2)).alias("gram"))
    return b.groupBy("gram").agg(F.count("*").alias("n"), F.count_distinct("item_id").alias("items"))


_GRAMS = f"""
w AS (SELECT item_id, {_TOKENS.format(c='text')} AS t FROM benchmark),
g AS (SELECT item_id, unnest(t) AS gram FROM w UNION ALL
  SELECT item_id, t[i] || ' ' || t[i + 1] FROM (SELECT item_id, t, unnest(range(1, len(t))) AS i FROM w))"""


def _idf(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    b = _t(spark, d, "benchmark")
    words = word_ngrams(tokens(normalize_words(F.col("text"))), 1, 2)
    counts = b.select("item_id", F.explode(words).alias("feature")).groupBy("item_id", "feature").agg(F.count("*").alias("tf"))
    return counts, matching.inverse_frequency(counts, "item_id")


def tfidf_idf(spark, d):
    return _idf(spark, d)[1].select("feature", round_floor(F.col("idf"), 4).alias("idf"))


_IDF = f"""{_GRAMS}, c AS (SELECT item_id, gram AS feature, count(*) AS tf FROM g GROUP BY 1, 2),
n AS (SELECT count(DISTINCT item_id) AS n FROM c),
idf AS (SELECT feature, ln((1 + n)::DOUBLE / (1 + count(*))::DOUBLE) + 1 AS idf FROM c, n GROUP BY feature, n)"""


def tf_vector(spark, d):
    counts, idf = _idf(spark, d)
    return matching.vectors(counts, "item_id", idf).select("item_id", "feature", round_floor(F.col("value"), 4).alias("value"))


def cosine_topics(spark, d):
    """Vectors against the sum of each label's vectors, in whole numbers, the nearest two labels of each."""
    e = _t(spark, d, "embeddings").select("vec_id", F.col("label").alias("topic"), F.posexplode("embedding").alias("feature", "x")).withColumn("value", F.round(F.col("x").cast("double") * 1000).cast("long"))
    centre = e.groupBy("topic", "feature").agg(F.sum("value").alias("value"))
    scores = matching.cosine(e.select("vec_id", "feature", "value"), "vec_id", centre).withColumnRenamed("topic", "label")
    best = scores.withColumn("rank", F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("similarity"), "label")))
    return best.filter("rank <= 2").select("vec_id", "label", F.col("similarity").alias("dot"), "rank")


COSINE = """
WITH e AS (SELECT vec_id, label, unnest(range(64)) AS feature, unnest(embedding) AS v FROM embeddings),
x AS (SELECT vec_id, label, feature, CAST(round(v::DOUBLE * 1000) AS BIGINT) AS x FROM e),
c AS (SELECT label, feature, CAST(sum(x) AS BIGINT) AS c FROM x GROUP BY 1, 2),
s AS (SELECT x.vec_id, c.label, CAST(sum(x.x * c.c) AS BIGINT) AS dot FROM x JOIN c USING (feature) GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY dot DESC, label) AS INTEGER) AS rank FROM s)
SELECT vec_id, label, dot, rank FROM r WHERE rank <= 2"""


def eval_micro_prf(spark, d):
    """Labels against two simple predictions, as label sets."""
    j = _t(spark, d, "labels").join(_t(spark, d, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    label = lambda q, t: F.array_compact(F.array(F.when(q, "quality"), F.when(t, "toxic")))
    cases = j.select(label(F.col("quality") == 1, F.col("toxic") == 1).alias("expected"), label(F.col("n_chars") > 500, F.col("n_chars") > 2000).alias("predicted"))
    return evaluation.micro_scores(cases)


EVAL = """
WITH c AS (SELECT quality = 1 AS eq, toxic = 1 AS et, n_chars > 500 AS pq, n_chars > 2000 AS pt FROM labels JOIN documents USING (doc_id)),
s AS (SELECT CAST(sum((eq AND pq)::INT + (et AND pt)::INT) AS BIGINT) AS tp, CAST(sum((NOT eq AND pq)::INT + (NOT et AND pt)::INT) AS BIGINT) AS fp, CAST(sum((eq AND NOT pq)::INT + (et AND NOT pt)::INT) AS BIGINT) AS fn,
  avg(CASE WHEN eq = pq AND et = pt THEN 1::DOUBLE ELSE 0::DOUBLE END) AS ex FROM c),
r AS (SELECT *, tp::DOUBLE / (tp + fp) AS p, tp::DOUBLE / (tp + fn) AS q FROM s)
SELECT tp, fp, fn, floor(p * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS precision, floor(q * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS recall,
  floor(2 * p * q / (p + q) * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS f1, floor(ex * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS exact_match FROM r"""


def _copies(spark: SparkSession, d: str) -> DataFrame:
    """left, right: each copy of a text with the first, so a large group gives as many edges as members."""
    t = _t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = t.groupBy("h").agg(F.min("doc_id").alias("left"), F.count("*").alias("n")).filter("n > 1")
    return t.join(first, "h").filter("doc_id <> left").select("left", F.col("doc_id").alias("right"))


_COPIES = "e AS (SELECT * FROM (SELECT min(doc_id) OVER (PARTITION BY text) AS l, doc_id AS r FROM documents) WHERE l <> r)"


def exact_dup_edges(spark, d):
    return _copies(spark, d)


def adjacency_lists(spark, d):
    return linking.adjacency(_copies(spark, d)).select("id", F.array_join(F.transform("related", lambda x: x.cast("string")), ",").alias("related"))


def connected_components(spark, d):
    """Copies of a text, and texts that begin alike: links to the first of each group, so a large group gives as many as it has members."""
    t = _t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("whole"), F.sha2(F.substring("text", 1, 12), 256).alias("start"))
    links = None
    for key in ("whole", "start"):
        first = t.groupBy(key).agg(F.min("doc_id").alias("left"), F.count("*").alias("n")).filter("n > 1")
        found = t.join(first, key).filter("doc_id <> left").select("left", F.col("doc_id").alias("right"))
        links = found if links is None else links.unionByName(found)
    return linking.components(links)


#: Texts that are equal begin alike, so these groups are the components.
COMPONENTS = "SELECT doc_id AS node, min(doc_id) OVER (PARTITION BY text[1:12]) AS component FROM documents QUALIFY count(*) OVER (PARTITION BY text[1:12]) > 1"


def entity_ids(spark, d):
    e = _copies(spark, d).select(F.format_string("doc:%06d", "left").alias("left"), F.format_string("doc:%06d", "right").alias("right"))
    return linking.entities(e).select("entity_id", F.size("members").cast("long").alias("members"))


ENTITY = f"""
WITH {_COPIES}, m AS (SELECT l, l AS n FROM e UNION SELECT l, r FROM e)
SELECT 'entity:' || sha256(string_agg(printf('doc:%06d', n), chr(10) ORDER BY n))[1:16] AS entity_id, count(*) AS members FROM m GROUP BY l"""


def shared_identifier_edges(spark, d):
    """Pages whose canonical URL is the same."""
    p = _t(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("u"))
    return linking.shared_key_pairs(p, "u", "page_id").select("a", "b").distinct()


_CANON = """
c0 AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\\.', '') AS host, regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+', '/', 'g') AS path,
  regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS q FROM pages),
c1 AS (SELECT page_id, host, CASE WHEN path IN ('', '/') THEN '/' ELSE rtrim(path, '/') END AS path,
  list_sort(list_filter(list_transform(list_filter(string_split(q, '&'), lambda p: p <> ''), lambda p: [url_decode(replace(split_part(p, '=', 1), '+', ' ')), url_decode(replace(CASE WHEN contains(p, '=') THEN p[instr(p, '=') + 1:] ELSE '' END, '+', ' '))]),
    lambda p: NOT starts_with(lower(p[1]), 'utm_') AND lower(p[1]) NOT IN ('ref', 'source'))) AS ps FROM c0),
canon AS (SELECT page_id, 'https://' || host || path || CASE WHEN len(ps) > 0 THEN '?' || array_to_string(list_transform(ps, lambda p: replace(url_encode(p[1]), '%20', '+') || '=' || replace(url_encode(p[2]), '%20', '+')), '&') ELSE '' END AS canonical FROM c1)"""


def canonical_url(spark, d):
    return _t(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


def extract_links(spark, d):
    """Urls in running text, with and without marks around them."""
    said = F.concat(F.lit("see "), F.col("url"), F.lit(", or ("), F.col("url"), F.lit(")! <"), F.col("url"), F.lit("/x>"))
    return _t(spark, d, "pages").select(F.explode(urls.extract_urls(said)).alias("link")).groupBy("link").agg(F.count("*").alias("n"))


def url_identifiers(spark, d):
    n = F.col("page_id").cast("string")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    return _t(spark, d, "pages").select(
        "page_id", urls.github_repository(text("https://www.GitHub.com/Org", n, "/Repo.git/tree/main?x=1")).alias("github"), urls.arxiv_identifier(text("see arXiv: 2401.", F.lpad(n, 5, "0"), "v2 and")).alias("arxiv"),
        urls.openreview_identifier(text("https://openreview.net/forum?id=Ab", n, "&x=1")).alias("openreview"), urls.doi_identifier(text("(doi:10.1234/AB.", n, ").")).alias("doi"), urls.host_of(F.col("url")).alias("host"),
    )


def archive_search(spark, d):
    docs = _t(spark, d, "documents").withColumn("topics", F.array("lang", "source")).withColumn("reportable", F.col("n_chars") >= 200)
    kept = docs.filter(archive.filters(topics=["en"], columns={"source": "source"}))
    head = F.substring_index("text", "\n", 1)
    return archive.search(kept, "the and", 20, head, F.col("source"), F.col("text"), "n_chars", "doc_id").select("doc_id", "score", "n_chars")


SEARCH = """
WITH f AS (SELECT doc_id, n_chars, lower(split_part(text, chr(10), 1)) AS h, lower(source) AS x, lower(text) AS t FROM documents WHERE lang = 'en' AND n_chars >= 200),
s AS (SELECT doc_id, n_chars, h, CASE WHEN contains(h, 'the') THEN 10 WHEN contains(x, 'the') THEN 5 WHEN contains(t, 'the') THEN 3 ELSE 0 END AS a, CASE WHEN contains(h, 'and') THEN 10 WHEN contains(x, 'and') THEN 5 WHEN contains(t, 'and') THEN 3 ELSE 0 END AS b FROM f)
SELECT doc_id, CAST(a + b + CASE WHEN contains(h, 'the and') THEN 30 ELSE 0 END AS INTEGER) AS score, n_chars FROM s WHERE a > 0 AND b > 0 ORDER BY score DESC, n_chars DESC, doc_id LIMIT 20"""


def fuzzy_title_edges(spark, d):
    """Similar page titles; the ratio of matching blocks has no SQL."""
    t = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    papers = _t(spark, d, "pages").select(F.format_string("page:%06d", "page_id").alias("id"), t.alias("title"), F.array(F.lit("A B"), urls.host_of(F.col("url"))).alias("authors"))
    return linking.fold_evidence(linking.title_edges(papers)).select("left", "right", round_floor(F.col("confidence"), 4).alias("confidence"))


ALL = {
    "norm_text": (norm_text, f"SELECT doc_id, sha256({_NORM.format(c='text')}) AS norm FROM documents"),
    "compact_summary": (compact_summary, SUMMARY),
    "lexical_topics": (lexical_topics, f"WITH {_ALIASES} SELECT doc_id, topic, 0.6::DOUBLE AS score, arg_min(alias, ord) AS term FROM hit GROUP BY 1, 2"),
    "lexical_score": (lexical_score, f"WITH {_ALIASES}, t AS (SELECT doc_id, count(DISTINCT topic) AS n FROM hit GROUP BY 1) SELECT doc_id, floor(least(0.6::DOUBLE + least(0.08::DOUBLE * (n * 0.6::DOUBLE - 0.6::DOUBLE), 0.2::DOUBLE), 1::DOUBLE) * 1000::DOUBLE + 0.5::DOUBLE) / 1000::DOUBLE AS score FROM t"),
    "word_ngrams": (word_ngram_counts, f"WITH {_GRAMS} SELECT gram, count(*) AS n, count(DISTINCT item_id) AS items FROM g GROUP BY 1"),
    "tfidf_idf": (tfidf_idf, f"WITH {_IDF} SELECT feature, floor(idf * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS idf FROM idf"),
    "tf_vector": (tf_vector, f"WITH {_IDF}, v AS (SELECT item_id, feature, (1 + ln(tf::DOUBLE)) * idf * 0.3::DOUBLE AS v FROM c JOIN idf USING (feature)), m AS (SELECT item_id, sqrt(sum(v * v)) AS m FROM v GROUP BY 1) SELECT item_id, feature, floor(v / m * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS value FROM v JOIN m USING (item_id)"),
    "cosine_topics": (cosine_topics, COSINE),
    "eval_micro_prf": (eval_micro_prf, EVAL),
    "exact_dup_edges": (exact_dup_edges, f"WITH {_COPIES} SELECT l AS left, r AS right FROM e"),
    "adjacency_lists": (adjacency_lists, f"WITH {_COPIES}, b AS (SELECT l AS id, r AS o FROM e UNION ALL SELECT r, l FROM e) SELECT id, string_agg(CAST(o AS VARCHAR), ',' ORDER BY o) AS related FROM b GROUP BY id"),
    "connected_components": (connected_components, COMPONENTS),
    "entity_ids": (entity_ids, ENTITY),
    "shared_identifier_edges": (shared_identifier_edges, f"WITH {_CANON} SELECT a.page_id AS a, b.page_id AS b FROM canon a JOIN canon b ON a.canonical = b.canonical AND a.page_id < b.page_id"),
    "canonical_url": (canonical_url, f"WITH {_CANON} SELECT page_id, canonical FROM canon"),
    "extract_links": (extract_links, "SELECT link, count(*) AS n FROM (SELECT unnest([rtrim(url, '.,;:!?)]'), rtrim(url, '.,;:!?)]'), rtrim(url || '/x', '.,;:!?)]')]) AS link FROM pages) GROUP BY 1"),
    "url_identifiers": (url_identifiers, """SELECT page_id, 'github:org' || page_id || '/repo' AS github, 'arxiv:2401.' || lpad(CAST(page_id AS VARCHAR), 5, '0') AS arxiv, 'openreview:Ab' || page_id AS openreview, 'doi:10.1234/ab.' || page_id AS doi,
  regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]+)', 1)), '^www\\.', '') AS host FROM pages"""),
    "archive_search": (archive_search, SEARCH),
    "fuzzy_title_edges": (fuzzy_title_edges, None),
}
