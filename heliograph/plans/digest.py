"""Registered queries over orders, customers, parts and line items: scores, gates, sections, inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliograph.functions.numbers import round_floor
from heliograph.functions.times import instant
from heliograph.operators import archive, ingest, linking, ranking

_END = "1998-08-02 00:00:00"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: What stands for a source, a kind, a venue and an action in the tables at hand.
SOURCE = {"AUTOMOBILE": "github", "BUILDING": "arxiv", "FURNITURE": "openreview", "MACHINERY": "cvf", "HOUSEHOLD": "huggingface"}
KIND = {"1": "release", "2": "repository", "3": "paper", "4": "article"}
VENUE = {"1": "core", "2": "secondary"}


def _named(column, names: dict[str, str], otherwise: str | None = None):
    out = F.lit(otherwise).cast("string")
    for k, v in names.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Orders as items: the segment stands for the source, the priority for the kind, the status for the action."""
    o = _t(spark, d, "orders").join(_t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    first = F.substring("o_orderpriority", 1, 1)
    action = F.when(F.col("o_orderstatus") == "P", "status_changed").when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 150000), "created").when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000), "released")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice", "c_mktsegment", _named(F.col("c_mktsegment"), SOURCE).alias("source"), _named(first, KIND, "event").alias("kind"), _named(first, VENUE).alias("venue"),
        action.alias("action"), F.when(F.col("o_totalprice") > 100000, "accepted").otherwise("rejected").alias("status"), (F.col("c_mktsegment") == "BUILDING").alias("discovered"), (F.col("o_totalprice") > 400000).alias("watched"),
    )


def _signals(spark: SparkSession, d: str) -> DataFrame:
    end = F.lit(_END).cast("timestamp")
    price = F.col("o_totalprice")
    topics = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<string>")).otherwise(F.array("source"))
    return _items(spark, d).select(
        "*", round_floor(ranking.priority(price / 500000.0, F.col("source"), F.col("venue")), 4).alias("priority"), round_floor(ranking.relevance(F.when(price > 50000, price / 600000.0), topics), 4).alias("relevance"),
        ranking.freshness(instant(F.col("o_orderdate")), end, 24.0 * 90, round_floor).alias("freshness"), ranking.novelty(F.col("kind"), F.col("action")).alias("novelty"),
        round_floor(ranking.popularity(F.floor(price / 5000) - 10), 4).alias("popularity"),
    )


def _scored(spark: SparkSession, d: str) -> DataFrame:
    s = _signals(spark, d)
    return s.withColumn("total", ranking.total({k: F.col(k) for k in ranking.Ranking().weights}, round_to=round_floor))


_HOW = ranking.Ranking()
_CASE = lambda c, v, e: f"CASE {c} " + " ".join(f"WHEN '{k}' THEN {repr(x) if isinstance(x, str) else f'{x}::DOUBLE'}" for k, x in v.items()) + f" ELSE {e} END"
_R4 = lambda x: f"floor(({x}) * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE"
_ITEMS = f"""
i AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice, c_mktsegment, {_CASE('c_mktsegment', SOURCE, 'NULL')} AS source, {_CASE('o_orderpriority[1:1]', KIND, "'event'")} AS kind, {_CASE('o_orderpriority[1:1]', VENUE, 'NULL')} AS venue,
  CASE WHEN o_orderstatus = 'P' THEN 'status_changed' WHEN o_orderstatus = 'O' AND o_totalprice < 150000 THEN 'created' WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN 'released' END AS action,
  o_totalprice > 100000 AS accepted, c_mktsegment = 'BUILDING' AS discovered, o_totalprice > 400000 AS watched FROM orders JOIN customer ON o_custkey = c_custkey)"""
_SQL = f"""{_ITEMS},
s AS (SELECT *, {_R4(f"least(greatest(o_totalprice / 500000::DOUBLE, {_CASE('source', _HOW.source_priority, '0::DOUBLE')}, {_CASE('venue', _HOW.venue_priority, '0::DOUBLE')}, 0::DOUBLE), 1::DOUBLE)")} AS priority,
  {_R4("least(CASE WHEN o_totalprice > 50000 THEN o_totalprice / 600000::DOUBLE WHEN o_orderstatus = 'F' THEN 0::DOUBLE ELSE 0.55::DOUBLE END, 1::DOUBLE)")} AS relevance,
  {_R4(f"pow(0.5::DOUBLE, greatest((epoch_us(TIMESTAMP '{_END}') - epoch_us(o_orderdate)) / 3.6e9::DOUBLE, 0::DOUBLE) / 2160::DOUBLE)")} AS freshness,
  coalesce({_CASE('action', _HOW.action_novelty, 'NULL')}, {_CASE('kind', _HOW.novelty, '0::DOUBLE')}) AS novelty,
  {_R4("CASE WHEN o_totalprice // 5000 > 10 THEN least(ln(1 + (floor(o_totalprice / 5000) - 10)) / ln(101::DOUBLE), 1::DOUBLE) ELSE 0::DOUBLE END")} AS popularity FROM i)"""


def _compensated(terms: list[str]) -> str:
    """CTEs that add terms up as doubles and carry what each addition loses."""
    out = ["t0 AS (SELECT *, 0::DOUBLE AS _s, 0::DOUBLE AS _k FROM s)"]
    for n, x in enumerate(terms, 1):
        out.append(f"t{n} AS (SELECT * EXCLUDE (_s, _k), _s + ({x}) AS _s, _k + CASE WHEN abs(_s) >= abs({x}) THEN (_s - (_s + ({x}))) + ({x}) ELSE (({x}) - (_s + ({x}))) + _s END AS _k FROM t{n - 1})")
    return ",\n".join(out)


_SCORED = f"""{_SQL},
{_compensated([f'{k} * {w}::DOUBLE' for k, w in _HOW.weights.items()])},
t AS (SELECT *, {_R4(f"(_s + _k) / {sum(_HOW.weights.values())!r}::DOUBLE")} AS total FROM t{len(_HOW.weights)})"""
_LABEL = """CASE WHEN action = 'status_changed' AND accepted THEN 'ACCEPTED' WHEN kind = 'release' OR action = 'released' THEN 'RELEASED' WHEN kind = 'repository' AND discovered THEN 'DISCOVERED'
  WHEN action = 'created' OR (action IS NULL AND kind IN ('paper', 'article', 'project')) THEN 'NEW' ELSE 'UPDATED' END"""


def freshness_score(spark, d):
    return _signals(spark, d).select("o_orderkey", "freshness")


def priority_signal(spark, d):
    return _signals(spark, d).select("o_orderkey", "priority")


def relevance_signal(spark, d):
    return _signals(spark, d).select("o_orderkey", "relevance")


def novelty_signal(spark, d):
    return _signals(spark, d).groupBy("kind", "action").agg(F.max("novelty").alias("novelty"), F.count("*").alias("n"))


def research_signal(spark, d):
    value = F.when(F.col("o_totalprice") > 80000, F.col("o_totalprice") / 300000.0)
    return _items(spark, d).select("o_orderkey", round_floor(ranking.research(value, F.col("discovered") & (F.col("kind") == "repository")), 4).alias("research"))


def weighted_total(spark, d):
    return _scored(spark, d).select("o_orderkey", "total")


def _label():
    return ranking.change_label(F.col("kind"), F.col("action"), F.col("status"), F.col("discovered"))


def change_label(spark, d):
    return _items(spark, d).groupBy(_label().alias("label")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order"))


def section_routing(spark, d):
    section = ranking.section_of(F.col("watched"), _label(), F.col("kind"))
    return _items(spark, d).groupBy(section.alias("section")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order"))


def popularity_signal(spark, d):
    n = _t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return n.select("l_partkey", round_floor(ranking.popularity(F.col("n")), 4).alias("popularity"))


def digest_gate(spark, d):
    reportable = F.col("kind") != "article"
    ok = ranking.included(reportable, F.col("watched"), F.col("discovered"), F.col("novelty"), F.col("total"))
    return _scored(spark, d).groupBy("c_mktsegment", ok.alias("included")).agg(F.count("*").alias("n"))


def digest_sections_topn(spark, d):
    s = _scored(spark, d).withColumnRenamed("o_orderkey", "id")
    out = ranking.sections(s, "c_mktsegment", {"BUILDING": 5, "FURNITURE": 8}, ranking.digest_order(), 10)
    return out.select("id", "c_mktsegment", "total", "rank", "hidden")


def best_per_entity(spark, d):
    s = _scored(spark, d).withColumnRenamed("o_orderkey", "id")
    s = s.withColumn("entity", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("o_custkey")))
    return ranking.best_per_entity(s, "entity", F.col("o_orderstatus") == "F", ranking.digest_order()).select("id", "entity", "total")


def latest_version_dedupe(spark, d):
    return ingest.latest_version(_t(spark, d, "orders"), ["o_custkey"], "o_orderdate", [F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


def inventory_diff(spark, d):
    now = _t(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return ingest.inventory_changes(_t(spark, d, "part").filter("p_size >= 20").select("p_partkey"), now, "p_partkey")


def inventory_guard(spark, d):
    p = _t(spark, d, "part")
    return ingest.guarded_inventory(p.filter("p_size < 25"), p, "p_partkey", 10)


def candidate_accumulation(spark, d):
    li = _t(spark, d, "lineitem").withColumn("late", F.col("l_returnflag") == "R").withColumn("o", F.struct("l_shipdate", "l_orderkey", "l_linenumber"))
    out = ingest.merged_hits(li, "l_partkey", ["l_returnflag", "l_linestatus"], ["late"], {"newest_order": "l_orderkey"}, "o")
    return out.select("l_partkey", F.array_join("l_returnflag_set", ",").alias("flags"), F.array_join("l_linestatus_set", ",").alias("statuses"), "late", "newest_order")


def topic_subset_filter(spark, d):
    o = _t(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("topics"))
    return o.filter(archive.filters(topics=["1-URGENT", "5-LOW"], include_hidden=True)).select("o_custkey", F.size("topics").cast("long").alias("n_topics"))


def name_containment_join(spark, d):
    """Names whose words all are in a part's name."""
    names = [("repo:a", "Small-Ring"), ("repo:b", "widget"), ("repo:c", "bolt_blue"), ("repo:d", "red")]
    repositories = spark.createDataFrame([(i, n, ["x"]) for i, n in names], "id string, name string, topics array<string>")
    papers = _t(spark, d, "part").select(F.concat(F.lit("part:"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("title"), F.array("p_brand").alias("topics"))
    linked = spark.createDataFrame([], "left string, right string")
    out = linking.repository_edges(repositories, papers, linked, linking.Linking(require_topics=False))
    return out.filter("kind = 'repository_name'").select("left", "right", "value")


def running_hidden(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", F.row_number().over(w).alias("nth"), (F.count("*").over(Window.partitionBy("o_custkey"))).alias("of"))


ALL = {
    "freshness_score": (freshness_score, f"WITH {_SQL} SELECT o_orderkey, freshness FROM s"),
    "priority_signal": (priority_signal, f"WITH {_SQL} SELECT o_orderkey, priority FROM s"),
    "novelty_signal": (novelty_signal, f"WITH {_SQL} SELECT kind, action, max(novelty) AS novelty, count(*) AS n FROM s GROUP BY 1, 2"),
    "weighted_total": (weighted_total, f"WITH {_SCORED} SELECT o_orderkey, total FROM t"),
    "relevance_signal": (relevance_signal, f"WITH {_SQL} SELECT o_orderkey, relevance FROM s"),
    "research_signal": (research_signal, f"""WITH {_ITEMS} SELECT o_orderkey, {_R4("CASE WHEN discovered AND kind = 'repository' THEN least(CASE WHEN o_totalprice > 80000 THEN o_totalprice / 300000::DOUBLE ELSE 0::DOUBLE END, 1::DOUBLE) ELSE 1::DOUBLE END")} AS research FROM i"""),
    "section_routing": (section_routing, f"""WITH {_ITEMS} SELECT CASE WHEN watched THEN 'priority_watch' WHEN {_LABEL} = 'ACCEPTED' THEN 'accepted_papers' WHEN kind = 'paper' THEN 'new_papers' WHEN kind = 'repository' THEN 'new_repositories'
  WHEN kind = 'article' THEN 'research_announcements' ELSE 'project_updates' END AS section, count(*) AS n, min(o_orderkey) AS first_order FROM i GROUP BY 1"""),
    "change_label": (change_label, f"WITH {_ITEMS} SELECT {_LABEL} AS label, count(*) AS n, min(o_orderkey) AS first_order FROM i GROUP BY 1"),
    "popularity_signal": (popularity_signal, "SELECT l_partkey, floor(least(ln(1 + count(*)::DOUBLE) / ln(101::DOUBLE), 1::DOUBLE) * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS popularity FROM lineitem GROUP BY 1"),
    "digest_gate": (digest_gate, f"""WITH {_SCORED}
SELECT c_mktsegment, CASE WHEN kind = 'article' THEN FALSE WHEN watched THEN TRUE WHEN discovered AND novelty < 0.4::DOUBLE THEN FALSE ELSE total >= 0.35::DOUBLE END AS included, count(*) AS n FROM t GROUP BY 1, 2"""),
    "digest_sections_topn": (digest_sections_topn, f"""WITH {_SCORED},
r AS (SELECT o_orderkey AS id, c_mktsegment, total, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY total DESC, freshness DESC, o_orderkey) AS INTEGER) AS rank, count(*) OVER (PARTITION BY c_mktsegment) AS n,
  CASE c_mktsegment WHEN 'BUILDING' THEN 5 WHEN 'FURNITURE' THEN 8 ELSE 10 END AS lim FROM t)
SELECT id, c_mktsegment, total, rank, CAST(greatest(n - lim, 0) AS BIGINT) AS hidden FROM r WHERE rank <= lim"""),
    "best_per_entity": (best_per_entity, f"""WITH {_SCORED}, e AS (SELECT o_orderkey AS id, CASE WHEN c_mktsegment <> 'MACHINERY' THEN o_custkey END AS entity, o_orderstatus, freshness, total FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY entity, o_orderstatus = 'F' ORDER BY total DESC, freshness DESC, id) AS k FROM e)
SELECT id, entity, total FROM r WHERE entity IS NULL OR o_orderstatus <> 'F' OR k = 1"""),
    "latest_version_dedupe": (latest_version_dedupe, "SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS k FROM orders) WHERE k = 1"),
    "inventory_diff": (inventory_diff, """WITH a AS (SELECT p_partkey FROM part WHERE p_size >= 20), b AS (SELECT DISTINCT l_partkey AS p_partkey FROM lineitem WHERE l_quantity > 45)
SELECT p_partkey, 'added' AS change FROM b WHERE p_partkey NOT IN (SELECT p_partkey FROM a) UNION ALL SELECT p_partkey, 'lost' FROM a WHERE p_partkey NOT IN (SELECT p_partkey FROM b)"""),
    "inventory_guard": (inventory_guard, "SELECT p_partkey FROM part WHERE p_size >= 25"),
    "candidate_accumulation": (candidate_accumulation, """SELECT l_partkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS flags, array_to_string(list_sort(list_distinct(list(l_linestatus))), ',') AS statuses,
  bool_or(l_returnflag = 'R') AS late, (list(l_orderkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC))[1] AS newest_order FROM lineitem GROUP BY 1"""),
    "topic_subset_filter": (topic_subset_filter, "SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_topics FROM orders GROUP BY 1 HAVING bool_or(o_orderpriority = '1-URGENT') AND bool_or(o_orderpriority = '5-LOW')"),
    "name_containment_join": (name_containment_join, """WITH n(id, name) AS (VALUES ('repo:a', 'small ring'), ('repo:b', 'widget'), ('repo:c', 'bolt blue'))
SELECT 'part:' || p_partkey AS "left", id AS "right", name AS value FROM part, n WHERE list_has_all(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' '), string_split(name, ' '))"""),
    "version_numbers": (running_hidden, "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS nth, count(*) OVER (PARTITION BY o_custkey) AS of FROM orders"),
}
