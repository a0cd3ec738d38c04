"""Linking records of the same work, and the entities that links make.

Edges are (left, right, kind, value, score) with left < right; evidence is folded at the end.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions.udfs import normalize_names, sequence_ratio
from heliograph.operators.identifiers import exact_identifiers
from heliograph.shipping import ship
from heliograph.storage import written

#: Names too common to identify a repository.
GENERIC_NAMES = ("code", "demo", "depth", "model", "nerf", "paper", "project", "reconstruction", "repo", "slam", "vision")


@dataclass(frozen=True)
class Linking:
    title_characters: int = 12
    author_overlap: float = 0.5
    similarity: float = 0.94
    shared_tokens: int = 2
    token_length: int = 3
    block_size: int = 200
    name_characters: int = 4
    require_topics: bool = True


def author_keys(names: Column) -> Column:
    """Distinct last:initial of normalised names; a name of one word is itself."""
    def one(n: Column) -> Column:
        t = F.split(n, " ")
        return F.when(n == "", None).when(F.size(t) == 1, n).otherwise(F.concat(F.element_at(t, -1), F.lit(":"), F.substring(n, 1, 1)))

    return F.array_distinct(F.array_compact(F.transform(names, one)))


def overlap(a: Column, b: Column) -> Column:
    """Shared over the smaller number; 0 if either has none."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(0.0)


def _edge(a: Column, b: Column, kind: str, value: Column, score: Column | float) -> list[Column]:
    return [F.least(a, b).alias("left"), F.greatest(a, b).alias("right"), F.lit(kind).alias("kind"), value.cast("string").alias("value"), (score if isinstance(score, Column) else F.lit(score)).alias("score")]


def explicit_edges(items: DataFrame) -> DataFrame:
    """From declared relations whose target exists and is another item."""
    r = items.select(F.col("id").alias("a"), F.explode("related_items").alias("b")).filter("a <> b")
    r = r.join(items.select(F.col("id").alias("b")), "b", "left_semi")
    return r.select(*_edge(F.col("a"), F.col("b"), "explicit_relation", F.lit("source-declared"), 1.0)).distinct()


def shared_key_pairs(keyed: DataFrame, key: str, node: str) -> DataFrame:
    """a < b for each two nodes with a key in common; for keys that few nodes share."""
    a, b = keyed.select(key, F.col(node).alias("a")).distinct(), keyed.select(key, F.col(node).alias("b")).distinct()
    return a.join(b, key).filter("a < b")


def identifier_edges(identifiers: DataFrame) -> DataFrame:
    """``identifiers``: id, identifier, origin.  Every two items that share one are linked with certainty."""
    a = identifiers.groupBy("identifier", F.col("id").alias("a")).agg(F.collect_set("origin").alias("oa"))
    b = a.select("identifier", F.col("a").alias("b"), F.col("oa").alias("ob"))
    both = a.join(b, "identifier").filter("a < b")
    value = F.concat(F.col("identifier"), F.lit(" ("), F.array_join(F.array_sort(F.array_union("oa", "ob")), ","), F.lit(")"))
    return both.select(*_edge(F.col("a"), F.col("b"), "exact_identifier", value, 1.0))


def title_edges(papers: DataFrame, how: Linking = Linking()) -> DataFrame:
    """Same titles, then similar ones.  ``papers``: id, title, authors.

    Pairs with the same title aren't tried again when their authors differ.  Similar
    titles share tokens of at least three characters that at most ``block_size`` titles
    have; ``token_pairs`` finds them without all pairs of a token.
    """
    ship(papers.sparkSession, "heliograph")
    p = _papers(papers)
    long = p.filter(F.length("t") >= how.title_characters)
    a, b = (long.select("t", F.col("id").alias(x), F.col("k").alias(f"k{x}")) for x in "ab")
    same = a.join(b, "t").filter("a < b").withColumn("o", overlap(F.col("ka"), F.col("kb")))
    good = same.filter(F.col("o") >= how.author_overlap)
    exact = good.select(*_edge(F.col("a"), F.col("b"), "exact_title", F.col("t"), 0.98)).unionByName(good.select(*_edge(F.col("a"), F.col("b"), "author_overlap", F.call_function("format_number", F.col("o"), F.lit("0.000")), F.col("o"))))

    pairs = token_pairs(long.select("id", F.length("t").alias("n"), F.array_distinct(F.split("t", " ")).alias("ws")), how)
    pairs = pairs.join(same.select("a", "b"), ["a", "b"], "left_anti")
    near = pairs.join(p.select(F.col("id").alias("a"), F.col("t").alias("ta"), F.col("k").alias("ka")), "a").join(p.select(F.col("id").alias("b"), F.col("t").alias("tb"), F.col("k").alias("kb")), "b")
    near = near.withColumn("o", overlap(F.col("ka"), F.col("kb"))).filter(F.col("o") >= how.author_overlap)
    # twice the shorter length over both bounds the ratio, so few pairs reach Python
    near = near.filter(2.0 * F.least(F.length("ta"), F.length("tb")) >= how.similarity * (F.length("ta") + F.length("tb")))
    near = near.withColumn("r", sequence_ratio(F.col("ta"), F.col("tb"))).filter(F.col("r") >= how.similarity)
    fuzzy = near.select(*_edge(F.col("a"), F.col("b"), "fuzzy_title", F.call_function("format_number", F.col("r"), F.lit("0.000")), F.col("r"))).unionByName(near.select(*_edge(F.col("a"), F.col("b"), "author_overlap", F.call_function("format_number", F.col("o"), F.lit("0.000")), F.col("o"))))
    return exact.unionByName(fuzzy)


def token_pairs(titles: DataFrame, how: Linking = Linking()) -> DataFrame:
    """a < b: titles (id, n characters, ws distinct words) that share ``how.shared_tokens`` words that few titles have, and whose lengths allow the similarity.

    A set-similarity join.  A title's words are sorted from rare to common; two titles that
    share so many must meet in a word before their last ones, so only that prefix is
    indexed.  A pair's lengths differ by a bounded factor, so a word's titles are dealt
    out by bands of length and meet in two of them.  A pair is made at its first common
    word alone, and only where enough words follow on either side: no pair comes twice.
    """
    least, t = how.similarity / (2 - how.similarity), how.shared_tokens  # the shorter over the longer
    word = titles.select("id", F.explode("ws").alias("w")).filter(F.length("w") >= how.token_length)
    few = word.groupBy("w").agg(F.count("*").alias("df")).filter(F.col("df") <= how.block_size)
    sets = word.join(few, "w").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "w"))), lambda x: x["w"]).alias("ws")).filter(F.size("ws") >= t)
    sets = titles.select("id", "n").join(sets, "id").withColumn("prefix", F.slice("ws", F.lit(1), F.size("ws") - (t - 1)))
    keyed = sets.select("*", F.posexplode("prefix").alias("at", "w"), F.floor(F.log(F.col("n").cast("double")) / (math.log(1 / least) * (1 + 1e-9))).alias("band"))
    side = lambda x: [F.col(c).alias(f"{c}{x}") for c in ("id", "n", "ws", "prefix", "at")]
    short = keyed.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1))).select("w", "band", *side("1"))
    meet = short.join(keyed.select("w", "band", *side("2")), ["w", "band"]).filter("n1 < n2 or (n1 = n2 and id1 < id2)").filter(2.0 * F.col("n1") >= how.similarity * (F.col("n1") + F.col("n2")))
    meet = meet.filter(F.least(F.size("ws1") - F.col("at1"), F.size("ws2") - F.col("at2")) >= t).filter(F.get(F.array_intersect("prefix1", "prefix2"), F.lit(0)) == F.col("w"))
    return meet.filter(F.size(F.array_intersect("ws1", "ws2")) >= t).select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b"))


def _papers(papers: DataFrame) -> DataFrame:
    """id, t, k: normalised titles and author keys; authors are normalised once a name."""
    names = papers.select("id", F.explode("authors").alias("name")).withColumn("n", normalize_names(F.col("name")))
    keys = names.groupBy("id").agg(author_keys(F.collect_set("n")).alias("k"))
    return papers.select("id", normalize_names(F.col("title")).alias("t")).join(keys, "id", "left").withColumn("k", F.coalesce("k", F.array().cast("array<string>")))


def contained_sets(small: DataFrame, large: DataFrame) -> DataFrame:
    """a, b: small sets (a, wa) all of whose words are in a large one (b, wb); sets have no repeats, and an empty one is in none.

    Each small set is indexed by the rarest of its words among the large ones alone, so
    a word that all sets have is a key only where a set has no rarer one; what meets there
    is verified as a whole.
    """
    has = large.select("b", F.explode("wb").alias("w"))
    asked = small.select("a", F.explode("wa").alias("w"))
    df = has.join(asked.select("w").distinct(), "w", "left_semi").groupBy("w").agg(F.count("*").alias("df"))
    rarest = asked.join(df, "w", "left").groupBy("a").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "w")).alias("r")).filter("r.df > 0")
    meet = rarest.select("a", F.col("r.w").alias("w")).join(has, "w").select("a", "b")
    return meet.join(small, "a").join(large, "b").filter(F.size(F.array_except("wa", "wb")) == 0).select("a", "b")


def repository_edges(repositories: DataFrame, papers: DataFrame, linked: DataFrame, how: Linking = Linking()) -> DataFrame:
    """Repositories whose name's tokens all are in a paper's title, with a topic in common, unless already linked.

    ``repositories``: id, name, topics; ``papers``: id, title, topics.
    """
    ship(papers.sparkSession, "heliograph")
    r = repositories.select(F.col("id").alias("a"), normalize_names(F.col("name")).alias("n"), F.col("topics").alias("ta"))
    r = r.withColumn("flat", F.replace("n", F.lit(" "), F.lit(""))).filter((F.length("flat") >= how.name_characters) & ~F.col("flat").isin(*GENERIC_NAMES))
    need = r.select("a", "n", "ta", F.array_distinct(F.split("n", " ")).alias("wa"))
    p = papers.select(F.col("id").alias("b"), F.array_distinct(F.split(normalize_names(F.col("title")), " ")).alias("wb"), F.col("topics").alias("tb"))
    hits = contained_sets(need.select("a", "wa"), p.select("b", "wb"))
    pairs = hits.join(need.select("a", "n", "ta"), "a").join(p.select("b", "tb"), "b").withColumn("shared", F.array_sort(F.array_intersect("ta", "tb")))
    if how.require_topics:
        pairs = pairs.filter(F.size("shared") > 0)
    pairs = pairs.withColumn("left", F.least("a", "b")).withColumn("right", F.greatest("a", "b")).join(linked.select("left", "right").distinct(), ["left", "right"], "left_anti")
    name = pairs.select(*_edge(F.col("a"), F.col("b"), "repository_name", F.col("n"), 0.84))
    topic = pairs.filter(F.size("shared") > 0).select(*_edge(F.col("a"), F.col("b"), "topic_overlap", F.array_join("shared", ","), 0.8))
    return name.unionByName(topic)


def fold_evidence(edges: DataFrame) -> DataFrame:
    """left, right, confidence, evidence: distinct evidence in order, and its best score."""
    return edges.groupBy("left", "right").agg(F.max("score").alias("confidence"), F.array_sort(F.collect_set(F.struct("kind", "value", "score"))).alias("evidence"))


def adjacency(edges: DataFrame) -> DataFrame:
    """id, related: sorted neighbours."""
    both = edges.select(F.col("left").alias("id"), F.col("right").alias("other")).unionByName(edges.select(F.col("right").alias("id"), F.col("left").alias("other")))
    return both.groupBy("id").agg(F.sort_array(F.collect_set("other")).alias("related"))


#: Links whose components a task finds at once.
CHUNK_LINKS = 200_000


def _chunk_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, hub: of each ``CHUNK_LINKS`` links (a, b) in turn, every node with the smallest that they link it to, itself included."""

    def stars_of(links: pa.Table) -> pa.RecordBatch:
        n = links.num_rows
        coded = pa.chunked_array([*links.column("a").chunks, *links.column("b").chunks]).combine_chunks().dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        ends, low = place[coded.indices.to_numpy()], np.arange(len(order))
        a, b = ends[:n], ends[n:]
        while True:  # a link ties the larger of its ends' smallest nodes to the smaller, and paths are halved until all are short
            la, lb = low[a], low[b]
            if (la == lb).all():
                break
            np.minimum.at(low, np.maximum(la, lb), np.minimum(la, lb))
            while (low[low] != low).any():
                low = low[low]
        nodes = coded.dictionary.take(pa.array(order))
        return pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(low))], names=["node", "hub"])

    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held >= CHUNK_LINKS:
            yield stars_of(pa.Table.from_batches(waiting))
            waiting, held = [], 0
    if held:
        yield stars_of(pa.Table.from_batches(waiting))


def components(edges: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """node, component (its smallest node), for nodes with links.

    Tasks first make stars of the links that lie together, a bounded number at a time.
    Nodes that several stars have link these stars' hubs; only hubs go through rounds
    over all links.  Where the links of a component come together, there are no rounds.
    """
    ship(edges.sparkSession, "heliograph")
    links = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b")
    kind = dict(links.dtypes)["a"]
    found = written(links.mapInArrow(_chunk_stars, f"node {kind}, hub {kind}"))
    low = written(found.groupBy("node").agg(F.min("hub").alias("low"), F.max("hub").alias("high")))
    several = low.filter("low <> high").select("node", "low")
    if several.isEmpty():
        return low.select("node", F.col("low").alias("component"))
    between = found.join(several, "node").select(F.col("low").alias("a"), F.col("hub").alias("b"))
    hubs = hub_components(between).select(F.col("node").alias("low"), F.col("component").alias("__c"))
    return low.join(hubs, "low", "left").select("node", F.coalesce("__c", "low").alias("component"))


def hub_components(links: DataFrame) -> DataFrame:
    """node, component of links a, b, in rounds.

    Each round every node takes the smallest label among its neighbours' and then its
    label's label, so chains shorten by halves; rounds go on until none changes.  A
    round is written to the shared folder: lineage stays short and a lost executor costs
    no earlier round.
    """
    pairs = links.filter("a <> b").distinct()
    pairs = written(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = written(pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        around = pairs.join(labels, pairs["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        new = labels.join(around, labels["node"] == around["a"]).select("node", F.least("label", "m").alias("label"))
        jump = new.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(new.join(jump, "label", "left").select("node", F.least("label", F.coalesce("further", "label")).alias("label")))
        moved = new.join(labels.withColumnRenamed("label", "before"), "node").filter("label <> before").limit(1).count()
        labels = new
        if not moved:
            return labels.select("node", F.col("label").alias("component"))


def _hash_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """component, digest: a hash of each component's members, which come in order; a batch of members is in memory at a time."""
    last, digest, kind = None, None, None
    for batch in batches:
        component, nodes, kind = batch.column("component"), batch.column("node").cast(pa.string()).to_pylist(), batch.schema.field("component").type
        ends = [*(np.flatnonzero(pc.not_equal(component[1:], component[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), len(nodes)] if nodes else []
        out: list[tuple[object, str]] = []
        for start, end in zip([0, *ends], ends):
            c = component[start].as_py()
            if digest is None or c != last:
                if digest is not None:
                    out.append((last, digest.hexdigest()))
                last, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update("\n".join(nodes[start:end]).encode())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], kind), pa.array([x for _, x in out], pa.string())], names=["component", "digest"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], kind), pa.array([digest.hexdigest()])], names=["component", "digest"])


def entity_members(edges: DataFrame) -> DataFrame:
    """entity_id, node: a row for each member of components of two or more, named by a hash of the sorted members.

    A component's members pass through one task in order, sorted by Spark, which spills;
    they are never gathered, so its size has no bound.
    """
    ship(edges.sparkSession, "heliograph")
    members = written(components(edges))
    kind = dict(members.dtypes)["component"]
    dealt = members.select("component", "node").repartition("component").sortWithinPartitions("component", "node")
    names = dealt.mapInArrow(_hash_members, f"component {kind}, digest string")
    return members.join(names, "component").select(F.concat(F.lit("entity:"), F.substring("digest", 1, 16)).alias("entity_id"), "node")


def entities(edges: DataFrame) -> DataFrame:
    """entity_id, members: ``entity_members`` with the sorted members of each entity in one row; for entities of few members."""
    return entity_members(edges).groupBy("entity_id").agg(F.array_sort(F.collect_list("node")).alias("members"))


def stars(keyed: DataFrame, key: str, node: str) -> tuple[DataFrame, DataFrame]:
    """Classes and links of nodes that share a key, without a pair for each two: (key, hub, nodes) and (left, right), each member to its class's smallest.

    A key that a third of all nodes have is as many links as it has nodes; what the links
    connect is what all pairs connect.  ``star_pairs`` makes a class's pairs on request.
    """
    members = keyed.select(F.col(key).alias("key"), F.col(node).alias("node")).filter("key is not null and node is not null").distinct()
    classes = members.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("nodes")).filter("nodes > 1")
    links = members.join(classes, "key").filter("node <> hub").select(F.col("hub").alias("left"), F.col("node").alias("right")).distinct()
    return classes, links


def star_pairs(keyed: DataFrame, key: str, node: str, most: int) -> DataFrame:
    """key, a, b: all pairs of the classes of at most ``most`` nodes; larger ones stay links to a hub, which ``stars`` has."""
    members = keyed.select(F.col(key).alias("key"), F.col(node).alias("node")).filter("key is not null and node is not null").distinct()
    small = members.join(members.groupBy("key").agg(F.count("*").alias("nodes")).filter(F.col("nodes").between(2, most)).select("key"), "key")
    return small.select("key", F.col("node").alias("a")).join(small.select("key", F.col("node").alias("b")), "key").filter("a < b")


def link(items: DataFrame, identifiers: DataFrame, how: Linking = Linking()) -> tuple[DataFrame, DataFrame]:
    """Edges with evidence, and entities.  Order matters: names link only what nothing else has.

    Edges have every pair that shares an identifier, as evidence is by pair; entities come
    from star links, so they don't read those pairs.
    """
    papers = items.filter("kind = 'paper'")
    other = written(explicit_edges(items).unionByName(title_edges(papers.select("id", "title", "authors"), how)))
    found = other.unionByName(identifier_edges(identifiers))
    repositories = items.filter("kind = 'repository'").select("id", F.element_at(F.split("title", "/"), -1).alias("name"), "topics")
    named = written(repository_edges(repositories, papers.select("id", "title", "topics"), found, how))
    _, shared = stars(identifiers, "identifier", "id")
    return fold_evidence(found.unionByName(named)), entities(other.unionByName(named).select("left", "right").unionByName(shared))


def with_related(items: DataFrame, edges: DataFrame) -> DataFrame:
    """Items whose related_items also have what edges (left, right) link them with, in order."""
    near = adjacency(edges).select(F.col("id"), F.col("related").alias("__near"))
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_union(F.coalesce("related_items", none), F.coalesce("__near", none)))
    return items.join(near, "id", "left").withColumn("related_items", both).select(*items.columns)


def link_items(items: DataFrame, how: Linking = Linking()) -> tuple[DataFrame, DataFrame]:
    """``link`` with the identifiers that the items themselves give."""
    return link(items, exact_identifiers(items), how)
