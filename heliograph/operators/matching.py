"""Lexical and TF-IDF topic matching."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from heliograph.functions.numbers import round_even
from heliograph.functions.text import anchor_matches, char_ngrams, contains_phrase, normalize_words, tokens, word_ngrams
from heliograph.functions.topic_matrix import TopicMatrix
from heliograph.functions.udfs import phrases_in
from heliograph.shipping import bounded_batches, ship
from heliograph.storage import written


#: Aliases up to this number are sent to all tasks (some 20 MB); more are joined.
BROADCAST_ALIASES = 200_000

#: Profiles of up to this number of distinct features meet the texts in their tasks (some 100 MB a worker); those of more are joined.
SENT_FEATURES = 500_000
#: About so many entries of profiles are sent at once; more take several passes over the texts.
SENT_ENTRIES = 500_000


def phrase_candidates(documents: DataFrame, key: str, field: str, aliases: DataFrame, most_words: int) -> DataFrame:
    """key and the columns of ``aliases``: documents whose normalised field has the normalised alias as whole words.

    Up to ``BROADCAST_ALIASES`` aliases each text is walked once, and only runs that
    begin with an alias's first word are looked up: work follows the text and what is
    found is all that goes on.  More aliases meet the texts' distinct n-grams by a join.
    """
    plain = aliases.filter("alias <> ''")
    names = [r.alias for r in plain.select("alias").distinct().limit(BROADCAST_ALIASES + 1).collect()]
    if len(names) > BROADCAST_ALIASES:
        grams = documents.select(key, F.explode(F.array_distinct(word_ngrams(tokens(normalize_words(F.col(field))), 1, most_words))).alias("alias"))
    else:
        ship(documents.sparkSession, "heliograph")
        grams = documents.select(key, F.explode(phrases_in(F.col(field), [n for n in names if n.count(" ") < most_words])).alias("alias"))
    return grams.join(plain, "alias")


def lexical_topics(documents: DataFrame, key: str, fields: dict[str, float], aliases: DataFrame, most_words: int = 6, rest_weight: float = 0.08, rest_most: float = 0.20) -> tuple[DataFrame, DataFrame]:
    """(key, topic, score, term) and (key, score).  ``aliases``: topic, alias (normalised), ord.

    A topic scores its best field; of equal ones the first alias and field.  A document
    scores its best topic and a bounded share of the others.
    """
    hits = None
    for k, (name, weight) in enumerate(fields.items()):
        found = phrase_candidates(documents, key, name, aliases, most_words).select(key, "topic", "alias", "ord", F.lit(float(weight)).alias("weight"), F.lit(k).alias("field"))
        hits = found if hits is None else hits.unionByName(found)
    topics = hits.groupBy(key, "topic").agg(F.max("weight").alias("score"), F.max_by("alias", F.struct("weight", -F.col("ord"), -F.col("field"))).alias("term"))
    scores = topics.groupBy(key).agg(F.max("score").alias("best"), F.sum("score").alias("all"))
    total = F.least(F.col("best") + F.least(rest_weight * (F.col("all") - F.col("best")), F.lit(rest_most)), F.lit(1.0))
    return topics, scores.select(key, round_even(total, 4).alias("score"))


@dataclass(frozen=True)
class Profiles:
    """Fixed values of the topic-profile model."""

    word_low: int = 1
    word_high: int = 2
    char_low: int = 3
    char_high: int = 5
    word_weight: float = 0.7
    char_weight: float = 0.3
    minimum: float = 0.12
    relative: float = 0.68
    most_topics: int = 4
    acceptance: float = 0.16
    full_scale: float = 0.4


def features(documents: DataFrame, key: str, text: str, how: Profiles = Profiles()) -> DataFrame:
    """key, feature, tf: word n-grams as w:…, character n-grams inside words as c:…."""
    words = tokens(normalize_words(F.col(text)))
    w = F.transform(word_ngrams(words, how.word_low, how.word_high), lambda g: F.concat(F.lit("w:"), g))
    c = F.transform(char_ngrams(words, how.char_low, how.char_high), lambda g: F.concat(F.lit("c:"), g))
    return documents.select(key, F.explode(F.concat(w, c)).alias("feature")).groupBy(key, "feature").agg(F.count("*").alias("tf"))


def inverse_frequency(counts: DataFrame, key: str) -> DataFrame:
    """feature, idf over the documents of ``counts``; the number of documents is one broadcast row."""
    n = counts.agg(F.count_distinct(key).alias("n"))
    df = counts.groupBy("feature").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("feature", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1.0).alias("idf"))


def vectors(counts: DataFrame, key: str, idf: DataFrame, how: Profiles = Profiles()) -> DataFrame:
    """key, feature, value: unit vectors; features without idf are left out before the norm."""
    kind = F.when(F.col("feature").startswith("w:"), how.word_weight).otherwise(how.char_weight)
    raw = counts.join(idf, "feature").withColumn("value", (1 + F.log("tf")) * F.col("idf") * kind)
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    return raw.join(norm, key).select(key, "feature", (F.col("value") / F.col("norm")).alias("value"))


def cosine(documents: DataFrame, key: str, profiles: DataFrame, topic: str = "topic") -> DataFrame:
    """key, topic, similarity of unit vectors that share a feature."""
    p = profiles.select(F.col(topic), "feature", F.col("value").alias("__v"))
    return documents.join(p, "feature").groupBy(key, topic).agg(F.sum(F.col("value") * F.col("__v")).alias("similarity"))


def anchored(text: Column, required_any: list[str], required_groups: list[list[str]]) -> Column:
    """Whether normalised text has one of the anchors and one of each group; nothing required is met."""
    out = F.lit(True)
    for group in ([required_any] if required_any else []) + required_groups:
        some = F.lit(False)
        for a in group:
            some = some | anchor_matches(text, a)
        out = out & some
    return out


def select_topics(scores: DataFrame, key: str, how: Profiles = Profiles()) -> DataFrame:
    """The best topics of each document, in order: above the minimum, near the best, at most so many."""
    w = Window.partitionBy(key)
    out = scores.withColumn("best", F.max("similarity").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("similarity"), "topic")))
    return out.filter((F.col("similarity") >= how.minimum) & (F.col("similarity") >= F.col("best") * how.relative) & (F.col("rank") <= how.most_topics)).drop("best")


def _spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores, where their files are fewer than cores: texts of one small file would be one task's work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(4 * cores) if df.rdd.getNumPartitions() < cores else df


def known_vectors(documents: DataFrame, key: str, text: str, idf: DataFrame, how: Profiles = Profiles()) -> DataFrame:
    """``vectors`` of ``features`` that ``idf`` has; others are dropped before anything is counted or shuffled by document.

    Character n-grams lie inside words, so they are made once for each distinct word of all
    documents; a document has those of its distinct words, times the word's count.
    """
    words = written(_spread(documents).select(key, tokens(normalize_words(F.col(text))).alias("__words")))
    w = F.transform(word_ngrams(F.col("__words"), how.word_low, how.word_high), lambda g: F.concat(F.lit("w:"), g))
    runs = words.select(key, F.explode(w).alias("feature")).join(idf, "feature").groupBy(key, "feature", "idf").agg(F.count("*").alias("tf"))
    has = written(words.select(key, F.explode("__words").alias("__word")).groupBy(key, "__word").agg(F.count("*").alias("__n")))
    c = F.transform(char_ngrams(F.array("__word"), how.char_low, how.char_high), lambda g: F.concat(F.lit("c:"), g))
    inside = has.select("__word").distinct().select("__word", F.explode(c).alias("feature")).join(idf, "feature").groupBy("__word", "feature", "idf").agg(F.count("*").alias("__m"))
    chars = has.join(inside, "__word").groupBy(key, "feature", "idf").agg(F.sum(F.col("__n") * F.col("__m")).alias("tf"))
    counts = runs.unionByName(chars)
    kind = F.when(F.col("feature").startswith("w:"), how.word_weight).otherwise(how.char_weight)
    raw = counts.select(key, "feature", ((1 + F.log("tf")) * F.col("idf") * kind).alias("value"))
    norm = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy(key)))
    return raw.select(key, "feature", (F.col("value") / norm).alias("value"))


def split_profiles(profiles: DataFrame, light: float) -> DataFrame:
    """``profiles`` (topic, feature, value) with ``heavy``, and ``rest``: the norm of a topic's features that aren't.

    A topic's smallest values are light as long as their norm is at most ``light``: those
    are most of its features, the ones most topics have.  Of a unit vector's product with
    the topic, they make up ``rest`` at most.
    """
    upto = F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("topic").orderBy("value", "feature").rowsBetween(Window.unboundedPreceding, 0))
    out = profiles.withColumn("heavy", upto > light * light)
    return out.withColumn("rest", F.sqrt(F.sum(F.when(~F.col("heavy"), F.col("value") * F.col("value")).otherwise(0.0)).over(Window.partitionBy("topic"))))


def near_topics(mine: DataFrame, key: str, profiles: DataFrame, allowed: DataFrame | None = None, how: Profiles = Profiles()) -> DataFrame:
    """key, topic, similarity: every pair that ``select_topics`` may choose, and no pair whose bound rules it out.

    A topic's light features, most topics' commonest, add less than the minimum, so a pair
    without a heavy one can't be chosen.  What heavy ones add up to is a lower bound, with
    the topic's ``rest`` an upper one; a topic whose upper bound is below the minimum, or
    below the relative threshold of the document's best lower bound, is left out.  Documents
    meet all features in one join, where both sums are made: pairs of document and topic
    never meet a document's features again.  ``allowed``: key and an array of topics that may
    be chosen, where topics are gated.
    """
    slack = 1e-6  # similarities are rounded before they are compared
    p = split_profiles(profiles, max(0.0, how.minimum - 2 * slack)).select("topic", "feature", F.col("value").alias("__v"), "heavy", "rest")
    product = F.col("value") * F.col("__v")
    sums = mine.join(p, "feature").groupBy(key, "topic").agg(F.sum(F.when(F.col("heavy"), product)).alias("low"), F.sum(product).alias("similarity"), F.first("rest").alias("rest"))
    first = sums.filter("low is not null")
    if allowed is not None:
        first = first.join(allowed, key).filter(F.array_contains("__allowed", F.col("topic"))).drop("__allowed")
    best = F.max("low").over(Window.partitionBy(key))
    return first.withColumn("best", best).filter((F.col("low") + F.col("rest") + slack >= how.minimum) & (F.col("low") + F.col("rest") + slack >= how.relative * F.col("best"))).select(key, "topic", "similarity")


def near_in_tasks(docs: DataFrame, key: str, profiles: DataFrame, idf: DataFrame, gated: list[str], how: Profiles = Profiles()) -> DataFrame:
    """As ``near_topics``, of ``docs`` (key, __norm_all: normalised words, __met: those of the ``gated`` topics that a row may have), one row a key.

    A text's features never leave its task: the profiles are sent instead, about
    ``SENT_ENTRIES`` entries a pass, and only pairs that may be chosen are rows.
    """
    spark = docs.sparkSession
    ship(spark, "heliograph")
    bounded_batches(spark)
    known = idf.toArrow().combine_chunks()
    names = known.column("feature").combine_chunks()
    kind = pc.if_else(pc.starts_with(names, "w:"), how.word_weight, how.char_weight)
    weights = pc.multiply(known.column("idf"), kind).to_numpy()
    features = spark.sparkContext.broadcast((names.to_pylist(), weights))
    passes = max(1, -(-profiles.count() // SENT_ENTRIES))
    schema = StructType([docs.schema[key]]).add("topic", "string").add("similarity", "double")

    def found(number: int) -> DataFrame:
        t = profiles.filter(F.pmod(F.xxhash64("topic"), F.lit(passes)) == number).toArrow()  # about ``SENT_ENTRIES``
        coded = t.column("topic").combine_chunks().dictionary_encode()
        topics = coded.dictionary.to_pylist()
        sent = spark.sparkContext.broadcast((topics, (pc.index_in(t.column("feature"), names).to_numpy(), coded.indices.to_numpy(), t.column("value").to_numpy())))
        numbers = {topic: k for k, topic in enumerate(topics)}
        shut = {topic: numbers[topic] for topic in gated if topic in numbers}

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matrix, called = None, None
            for batch in batches:
                if matrix is None:
                    (names, weights), (topics, entries) = features.value, sent.value
                    matrix, called = TopicMatrix(names, weights, len(topics), entries, (how.word_low, how.word_high, how.char_low, how.char_high)), pa.array(topics, pa.string())
                barred = [[k for topic, k in shut.items() if topic not in met] for met in batch.column(2).to_pylist()] if shut else None
                for row, topic, similarity in matrix.near(batch.column(1).to_pylist(), barred, how.minimum, how.relative, how.most_topics):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), called.take(pa.array(topic)), pa.array(similarity)], names=schema.names)

        return docs.select(key, "__norm_all", "__met").mapInArrow(near, schema) if topics else spark.createDataFrame([], schema)

    return functools.reduce(DataFrame.unionByName, [found(number) for number in range(passes)])


def semantic_topics(documents: DataFrame, key: str, title: str, text: str, profile_texts: DataFrame, anchors: dict[str, tuple[list[str], list[list[str]]]] | None = None, how: Profiles = Profiles()) -> DataFrame:
    """key, topic, similarity, rank.  ``profile_texts``: topic, text, a row for each topic; the title counts twice.

    Rows of one key are one document, rows without a key none.  Documents of one row meet the
    profiles in their tasks; those of several, and all where profiles have more than
    ``SENT_FEATURES`` features, by joins.
    """
    counts = features(profile_texts, "topic", "text", how)
    idf = written(inverse_frequency(counts, "topic"))
    profiles = written(vectors(counts, "topic", idf, how))
    met = F.array_compact(F.array(*[F.when(anchored(F.col("__norm"), *rule), F.lit(t)) for t, rule in anchors.items()])) if anchors else F.array().cast("array<string>")
    docs = documents.filter(F.col(key).isNotNull()).select(key, F.concat_ws(" ", title, title, text).alias("__all"), normalize_words(F.concat_ws(" ", title, text)).alias("__norm")).select(key, "__all", met.alias("__met"))

    def joined(docs: DataFrame) -> DataFrame:
        mine = written(known_vectors(docs, key, "__all", idf, how))
        gate = None
        if anchors:
            free = profiles.select("topic").distinct().filter(~F.col("topic").isin(*anchors)).agg(F.collect_list("topic").alias("__free"))  # the topics, one row
            own = docs.select(key, F.explode_outer("__met").alias("__one")).groupBy(key).agg(F.collect_set("__one").alias("__some"))
            gate = own.crossJoin(F.broadcast(free)).select(key, F.concat("__some", "__free").alias("__allowed"))
        return near_topics(mine, key, profiles, gate, how)

    if idf.count() > SENT_FEATURES:
        scores = joined(docs)
    else:
        several = written(documents.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key))
        some = not several.isEmpty()
        single = _spread(docs.join(several, key, "left_anti") if some else docs).select(key, normalize_words(F.col("__all")).alias("__norm_all"), "__met")
        scores = near_in_tasks(single, key, profiles, idf, list(anchors or {}), how)
        if some:
            scores = scores.unionByName(joined(docs.join(several, key, "left_semi")))
    return select_topics(scores.withColumn("similarity", round_even(F.col("similarity"), 6)), key, how)


@dataclass(frozen=True)
class Cascade:
    """When topics of profiles enrich a lexical match, and the band in which an outside classifier is asked."""

    enrichment: float = 0.22
    ask_from: float = 0.10
    ask_to: float = 0.28
    most_candidates: int = 4


@dataclass(frozen=True)
class Outside:
    """A classifier outside Spark: it gets lists of at most ``batch`` texts (title, text, candidates) and returns as many answers.

    An answer has relevant, relevance and topics, or is null where it abstains.  When a
    call fails, its texts are asked one by one, so a text that fails costs no other's
    answer.  At most ``budget`` texts a run are asked, those first in ``order``; the others'
    error says so.
    """

    call: Callable[[list[dict]], list[dict | None]]
    batch: int = 16
    budget: int | None = None
    order: tuple[str, ...] = ("title", "text")

    def ask(self, rows: DataFrame) -> DataFrame:
        """``rows`` with __said (null without an answer) and classifier_error."""
        ship(rows.sparkSession, "heliograph")
        call, batch_rows, schema = self.call, self.batch, rows.schema
        said = pa.struct([("relevant", pa.bool_()), ("relevance", pa.float64()), ("topics", pa.list_(pa.string()))])

        def answers(asked: list[dict]) -> list[tuple[dict | None, str | None]]:
            try:
                got = call(asked)
                if len(got) != len(asked):
                    raise ValueError(f"{len(got)} answers to {len(asked)} texts")
                pa.array(got, said)  # answers of another shape are failures, too
                return [(x, None) for x in got]
            except Exception as e:
                if len(asked) == 1:
                    return [(None, f"{type(e).__name__}: {e}")]
                return [a for one in asked for a in answers([one])]

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, batch_rows):
                    part = whole.slice(at, batch_rows)
                    texts = part.select(["title", "text", "__candidates"]).to_pylist()
                    got = answers([{"title": t["title"], "text": t["text"], "candidates": t["__candidates"]} for t in texts])
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in got], said), pa.array([e for _, e in got], pa.string())], names=[*part.schema.names, "__said", "classifier_error"])

        out = StructType([*schema.fields]).add("__said", StructType.fromDDL("relevant boolean, relevance double, topics array<string>")).add("classifier_error", "string")
        if self.budget is None:
            return rows.mapInArrow(each, out)
        ranked = written(rows.withColumn("__at", F.xxhash64(*self.order)))
        last = ranked.select("__at", *self.order).orderBy(*self.order, "__at").limit(self.budget)  # at most ``budget`` rows
        first = last.groupBy(*[F.col(c).alias(f"__order_{c}") for c in self.order]).agg(F.count("*").alias("__quota"))
        place = F.row_number().over(Window.partitionBy(*self.order).orderBy("__at"))
        same = [F.col(c).eqNullSafe(F.col(f"__order_{c}")) for c in self.order]
        dealt = ranked.withColumn("__place", place).join(first, functools.reduce(lambda a, b: a & b, same), "left").select(*rows.columns, (F.col("__place") <= F.coalesce("__quota", F.lit(0))).alias("__ask"))
        dealt = written(dealt)  # the two sides below must agree
        rest = dealt.filter("not __ask").select(*rows.columns, F.lit(None).cast("struct<relevant:boolean,relevance:double,topics:array<string>>").alias("__said"), F.lit(f"budget: more than {self.budget} texts").alias("classifier_error"))
        return dealt.filter("__ask").select(*rows.columns).mapInArrow(each, out).unionByName(rest)


def rejected(lexical: Column) -> Column:
    """The result of a text that no step accepts."""
    return F.struct(F.lit(False).alias("accepted"), lexical.alias("relevance"), F.array().cast("array<string>").alias("topics"), F.lit("rejected").alias("method"))


def decide(lexical: Column, lexical_minimum: float, similarity: Column, how: Profiles = Profiles()) -> tuple[Column, Column]:
    """method and relevance: lexical if it is enough, else semantic if similar enough, else rejected."""
    semantic = round_even(F.least(F.greatest(similarity / how.full_scale, F.lit(0.0)), F.lit(1.0)), 4)
    method = F.when(lexical >= lexical_minimum, "lexical").when(similarity >= how.acceptance, "semantic_profile").otherwise("rejected")
    return method, F.when(method == "lexical", lexical).when(method == "semantic_profile", semantic).otherwise(0.0)


def classify(scored: DataFrame, lexical_minimum: float, classifier: Callable[[Column, Column, Column], Column] | Outside | None = None, how: Profiles = Profiles(), cascade: Cascade = Cascade()) -> DataFrame:
    """``scored`` with result: accepted, relevance, topics, method.

    ``scored``: title, text, lexical (score), lexical_topics, semantic (an array of
    structs topic and similarity, best first; may be empty).  A lexical match is
    accepted, and profiles at least ``enrichment`` similar add their topics.  Of the
    rest, those whose best similarity lies in the band are given to ``classifier``, if
    there is one: a function of title, text and candidate topics that makes a struct
    relevant, relevance, topics, or null where it fails or abstains; its topics count
    where they are candidates.  As an ``Outside`` it is asked in batches, its failures stay
    with their texts in the column ``classifier_error``, and those texts go on as if it
    hadn't been asked.  All others are accepted if similar enough.
    """
    best = F.coalesce(F.get("semantic", F.lit(0))["similarity"], F.lit(0.0))
    topics = F.transform("semantic", lambda x: x["topic"])
    enough = F.filter("semantic", lambda x: x["similarity"] >= cascade.enrichment)
    added = F.transform(enough, lambda x: x["topic"])
    lexical = F.struct(F.lit(True).alias("accepted"), round_even(F.col("lexical"), 4).alias("relevance"), F.array_sort(F.array_union("lexical_topics", added)).alias("topics"), F.when(F.size(enough) > 0, "lexical+semantic_profile").otherwise("lexical").alias("method"))
    alone = round_even(F.least(F.greatest(best / how.full_scale, F.lit(0.0)), F.lit(1.0)), 4)
    low = round_even(F.col("lexical"), 4)
    none = F.array().cast("array<string>")
    semantic = F.when((best >= how.acceptance) & (F.size("semantic") > 0), F.struct(F.lit(True).alias("accepted"), alone.alias("relevance"), topics.alias("topics"), F.lit("semantic_profile").alias("method"))).otherwise(F.struct(F.lit(False).alias("accepted"), low.alias("relevance"), none.alias("topics"), F.lit("semantic_profile").alias("method")))
    by_lexical = F.col("lexical") >= lexical_minimum
    if classifier is None:
        return scored.withColumn("result", F.when(by_lexical, lexical).otherwise(semantic))
    candidates = F.slice(topics, 1, cascade.most_candidates)
    ask = ~by_lexical & (F.size("semantic") > 0) & best.between(cascade.ask_from, cascade.ask_to)
    # only texts in the band reach the classifier
    if isinstance(classifier, Outside):
        asked = classifier.ask(scored.filter(ask).withColumn("__candidates", candidates)).drop("__candidates")
    else:
        asked = scored.filter(ask).withColumn("__said", classifier(F.col("title"), F.col("text"), candidates))
    chosen = F.array_sort(F.array_intersect(F.col("__said")["topics"], candidates))
    good = F.col("__said")["relevant"] & (F.size(chosen) > 0)
    outside = F.struct(good.alias("accepted"), F.when(good, round_even(F.least(F.greatest(F.col("__said")["relevance"], F.lit(0.0)), F.lit(1.0)), 4)).otherwise(low).alias("relevance"), F.when(good, chosen).otherwise(none).alias("topics"), F.lit("classifier").alias("method"))
    asked = asked.withColumn("result", F.when(F.col("__said").isNull(), semantic).otherwise(outside)).drop("__said")
    return asked.unionByName(scored.filter(~ask).withColumn("result", F.when(by_lexical, lexical).otherwise(semantic)), allowMissingColumns=True)


__all__ = ["Cascade", "Outside", "Profiles", "anchored", "classify", "contains_phrase", "cosine", "decide", "features", "inverse_frequency", "known_vectors", "lexical_topics", "near_in_tasks", "near_topics", "phrase_candidates", "rejected", "select_topics", "semantic_topics", "vectors"]
