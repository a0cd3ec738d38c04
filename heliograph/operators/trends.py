"""Daily activity, momentum, growth and recurring entities.

Activities have the columns ts, day, identity, item, kind, topics; callers name theirs so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.numbers import growth_percent, log_share_ratio, round_floor
from heliograph.storage import written


def daily_activity(activity: DataFrame, days: DataFrame) -> DataFrame:
    """day, items, entities; zero on days without activity.  The spine is small and is what the join keeps."""
    counts = activity.groupBy("day").agg(F.count("*").alias("items"), F.count_distinct("identity").alias("entities"))
    out = days.join(counts, "day", "left")
    return out.select("day", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("entities", F.lit(0)).alias("entities"))


def daily_counts(activity: DataFrame, by: str) -> DataFrame:
    """day and a map from value to number of items, in order of the value."""
    each = activity.groupBy("day", by).agg(F.count("*").alias("n"))
    return each.groupBy("day").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(by, "n")))).alias(f"by_{by}"))


def daily_topics(activity: DataFrame) -> DataFrame:
    """day, topic, entities: distinct entities of each topic and day."""
    return activity.select("day", "identity", F.explode("topics").alias("topic")).groupBy("day", "topic").agg(F.count_distinct("identity").alias("entities"))


def first_seen(history: DataFrame, keys: list[str]) -> DataFrame:
    """When each key first occurs, over the whole history."""
    return history.groupBy(*keys).agg(F.min("ts").alias("first_ts"))


def momentum(activity: DataFrame, end: Column, days: int, topics: DataFrame | None, smoothing: float = 1.0, minimum: int = 2, limit: int = 15, all_topics: int | None = None) -> DataFrame:
    """topic, current, previous, momentum: the best by rounded momentum, then current count, then name.

    Totals count every entity with activity, with topics or without.  Only topics of
    the taxonomy (``topics``, column topic), if given, take part.
    """
    start, before = end - F.expr(f"INTERVAL {days} DAYS"), end - F.expr(f"INTERVAL {2 * days} DAYS")
    seen = activity.filter((F.col("ts") >= before) & (F.col("ts") < end)).withColumn("now", F.col("ts") >= start)
    totals = seen.groupBy("identity").agg(F.max("now").alias("now"), F.min("now").alias("all_now")).agg(F.count_if("now").alias("n_now"), F.count_if(~F.col("all_now")).alias("n_before"))
    each = seen.select("identity", "now", F.explode("topics").alias("topic")).groupBy("topic", "identity").agg(F.max("now").alias("now"), F.min("now").alias("all_now"))
    counts = each.groupBy("topic").agg(F.count_if("now").alias("current"), F.count_if(~F.col("all_now")).alias("previous"))
    if topics is not None:
        counts = counts.join(topics.select("topic").distinct(), "topic")
    n = F.lit(all_topics) if all_topics is not None else F.col("n_topics")
    if all_topics is None:
        totals = totals.crossJoin(F.broadcast((topics if topics is not None else activity.select(F.explode("topics").alias("topic"))).select("topic").distinct().agg(F.count("*").alias("n_topics"))))  # one row
    scored = counts.filter(F.col("current") >= minimum).crossJoin(F.broadcast(totals))  # one row of totals
    value = log_share_ratio(F.col("current"), F.col("previous"), F.col("n_now"), F.col("n_before"), n, smoothing)
    scored = scored.select("topic", "current", "previous", round_floor(value, 4).alias("momentum"))
    return scored.orderBy(F.desc("momentum"), F.desc("current"), "topic").limit(limit)


def new_entity_growth(first: DataFrame, end: Column, days: int, by: str) -> DataFrame:
    """by, current, previous, delta, percent: entities first seen in the window and in the one before."""
    start, before = end - F.expr(f"INTERVAL {days} DAYS"), end - F.expr(f"INTERVAL {2 * days} DAYS")
    now, was = (F.col("first_ts") >= start) & (F.col("first_ts") < end), (F.col("first_ts") >= before) & (F.col("first_ts") < start)
    out = first.groupBy(by).agg(F.count_if(now).alias("current"), F.count_if(was).alias("previous"))
    return out.select(by, "current", "previous", (F.col("current") - F.col("previous")).alias("delta"), growth_percent(F.col("current"), F.col("previous")).alias("percent"))


def recurring(activity: DataFrame, least_items: int, least_days: int, limit: int, priority: Column, title: str = "title") -> DataFrame:
    """Entities with enough items on enough days: the title of the item of best priority, counts, sets and the last time."""
    out = activity.groupBy("identity").agg(
        F.count("*").alias("items"), F.count_distinct("day").alias("active_days"), F.min_by(title, F.struct(priority, "item")).alias("title"),
        F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"), F.max("ts").alias("last_ts"),
    )
    out = out.filter((F.col("items") >= least_items) & (F.col("active_days") >= least_days))
    return out.orderBy(F.desc("active_days"), F.desc("items"), "identity").limit(limit)


def entity_topics(activity: DataFrame) -> DataFrame:
    """identity, topics: the union of its items' topics; entities without any stay.  Distinct topics are gathered, of which a taxonomy has a bounded number."""
    return activity.select("identity", F.explode_outer("topics").alias("topic")).groupBy("identity").agg(F.array_sort(F.collect_set("topic")).alias("topics"))


def with_identity(items: DataFrame, entities: DataFrame) -> DataFrame:
    """Items with their entity, or themselves where they are in none.  ``entities``: item, entity_id."""
    return items.join(entities, "item", "left").withColumn("identity", F.coalesce("entity_id", "item")).drop("entity_id")


def rank_within(df: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def numbered(activity: DataFrame, name: str = "identity") -> DataFrame:
    """identity, number: dense numbers from 0 in hashed buckets, a bucket's after those of the buckets before it; null identities have none."""
    ids = activity.select(F.col(name).alias("identity")).filter("identity is not null").distinct()
    ids = ids.withColumn("bucket", F.pmod(F.xxhash64("identity"), F.lit(256)))
    ids = written(ids.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("identity")) - 1))
    sizes = ids.groupBy("bucket").agg(F.count("*").alias("n"))  # 256 rows at most
    start = sizes.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return ids.join(F.broadcast(start), "bucket").select("identity", (F.col("start") + F.col("place")).alias("number"))


def daily_bitmaps(activity: DataFrame, numbers: DataFrame) -> DataFrame:
    """day, topic, block, bits: the exact set of entities of each topic and day, a bitmap for each block of 32,768 numbers that has some.

    Written once, it answers every window: sets of days are united by OR, and counts are
    exact, which sums of daily counts aren't.
    """
    each = activity.select("day", "identity", F.explode("topics").alias("topic")).distinct().join(numbers, "identity")
    each = each.select("day", "topic", F.bitmap_bucket_number("number").alias("block"), F.bitmap_bit_position("number").alias("bit"))
    return each.groupBy("day", "topic", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def rolling_entities(bitmaps: DataFrame, days: DataFrame, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """day, topic and entities_N for each window: distinct entities of the N days up to each of ``days`` (column day), of topics with any in the longest."""
    longest = max(windows)
    reach = bitmaps.withColumn("ahead", F.explode(F.sequence(F.lit(0), F.lit(longest - 1)))).withColumn("to", F.date_add("day", F.col("ahead")))
    reach = reach.join(days.select(F.col("day").alias("to")), "to")
    united = reach.groupBy("to", "topic", "block").agg(*[F.bitmap_or_agg(F.when(F.col("ahead") < n, F.col("bits"))).alias(f"b{n}") for n in windows])
    return united.groupBy(F.col("to").alias("day"), "topic").agg(*[F.sum(F.coalesce(F.bitmap_count(f"b{n}"), F.lit(0))).alias(f"entities_{n}") for n in windows])
