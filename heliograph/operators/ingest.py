"""Idempotent loads and keep-one rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__r = 1").drop("__r")


def new_rows(batch: DataFrame, known: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Rows of a batch whose key is neither known nor earlier in the batch."""
    return keep_first(batch, [key], order).join(known.select(key).distinct(), key, "left_anti")


def append_items(batch: DataFrame, path: str, key: str = "id", when: str = "discovered_at") -> int:
    """Appends new rows to a table partitioned by UTC date, and returns how many."""
    spark = batch.sparkSession
    batch = batch.withColumn("d_date", F.to_date(F.try_to_timestamp(F.regexp_replace(F.col(when), "Z$", "+00:00"))))
    try:
        known = spark.read.parquet(path).select(key)
    except Exception as missing:  # a first load has no table yet
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        known = batch.select(key).limit(0)
    fresh = new_rows(batch, known, key, [F.asc(when)]).persist()
    n = fresh.count()
    if n:
        fresh.repartition("d_date").write.mode("append").partitionBy("d_date").parquet(path)
    fresh.unpersist()
    return n


def latest_version(df: DataFrame, keys: list[str], updated: str, arrival: list[Column]) -> DataFrame:
    """The newest version of each key; of equally new ones the first to arrive."""
    return keep_first(df, keys, [F.col(updated).desc_nulls_last(), *arrival])


def inventory_changes(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """key, change: added or lost."""
    added = now.select(key).distinct().join(before.select(key), key, "left_anti").withColumn("change", F.lit("added"))
    lost = before.select(key).distinct().join(now.select(key), key, "left_anti").withColumn("change", F.lit("lost"))
    return added.unionByName(lost)


def guarded_inventory(before: DataFrame, now: DataFrame, key: str, minimum: int) -> DataFrame:
    """New keys, after checking that the inventory is large enough and has lost none; the first inventory gives none."""
    n = now.select(key).distinct().count()
    if n < minimum:
        raise ValueError(f"the inventory has {n} entries, fewer than {minimum}")
    lost = before.select(key).distinct().join(now.select(key), key, "left_anti").count()
    if lost:
        raise ValueError(f"the inventory lost {lost} known entries")
    if before.isEmpty():
        return now.select(key).limit(0)
    return now.select(key).distinct().join(before.select(key), key, "left_anti")


def merged_hits(hits: DataFrame, key: str, sets: list[str], flags: list[str], newest: dict[str, str], by: str) -> DataFrame:
    """One row a key: sorted sets, OR-ed flags, and the fields of its newest hit."""
    aggs = [F.sort_array(F.collect_set(c)).alias(f"{c}_set") for c in sets] + [F.bool_or(c).alias(c) for c in flags] + [F.max_by(c, by).alias(a) for a, c in newest.items()]
    return hits.groupBy(key).agg(*aggs)


def prefer(configured: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """The union of two target tables by case-folded key; configured rows win."""
    both = configured.withColumn("__p", F.lit(0)).unionByName(registered.withColumn("__p", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("__r", F.row_number().over(Window.partitionBy(F.lower(key)).orderBy("__p", key))).filter("__r = 1").drop("__p", "__r")
