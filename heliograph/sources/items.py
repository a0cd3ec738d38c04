"""Item logs.  State and other documents are in heliograph.storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heliograph.schema import ITEM_SCHEMA


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines below a folder, at any depth; a malformed line fails the read, unknown keys are dropped."""
    return spark.read.schema(ITEM_SCHEMA).option("mode", "FAILFAST").option("recursiveFileLookup", True).json(path)


def known_ids(items: DataFrame) -> DataFrame:
    return items.select("id").distinct()


def union_sources(*sources: DataFrame) -> DataFrame:
    """One item table of several; columns a source lacks are null."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out
