"""All registered queries and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heliograph.plans import activity, digest, items, links, streams, text
from heliograph.shipping import ship


def _shipped(run):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark, "heliograph")
        return run(spark, sf_dir)

    return query


_ALL = activity.ALL | digest.ALL | text.ALL | items.ALL | streams.ALL | links.ALL
QUERIES = {name: _shipped(run) for name, (run, _) in _ALL.items()}
ORACLE_SQL = {name: sql for name, (_, sql) in _ALL.items() if sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["topic_momentum_7d"](spark, sf_dir)
