"""Changes between a record's versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, keys: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Each row with the values that the row before it had, as previous_*."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", *[F.lag(c).over(w).alias(f"previous_{c}") for c in columns], F.row_number().over(w).alias("version"))


def transitions(df: DataFrame, keys: list[str], order: list[Column], status: str) -> DataFrame:
    """Rows whose status differs from the one before; first rows are no transitions."""
    return with_previous(df, keys, order, [status]).filter((F.col("version") > 1) & ~F.col(status).eqNullSafe(F.col(f"previous_{status}")))


def delta(current: Column, previous: Column) -> Column:
    """0 at first sight."""
    return current - F.coalesce(previous, current)


def changed_fields(fields: list[str], old: str = "previous_{}") -> Column:
    """A map from each changed field to its old and new value as text."""
    entries = [F.struct(F.lit(f).alias("key"), F.struct(F.col(old.format(f)).cast("string").alias("old"), F.col(f).cast("string").alias("new")).alias("value")) for f in fields]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: ~e["value"]["old"].eqNullSafe(e["value"]["new"])))


def seen_union(seen: Column, new: Column, most: int = 200) -> Column:
    """New identifiers before those seen, without repeats, the first ``most``."""
    return F.slice(F.array_distinct(F.concat(new, seen)), 1, most)
