"""Time windows and day buckets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def instant(ts: Column) -> Column:
    """A timestamp of the session's time zone from one without zone."""
    return ts.cast("timestamp")


def activity_date(ts: Column, zone: str = "Asia/Tokyo", boundary_hour: int = 8) -> Column:
    """The date on which the day that holds ``ts`` ends; days begin at ``boundary_hour`` of local time."""
    local = F.from_utc_timestamp(ts, zone) - F.expr(f"INTERVAL {boundary_hour} HOURS")
    return F.date_add(F.to_date(local), 1)


def report_window(day: Column, zone: str = "Asia/Tokyo", boundary_hour: int = 8) -> tuple[Column, Column]:
    """Start and end, exclusive, of a report date's window."""
    at = lambda d: F.to_utc_timestamp(F.to_timestamp(F.concat(d.cast("string"), F.lit(f" {boundary_hour:02d}:00:00"))), zone)
    return at(F.date_sub(day, 1)), at(day)


def half_open(ts: Column, start: Column, end: Column) -> Column:
    return F.coalesce((ts >= start) & (ts < end), F.lit(False))


def closed(ts: Column, start: Column, end: Column) -> Column:
    return F.coalesce(ts.between(start, end), F.lit(False))


def spine(spark: SparkSession, last_day: str, days: int) -> DataFrame:
    """One row a day, the last one ``last_day``."""
    return spark.range(1).select(F.explode(F.sequence(F.date_sub(F.lit(last_day).cast("date"), days - 1), F.lit(last_day).cast("date"))).alias("day"))


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00"))


def format_iso(ts: Column) -> Column:
    """UTC with Z; a fraction only if there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.when(micros == 0, F.concat(whole, F.lit("Z"))).otherwise(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))


def parse_feed_time(text: Column) -> Column:
    """Mail dates, then ISO; without a zone, UTC."""
    t = F.trim(text)
    forms = ["EEE, d MMM yyyy HH:mm:ss Z", "EEE, d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z"]
    bare = F.regexp_replace(t, "^[A-Za-z]{3}, ", "")
    tries = [F.try_to_timestamp(bare, F.lit(f.removeprefix("EEE, "))) for f in forms[2:]]
    return F.coalesce(*tries, parse_iso(t), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss")))
