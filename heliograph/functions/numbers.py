"""Rounding and scoring as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_floor(x: Column, digits: int) -> Column:
    """Half up on the scaled value; the same in engines that disagree on the last bits of rounding."""
    k = float(10**digits)
    return F.floor(x * F.lit(k) + 0.5) / F.lit(k)


def round_even(x: Column, digits: int) -> Column:
    """Half to even on the exact binary value."""
    return F.regexp_replace(F.call_function("format_number", x, F.lit("0." + "0" * digits)), "^-(0\\.0*)$", "$1").cast("double")


def compensated_sum(terms: list[Column]) -> Column:
    """A sum whose lost low parts are carried along, term by term."""
    total, carry = F.lit(0.0), F.lit(0.0)
    for x in terms:
        new = total + x
        carry = carry + F.when(F.abs(total) >= F.abs(x), (total - new) + x).otherwise((x - new) + total)
        total = new
    return total + carry


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def growth_percent(current: Column, previous: Column, round_to=round_floor) -> Column:
    """Change in percent, two decimals; from nothing to nothing 0, from nothing to something null."""
    return F.when(previous == 0, F.when(current == 0, F.lit(0.0))).otherwise(round_to((current - previous) * 100.0 / previous, 2))


def format_growth(percent: Column, current: Column) -> Column:
    """``+1.2%``; ``new`` where there was nothing before, ``n/a`` where there still is nothing."""
    return F.when(percent.isNotNull(), F.format_string("%+.1f%%", percent)).when(current > 0, F.lit("new")).otherwise(F.lit("n/a"))


def safe_divide(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def log_share_ratio(current: Column, previous: Column, all_current: Column, all_previous: Column, n_topics: int, smoothing: float) -> Column:
    """Binary logarithm of the ratio of two smoothed shares."""
    a = (current + smoothing) / (all_current + smoothing * n_topics)
    b = (previous + smoothing) / (all_previous + smoothing * n_topics)
    return F.log2(a / b)


def numeric_int(json: Column, path: str) -> Column:
    """The number at a path of a JSON text, without its fraction; 0 for anything else, truth values and text included."""
    v = F.try_variant_get(F.try_parse_json(json), path, "variant")
    number = F.schema_of_variant(v).rlike("^(?:BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(F.coalesce(number, F.lit(False)), F.try_variant_get(v, "$", "double").cast("long")).otherwise(F.lit(0).cast("long"))
