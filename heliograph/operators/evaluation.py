"""Multi-label evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.functions.numbers import round_even, round_floor, safe_divide


def micro_scores(cases: DataFrame, expected: str = "expected", predicted: str = "predicted", round_to=round_floor) -> DataFrame:
    """precision, recall, f1, exact_match over arrays of labels; zero where a denominator is."""
    tp, fp, fn = (F.size(f(expected, predicted)) for f in (F.array_intersect, lambda e, p: F.array_except(p, e), F.array_except))
    sums = cases.agg(F.sum(tp).alias("tp"), F.sum(fp).alias("fp"), F.sum(fn).alias("fn"), F.avg(F.when((fp == 0) & (fn == 0), 1.0).otherwise(0.0)).alias("exact"))
    p, r = safe_divide(F.col("tp"), F.col("tp") + F.col("fp")), safe_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    return sums.select("tp", "fp", "fn", round_to(p, 4).alias("precision"), round_to(r, 4).alias("recall"), round_to(safe_divide(2 * p * r, p + r), 4).alias("f1"), round_to(F.col("exact"), 4).alias("exact_match"))


def evaluate(cases: DataFrame, key: str, lexical: DataFrame, accepted: DataFrame) -> DataFrame:
    """lexical and semantic (structs of micro scores), cases, delta_f1: topics by lexical matching alone against those of the whole cascade.

    ``cases``: key, expected; ``lexical`` and ``accepted``: key, topic, one row for each
    topic predicted.  A case without predictions counts with none.
    """
    none = F.array().cast("array<string>")
    gathered = lambda df, name: df.groupBy(key).agg(F.collect_set("topic").alias(name))
    both = cases.join(gathered(lexical, "__l"), key, "left").join(gathered(accepted, "__s"), key, "left").withColumns({c: F.coalesce(c, none) for c in ("__l", "__s")})
    one = lambda c, name: micro_scores(both, "expected", c, round_even).select(F.struct("precision", "recall", "f1", "exact_match").alias(name))
    out = one("__l", "lexical").crossJoin(one("__s", "semantic")).crossJoin(both.agg(F.count("*").alias("cases")))  # three tables of one row
    return out.withColumn("delta_f1", round_even(F.col("semantic.f1") - F.col("lexical.f1"), 4))
