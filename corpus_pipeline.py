"""Cleaning a training corpus in five stages, from documents to packed windows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one gets those
rows as written and read again.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import frames, mixing, neardup, packing, pii, toxicity

#: Fitting, iteration and hash sampling are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    how = toxicity.Supervision()
    model = toxicity.learn_toxicity(docs, frames.table(spark, sf_dir, "labels"), how)
    return toxicity.keep_clean(docs, model, how.threshold)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind, and n_chars is counted anew."""
    names = docs.columns
    out = pii.redact_rows(docs)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in names])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources has them."""
    return mixing.repeat_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with window and offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mixture", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written to the shared folder and read again."""
    docs = frames.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = frames.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
