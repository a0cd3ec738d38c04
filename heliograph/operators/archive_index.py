"""Archive search by an index of character trigrams.

The index is a table (gram, id, fields): each run of three bytes of a record's lower-cased
fields, and which fields have it.  It is written once, in ranges of grams, so a query's
scan reads the parts of its own grams only.  A record that has all grams of a word in a
field may have the word there, so fields give an upper bound on a record's score; records
are verified from the highest bound down, until no other can reach the best ones.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.text import search_score
from heliograph.operators.archive import search
from heliograph.shipping import ship
from heliograph.storage import written

#: Fields in order of what a word is worth in them, with their bit.
_FIELDS = (("title", 4, 10), ("extra", 2, 5), ("summary", 1, 3))
_PHRASE = 30


def grams_of(word: str) -> set[int]:
    """The trigrams of a text's bytes, as numbers; none of a text shorter than three bytes."""
    raw = word.encode()
    return {int.from_bytes(raw[k : k + 3], "big") for k in range(len(raw) - 2)}


def _field_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and gram of each distinct trigram of a string column."""
    column = column.cast(pa.large_string()).fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.int64) if data is not None else np.zeros(0, np.int64)
    offsets = offsets - offsets[0]
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(column)), np.diff(offsets))
    code = np.unique(((row[:-2] << 24) | (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:])[row[:-2] == row[2:]])
    return code >> 24, code & 0xFFFFFF


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):  # a block's grams are in memory at a time
            block = whole.slice(at, 256)
            codes, bits = [], []
            for name, bit, _ in _FIELDS:
                row, gram = _field_grams(block.column(name))
                codes.append((row << 24) | gram)
                bits.append(np.full(len(row), bit, dtype=np.int32))
            code, bit = np.concatenate(codes), np.concatenate(bits)
            order = np.argsort(code, kind="stable")
            code, bit = code[order], bit[order]
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
            masks = np.bitwise_or.reduceat(bit, first) if len(code) else bit
            row, gram = code[first] >> 24, (code[first] & 0xFFFFFF).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(gram), block.column("id").take(pa.array(row)), pa.array(masks)], names=["gram", "id", "fields"])


def write_index(records: DataFrame, path: str, id_col: str, title: Column, extra: Column, summary: Column, ranges: int | None = None) -> None:
    """Writes the postings of ``records``.  Grams are dealt out by ranges, a common gram's records by identifier as well, and files are sorted by gram."""
    ship(records.sparkSession, "heliograph")
    kind = records.select(id_col).schema[0].dataType.simpleString()
    fields = records.select(F.col(id_col).alias("id"), *[F.lower(c).alias(n) for c, n in ((title, "title"), (extra, "extra"), (summary, "summary"))])
    rows = written(fields.mapInArrow(_postings, f"gram int, id {kind}, fields int"))
    dealt = rows.repartitionByRange(ranges, "gram", "id") if ranges else rows.repartitionByRange("gram", "id")
    dealt.sortWithinPartitions("gram", "id").write.option("parquet.block.size", 4 << 20).parquet(path)


def candidates(spark: SparkSession, path: str, words: list[str]) -> DataFrame | None:
    """id, bound: records that may have every word, and the most they can score; null if no word is long enough for the index.

    Words shorter than three bytes may be anywhere, so they only add to the bound.
    """
    sets = {w: sorted(grams_of(w)) for w in dict.fromkeys(words)}
    long = {w: g for w, g in sets.items() if g}
    if not long:
        return None
    # equalities, not a set: Spark pushes a set of more than ten down as its range alone
    wanted = functools.reduce(lambda a, b: a | b, [F.col("gram") == g for g in sorted(set().union(*long.values()))])
    found = spark.read.parquet(path).filter(wanted)
    has = lambda grams, bit: F.count_if(F.col("gram").isin(*grams) & (F.col("fields").bitwiseAND(bit) != 0)) == len(grams)
    worth = []
    for k, (w, grams) in enumerate(long.items()):
        best = F.lit(0)
        for _, bit, points in reversed(_FIELDS):
            best = F.when(has(grams, bit), points).otherwise(best)
        worth.append(best.alias(f"w{k}"))
    per = found.groupBy("id").agg(*worth)
    for k in range(len(worth)):
        per = per.filter(F.col(f"w{k}") > 0)
    times = {w: words.count(w) for w in long}
    bound = sum((F.col(f"w{k}") * times[w] for k, w in enumerate(long)), F.lit(_PHRASE + sum(10 for w in words if w not in long)))
    return per.select("id", bound.alias("bound"))


def search_indexed(records: DataFrame, path: str, query: str, limit: int, title: Column, extra: Column, summary: Column, date: str, id_col: str) -> DataFrame:
    """``archive.search`` by the index: the same rows in the same order.

    ``records`` are those that may be found (filters apply before); the index may have
    more.  The best bounds are verified first; what can't reach the last of the best
    ``limit`` scores is never looked at.
    """
    spark = records.sparkSession
    words = query.lower().split()
    if not words or not 1 <= limit <= 200:
        return search(records, query, limit, title, extra, summary, date, id_col)
    phrase = " ".join(words)
    score = search_score(words, phrase, F.lower(title), F.lower(extra), F.lower(summary))
    scored = lambda rows: rows.withColumn("score", score).filter("score > 0")
    best = lambda rows: rows.orderBy(F.desc("score"), F.desc(date), id_col).limit(limit)
    may = candidates(spark, path, words)
    if may is None:
        return best(scored(records))
    may = written(may.join(records.select(F.col(id_col).alias("id")), "id", "left_semi"))
    with_bound = lambda chosen: records.join(chosen.withColumnRenamed("id", id_col), id_col).drop("bound")
    first = may.orderBy(F.desc("bound"), "id").limit(4 * limit)  # at most so many rows
    reached = best(scored(with_bound(first))).agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
    least = reached.least if reached.n == limit else 1
    return best(scored(with_bound(may.filter(F.col("bound") >= least))))
