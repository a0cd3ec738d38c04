"""How five filters interact: what each removes, alone and after the others, in every order.

One pass over the Arrow buffers gives each text a mask of the filters it fails: byte
classes and their prefix sums count words, capitals, code points and symbols, and
distinct words are counted from a text's sorted word hashes, equal ones verified byte by
byte.  All figures of all orders follow from the counts of masks, so texts never leave
their partition and no order is ever run.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.frames import map_texts, table, whole_id
from llm.words import _bytes_of, same_bytes, stretches

LETTERS = "ABCDE"


@dataclass(frozen=True)
class FilterRules:
    """A text fails A with fewer than ``least_words`` words, B with fewer than ``distinct_percent`` distinct words a hundred, C with more than
    ``capital_percent`` capitals A-Z per hundred code points, D if it holds one of ``symbols``, and E if a smaller identifier has the same text."""

    least_words: int = 200
    distinct_percent: int = 50
    capital_percent: int = 3
    symbols: bytes = b"#$%&*|"


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each text's number of distinct words: its hashes are sorted, and neighbours with equal hashes are compared byte by byte.

    Where two different words share a hash, the text's words are counted as strings.
    """
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, text))
    a, b = order[:-1], order[1:]
    pairs = np.flatnonzero((hashes[a] == hashes[b]) & (text[a] == text[b]))
    a, b = a[pairs], b[pairs]
    length = ends[a] - starts[a]
    same = length == ends[b] - starts[b]
    same[same] = same_bytes(data, starts[a[same]], starts[b[same]], length[same])
    out = np.diff(first) - np.bincount(text[a], minlength=n)
    for t in np.unique(text[a[~same]]).tolist():
        out[t] = len({data[starts[k] : ends[k]].tobytes() for k in range(first[t], first[t + 1])})
    return out


def failures(column: pa.Array, rules: FilterRules = FilterRules()) -> np.ndarray:
    """Which of A to D each text fails, as bits 0 to 3; a null text counts as empty."""
    data, offsets = _bytes_of(column)
    n = len(offsets) - 1
    classes = np.zeros((3, 256), dtype=bool)
    classes[0, 65:91] = True
    classes[1, list(rules.symbols)] = True
    classes[2] = (np.arange(256) & 0xC0) != 0x80
    counts = np.zeros((3, n), dtype=np.int64)  # capitals, symbols, code points
    words = np.zeros(n, dtype=np.int64)
    spans: list[tuple[np.ndarray, ...]] = []
    for at, low, w in stretches(data, offsets, fold=False):
        to = at + len(w.first) - 1
        for k in range(3):
            sums = np.concatenate([[0], np.cumsum(classes[k][w.data], dtype=np.int64)])
            counts[k, at:to] += np.diff(sums[w.offsets])
        words[at:to] += np.diff(w.first)
        spans.append((w.starts + low, w.ends + low, w.hashes))
    starts, ends, hashes = (np.concatenate(x) for x in zip(*spans)) if spans else (np.zeros(0, np.int64),) * 3
    distinct = distinct_words(data, starts, ends, hashes, np.concatenate([[0], np.cumsum(words)]))
    capitals, symbols, points = counts
    fails = (words < rules.least_words, 100 * distinct < rules.distinct_percent * words, 100 * capitals > rules.capital_percent * points, symbols > 0)
    return np.bitwise_or.reduce([f.astype(np.int32) << k for k, f in enumerate(fails)]) if n else np.zeros(0, np.int32)


def _digests(column: pa.Array) -> list[bytes]:
    data, offsets = _bytes_of(column)
    raw = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(raw[offsets[k] : offsets[k + 1]]).digest() for k in range(len(offsets) - 1)]


def failure_masks(df: DataFrame, labels: DataFrame, rules: FilterRules = FilterRules(), id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, mask, good, toxic, n: how many rows of each part fail exactly the filters of the mask (bit 0 is A), by label.

    Texts are the same if their SHA-256 is.  Rows of one text are combined before the
    shuffle, so a text that a third of all rows have is a few rows a task.  A row
    fails E if its identifier is larger than the smallest of its text: rows that
    repeat the smallest don't fail, and a null identifier neither fails nor makes
    others fail.  Labels are joined by identifier, null ones spread by text.
    """

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        text = block.column("text")
        return pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("part"), pa.array(failures(text, rules), pa.int32()), pa.array(_digests(text), pa.binary())], names=["doc_id", "part", "mask", "digest"])

    given = df.select(whole_id(df, id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
    facts = map_texts(given, of_block, "doc_id long, part string, mask int, digest binary")
    facts = facts.withColumn("salt", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long")))
    marks = labels.select(whole_id(labels, "doc_id").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).filter("doc_id is not null")
    marks = marks.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")).withColumn("salt", F.lit(0).cast("long"))
    facts = facts.join(marks, ["doc_id", "salt"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    same = ["digest", "part", "mask", "good", "toxic"]
    rows = facts.groupBy("doc_id", "salt", *same).agg(F.count("*").alias("n"))
    known = F.col("doc_id").isNotNull()
    rows = rows.groupBy(*same).agg(F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("known"), F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    again = F.col("known") - F.when(F.col("first.doc_id") == least, F.col("first.n")).otherwise(0)
    rows = rows.withColumn("again", again).select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("mask"), (F.col("n") - F.col("again")).alias("n")), F.struct(F.col("mask").bitwiseOR(16).alias("mask"), F.col("again").alias("n")))).alias("x"))
    return rows.groupBy("part", "x.mask", "good", "toxic").agg(F.sum("x.n").alias("n"))


def audit_orders(masks: DataFrame) -> DataFrame:
    """The figures of every part, order and step, from the counts of masks.

    A step depends on its filter and on the set of filters before it, so 80 cells a
    part hold all figures; the 600 rows of orders and steps, a fixed number, pick theirs.
    """
    cells = masks.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(159)))).withColumn("filter", F.expr("cell div 32").cast("int")).withColumn("before", (F.col("cell") % 32).cast("int"))
    cells = cells.withColumn("bit", F.expr("shiftleft(1, filter)")).filter("before & bit = 0")
    count = lambda when: F.sum(F.when(F.expr(when), F.col("n")).otherwise(0))
    removed = "mask & bit <> 0 and mask & before = 0"
    cells = cells.groupBy("part", "filter", "before").agg(
        count("mask & (before | bit) = 0").alias("kept"), count(removed).alias("removed"), count("mask & bit <> 0 and mask & before <> 0").alias("redundant"),
        count("mask = bit").alias("unique_fails"), count(f"{removed} and good").alias("good_lost"), count(f"{removed} and toxic").alias("toxic_lost"),
    )
    times = F.element_at(F.array(*[F.lit(factorial(k) * factorial(4 - k)) for k in range(5)]), F.bit_count("before") + 1)  # orders in which just these filters come before
    cells = cells.withColumn("shapley", F.sum(F.col("removed") * times).over(Window.partitionBy("part", "filter")))
    steps = [("".join(LETTERS[f] for f in order), k + 1, order[k], sum(1 << f for f in order[:k])) for order in permutations(range(5)) for k in range(5)]
    orders = masks.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, before int")
    figures = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return cells.join(F.broadcast(orders), ["filter", "before"]).select("part", "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in figures])


def audit_filters(df: DataFrame, labels: DataFrame, rules: FilterRules = FilterRules(), id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """part, filter_order, step and the counts of rows at each step, for the 120 orders of five filters.

    A null text counts as empty: it fails A and, where a smaller identifier has no text
    either, E.  A null part is the empty string.  A row's labels are those of its
    identifier, the highest of several; null or missing ones count as neither.
    Repeated rows count each.  Very long texts are read in stretches.  An empty table
    gives an empty table.  Only the named columns are read, so others may have any name.
    """
    return audit_orders(failure_masks(df, labels, rules, id_col, text_col, part_col))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_OP11 = r"""
with words as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
judged as (
  select doc_id, part,
    (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * (doc_id > min(doc_id) over (partition by t))::int as mask
  from words),
marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
masks as (
  select part, mask, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, count(*) as n
  from judged left join marks using (doc_id) group by all),
letters as (select unnest([0, 1, 2, 3, 4]) as f),
orders as (
  select [a.f, b.f, c.f, d.f, e.f] as o, chr(65 + a.f) || chr(65 + b.f) || chr(65 + c.f) || chr(65 + d.f) || chr(65 + e.f) as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps as (
  select filter_order, s.step, 1 << o[s.step] as bit, coalesce(list_sum(list_transform(o[1:s.step - 1], lambda x: 1 << x)), 0)::int as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step) s),
figures as (
  select part, filter_order, step, bit,
    sum(case when mask & (before | bit) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & bit <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
    sum(case when mask & bit <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when mask & bit <> 0 and mask & before = 0 and good = 1 then n else 0 end)::bigint as good_lost,
    sum(case when mask & bit <> 0 and mask & before = 0 and toxic = 1 then n else 0 end)::bigint as toxic_lost
  from masks, steps group by part, filter_order, step, bit)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) over (partition by part, bit)::bigint as shapley
from figures
"""
