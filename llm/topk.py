"""Exact top-k by a bit-sliced index.

Each attribute of a block of rows is a stack of bitmaps, one for each binary digit.  A
query adds the slices of all attributes, shifted by its own digits, with bitmap full
adders; the sums are again a stack of bitmaps.  Walking that stack from the most
significant slice down splits the rows into those surely above and those still tied;
what is left at the bottom is a tie, resolved by identifier.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.frames import cut, table, whole_id

_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


class BitSlices:
    """The index of one block: rows in order of identifier."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, rows: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order].astype(np.int64)
        self.rows = self.ids if rows is None else rows[order]
        n, self.dims = self.values.shape
        self.words = (n + 63) // 64
        self.low = self.values.min(0) if n else np.zeros(self.dims, np.int64)
        self.valid = self._pack(np.ones(n, dtype=bool))
        shifted = self.values - self.low
        self.slices = []
        for d in range(self.dims):
            bits = int(shifted[:, d].max(initial=0)).bit_length()
            self.slices.append([self._pack((shifted[:, d] >> k) & 1 == 1) for k in range(bits)])
        self.inverted = [[s ^ _ONES for s in stack] for stack in self.slices]

    def _pack(self, flags: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, dtype=np.uint8)
        padded[: len(flags)] = flags
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of a number that orders rows as their inner product with the query does.

        A negative coefficient adds the inverted slices, which differ by a constant.
        """
        columns: list[list[np.ndarray]] = []
        for d, q in enumerate(query.tolist()):
            stack = self.slices[d] if q > 0 else self.inverted[d]
            size, j = abs(q), 0
            while size:
                if size & 1:
                    for k, s in enumerate(stack):
                        while len(columns) <= j + k:
                            columns.append([])
                        columns[j + k].append(s)
                size >>= 1
                j += 1
        out, w = [], 0
        while w < len(columns):
            column = columns[w]
            while len(column) > 1:
                if w + 1 == len(columns):
                    columns.append([])
                if len(column) == 2:
                    a, b = column.pop(), column.pop()
                    columns[w + 1].append(a & b)
                    column.append(a ^ b)
                else:
                    a, b, c = column.pop(), column.pop(), column.pop()
                    half = a ^ b
                    carry = half & c
                    carry |= a & b
                    columns[w + 1].append(carry)
                    half ^= c
                    column.insert(0, half)
            out.append(column[0] if column else np.zeros(self.words, np.uint64))
            w += 1
        return out

    def top(self, query: np.ndarray, k: int, own: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores (what is above 62 bits, and those) and identifiers of the k best rows, ties to smaller identifiers; row ``own`` is left out."""
        among = self.valid
        if own is not None:
            flags = self.rows == own
            if flags.any():
                among = among & ~self._pack(flags)
        above, tied = np.zeros(self.words, np.uint64), among
        for s in reversed(self.sums(query)):
            higher = tied & s
            n = int(np.bitwise_count(above | higher).sum())
            if n > k:
                tied = higher
            else:
                above = above | higher
                tied = tied & ~s
                if n == k:
                    tied = np.zeros_like(tied)
                    break
        rows = self._rows(above)
        rest = self._rows(tied)[: k - len(rows)]
        rows = np.concatenate([rows, rest])
        high, low = _products(self.values[rows], query)
        order = np.lexsort((self.ids[rows], -low, -high))
        return high[order], low[order], self.ids[rows][order]

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


#: Quantised components beyond this are held to it: from here on doubles skip integers.
LARGEST = 1 << 53
#: Scores go on as two numbers, of 62 bits and of what is above, so that none overflows.
_LOW = 62


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """row, vec_id and q, the vector's floor(scale * x) as integers; rows that can take no part are left out."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    held = lambda v: F.greatest(F.least(v * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
    q = F.transform(x, lambda v: F.floor(held(v)).cast("long"))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(ok)
    return rows.select(F.monotonically_increasing_id().alias("row"), whole_id(df, id_col).alias("vec_id"), q.alias("q"))


def _matrix(q: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows, shorter ones padded with zeros."""
    if isinstance(q, pa.ChunkedArray):
        q = q.combine_chunks()
    out = np.zeros((len(q), dims), dtype=np.int64)
    lengths = np.diff(q.offsets.to_numpy())
    flat = q.flatten().to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(q)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _products(values: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products, exact whatever their size: what is above the lowest 62 bits, and those."""
    if values.size and len(query) * int(np.abs(values).max()) * int(np.abs(query).max()) >= 1 << _LOW:
        s = values.astype(object) @ query.astype(object)
        return np.array([int(x) >> _LOW for x in s], dtype=np.int64), np.array([int(x) & ((1 << _LOW) - 1) for x in s], dtype=np.int64)
    s = values @ query
    return s >> _LOW, s & ((1 << _LOW) - 1)


class Best:
    """The k best rows so far of each of many queries; ties to smaller identifiers."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.found: list[tuple[np.ndarray, ...]] = [tuple(np.zeros(0, np.int64) for _ in range(3))] * queries

    def add(self, j: int, high: np.ndarray, low: np.ndarray, ids: np.ndarray) -> None:
        high, low, ids = (np.concatenate([a, b]) for a, b in zip(self.found[j], (high, low, ids)))
        order = np.lexsort((ids, -low, -high))[: self.k]
        self.found[j] = (high[order], low[order], ids[order])


#: Rounds of queries that run side by side.
ROUNDS_AT_ONCE = 8


def exact_top_k(
    df: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding",
    block_rows: int = 32_768, round_bytes: int = 16_000_000,
) -> DataFrame:
    """The k best rows of each query: query_id, rank, vec_id, score.

    Queries are the rows whose identifier is divisible by ``every``; candidates are all
    rows but the query's own, so a repeated row is a candidate, and a query, as often as
    it is there.  Rows without identifier, null vectors and vectors with null or
    non-finite components take no part; a missing component counts as zero.  An empty
    table gives an empty table.  Other columns are not read.

    Finite components whose quantised value is beyond 2**53 count as that much.  Scores
    are added up and ranked exactly; one beyond a long is given as the largest or
    smallest long.

    Rows stay where they are: a task indexes those it reads, ``block_rows`` at a time,
    and asks its index.  Queries are sent to all tasks in rounds of at most
    ``round_bytes`` of vectors and answers, ``ROUNDS_AT_ONCE`` rounds at a time at most,
    so neither the driver nor a task holds more, however many there are; of each task
    and round only the k best rows a query go on.
    """
    spark = df.sparkSession
    rows = cut(quantised(df, id_col, vector_col, scale))
    n, dims = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    dims, blocks = max(1, dims or 1), max(1, -(-n // block_rows))
    asked = cut(rows.filter(F.col("vec_id") % every == 0))
    queries = asked.count()
    # asking a block costs about as much for few rows as for many, so a small table is few blocks and parallel by queries
    at_once = max(1, min(ROUNDS_AT_ONCE, -(-spark.sparkContext.defaultParallelism // blocks), queries))
    rounds = max(at_once, -(-queries // max(1, round_bytes // (8 * dims + 64 * k))))
    asked = asked.withColumn("round", F.pmod(F.xxhash64("row"), F.lit(rounds)))

    def found(number: int) -> DataFrame:
        t = asked.filter(F.col("round") == number).select("row", "vec_id", "q").toArrow()  # about ``round_bytes``
        sent = spark.sparkContext.broadcast((t.column("row").to_numpy(), t.column("vec_id").to_numpy(), _matrix(t.column("q"), dims)))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, _, queries = sent.value
            best, waiting, n = Best(len(own), k), [], 0

            def ask() -> None:
                t = pa.Table.from_batches(waiting)
                index = BitSlices(t.column("vec_id").to_numpy(), _matrix(t.column("q"), dims), t.column("row").to_numpy())
                for j in range(len(own)):
                    best.add(j, *index.top(queries[j], k, int(own[j])))

            for batch in batches:
                for at in range(0, batch.num_rows, block_rows):
                    part = batch.slice(at, block_rows)
                    if n + part.num_rows > block_rows:
                        ask()
                        waiting, n = [], 0
                    waiting.append(part)
                    n += part.num_rows
            if n:
                ask()
            counts = np.array([len(f[0]) for f in best.found], dtype=np.int64)
            cols = [pa.array(np.repeat(own, counts))] + [pa.array(np.concatenate([np.zeros(0, np.int64), *(f[i] for f in best.found)])) for i in range(3)]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "high", "low", "vec_id"])

        return rows.coalesce(blocks).mapInArrow(search, "row long, high long, low long, vec_id long")

    every_part = None
    for first in range(0, rounds, at_once):
        part = cut(reduce(DataFrame.unionByName, (found(number) for number in range(first, min(first + at_once, rounds)))))
        every_part = part if every_part is None else every_part.unionByName(part)
    w = Window.partitionBy("row").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    ranked = every_part.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    score = F.when(F.col("high") > 1, F.lit((1 << 63) - 1)).when(F.col("high") < -2, F.lit(-(1 << 63))).otherwise(F.shiftleft("high", _LOW) + F.col("low"))
    return ranked.join(asked.select("row", F.col("vec_id").alias("query_id")), "row").select("query_id", "rank", "vec_id", score.alias("score"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


#: The same rows by plain sorting.
ORACLE_OP6 = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL
), p AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 20 = 0
), o AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 20
"""
