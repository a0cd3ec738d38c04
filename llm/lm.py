"""Language-model scores by deleted interpolation of word n-grams.

Counting and looking up never build a table of the vocabulary anywhere.  Each task packs
the texts it reads into chunks, rows of a bounded number of bytes, and these are written
once.  A chunk asks for each n-gram it has once, whatever its frequency: it sends the
sorted numbers of its distinct n-grams with their counts, as bytes.  Counting tasks each
own a slice of the number space; they add up the chunks' counts and answer each chunk with
the totals in the order in which it asked.  So what is shuffled is one number and one small
count an n-gram and chunk, frequent n-grams are combined before the shuffle, and no key is
hot.  A chunk sends at most ``most_slices`` rows a level, so rows grow with the input and
not with its square; slices that outgrow a task's memory are counted part by part.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.frames import cut, table, texts
from llm.words import blocks_of, combine, mix64, word_numbers

_END = np.uint64(0x243F6A8885A308D3)


@dataclass(frozen=True)
class Interpolation:
    """Parameters of the model: an order of 2 mixes bigrams, unigrams and a uniform share."""

    chunk_bytes: int = 4_000_000
    held_out_every: int = 16  # one training text in so many gives the held-out counts for the mixture weights
    rounds: int = 25  # of expectation-maximisation
    steps: int = 4  # grid points an octave for the held-out probabilities that EM sees
    slice_bytes: int = 16_000_000  # of text a slice stands for; about 2,000,000 n-grams that a counting task holds at once
    most_slices: int = 1_024  # rows a chunk sends at most; beyond, a counting task takes several slices, one after another


def _grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in turn: unigram numbers, each with its text's end appended, bigram numbers, and offsets by text.

    A text's first bigram has the end of a text as its context.
    """
    numbers, first = word_numbers(column)
    n = len(first) - 1
    uni = np.insert(numbers, first[1:], _END)
    first = first + np.arange(n + 1)
    before = np.empty_like(uni)
    before[1:] = uni[:-1]
    before[first[:-1]] = _END
    return uni, combine(before, uni), first


def pack_sorted(numbers: np.ndarray) -> bytes:
    """Ascending numbers as differences, each of as many bytes as the largest takes."""
    if not len(numbers):
        return b""
    steps = np.diff(numbers, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    out = np.zeros(((len(data) - 1) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(out.reshape(-1).view("<u8"), dtype=np.uint64)


def counts_bytes(counts: np.ndarray) -> bytes:
    """Small counts take a byte each; larger ones are listed behind, by place."""
    small = np.minimum(counts, 255).astype(np.uint8)
    big = np.flatnonzero(counts >= 255)
    return len(counts).to_bytes(8, "little") + small.tobytes() + big.astype("<u8").tobytes() + counts[big].astype("<u8").tobytes()


def counts_of(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    out = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    rest = np.frombuffer(data[8 + n :], "<u8")
    out[rest[: len(rest) // 2].astype(np.int64)] = rest[len(rest) // 2 :].astype(np.int64)
    return out


#: Bits of a number that are sent besides its slice, which holds its highest ones.
_BITS = {1: 64, 2: 48}


def _edges(n: int) -> list[int]:
    """Lower bounds of n equal slices of the number space."""
    return [(s << 64) // n for s in range(n)]


def _within(level: int, n: int) -> int:
    """By how many bits a number's place within one of n slices is shifted to fit what is sent."""
    return max(0, ((1 << 64) // n).bit_length() - _BITS[level])


def _distinct(numbers: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers, each one's training count, and the place of each input."""
    u, inverse = np.unique(numbers, return_inverse=True)
    return u, np.bincount(inverse[train], minlength=len(u)), inverse


_CHUNKS = "chunk long, n_bytes long, n_train long, doc_ids array<long>, train array<boolean>, sizes array<int>, packed binary"


def formed(df: DataFrame, how: Interpolation, id_col: str, text_col: str, train: Callable[[str], object]) -> DataFrame:
    """The texts as rows of about ``chunk_bytes``, compressed; odd chunk numbers hold held-out training texts only.

    Rows stay in the task that read them.  Texts are held out by a hash of identifier
    and text, so repeated rows go together.
    """
    docs = texts(df, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("train", train("doc_id"))
    docs = docs.withColumn("dev", F.col("train") & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(how.held_out_every)) == 0))
    most = how.chunk_bytes

    def row(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        column = t.column("text").cast(pa.large_string()).combine_chunks()
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
        sizes, data = np.diff(offsets), column.buffers()[2]
        data = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if data is not None else pa.py_buffer(b"")
        packed = pa.compress(data, codec="zstd", asbytes=True)
        learned = t.column("train").combine_chunks()
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        cols = [pa.array([number]), pa.array([data.size]), pa.array([learned.true_count]), pa.ListArray.from_arrays([0, t.num_rows], t.column("doc_id").combine_chunks())]
        cols += [pa.ListArray.from_arrays([0, t.num_rows], learned), one(sizes.astype(np.int32), pa.int32()), pa.array([packed], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["chunk", "n_bytes", "n_train", "doc_ids", "train", "sizes", "packed"])

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << 32, 0
        open_: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}
        size = {False: 0, True: 0}
        for batch in batches:
            for dev in (False, True):
                for block in blocks_of(batch.filter(batch.column("dev") if dev else pc.invert(batch.column("dev"))), most=min(most, 1 << 20)):
                    open_[dev].append(block)
                    size[dev] += block.column("text").nbytes
                    if size[dev] >= most:
                        yield row(open_[dev], task | made << 1 | dev)
                        open_[dev], size[dev], made = [], 0, made + 1
        for dev in (False, True):
            if open_[dev]:
                yield row(open_[dev], task | made << 1 | dev)
                made += 1

    return docs.mapInArrow(form, _CHUNKS)


class Chunk:
    """A chunk's texts as numbers: unigrams, bigrams, offsets by text, which tokens are trained, and each token's text."""

    def __init__(self, t: pa.Table | pa.RecordBatch, k: int):
        self.number = t.column("chunk")[k].as_py()
        self.doc_ids, self.train = t.column("doc_ids")[k].values, t.column("train")[k].values
        sizes = t.column("sizes")[k].values.to_numpy()
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        data = pa.decompress(t.column("packed")[k].as_buffer(), decompressed_size=int(offsets[-1]), codec="zstd") if offsets[-1] else pa.py_buffer(b"")
        column = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), data)
        self.uni, self.bi, self.first = _grams(column)
        lengths = np.diff(self.first)
        self.trained = np.repeat(self.train.to_numpy(zero_copy_only=False).astype(bool), lengths)
        self.doc = np.repeat(np.arange(len(sizes)), lengths)


def ask(chunks: DataFrame, n_slices: int) -> DataFrame:
    """level, slice, chunk, numbers, counts: what each chunk asks for, a row for each slice it has numbers of."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array(_edges(n_slices), dtype=np.uint64)
        for batch in batches:
            for k in range(batch.num_rows):
                c = Chunk(batch, k)
                for level, numbers in ((1, c.uni), (2, c.bi)):
                    u, counts, _ = _distinct(numbers, c.trained)
                    cuts = np.concatenate([np.searchsorted(u, edges), [len(u)]])
                    some = np.flatnonzero(np.diff(cuts))
                    shift = np.uint64(_within(level, n_slices))
                    sent = [pack_sorted((u[cuts[s] : cuts[s + 1]] - edges[s]) >> shift) for s in some]
                    back = [counts_bytes(counts[cuts[s] : cuts[s + 1]]) for s in some]
                    n = len(some)
                    cols = [pa.array(np.full(n, level, np.int32)), pa.array(some.astype(np.int64)), pa.array(np.full(n, c.number)), pa.array(sent, pa.binary()), pa.array(back, pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["level", "slice", "chunk", "numbers", "counts"])

    return chunks.mapInArrow(each, "level int, slice long, chunk long, numbers binary, counts binary")


def answer(asked: DataFrame, n_slices: int, parts: int) -> DataFrame:
    """level, slice, chunk, totals; and a row of chunk null with the slice's number of trained n-grams and their sum.

    A slice's numbers are dealt into ``parts`` by range and added up part by part; what
    waits, numbers and answers, lies in files of the task once it is more than a few
    megabytes.
    """

    def of_slice(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, s = key[0].as_py(), key[1].as_py()
        top = max(1, (((1 << 64) // n_slices) + 1) >> _within(level, n_slices))
        bounds = np.array([p * top // parts for p in range(1, parts)], dtype=np.uint64)
        spool = lambda: tempfile.SpooledTemporaryFile(max_size=(64 << 20) // parts)
        waiting, sizes, chunks = [spool() for _ in range(parts)], [], []
        for batch in batches:
            for k in range(batch.num_rows):
                numbers, counts = unpack_sorted(batch.column("numbers")[k].as_py()), counts_of(batch.column("counts")[k].as_py())
                cuts = [0, *np.searchsorted(numbers, bounds).tolist(), len(numbers)]
                for p in range(parts):
                    a, b = cuts[p], cuts[p + 1]
                    waiting[p].write(numbers[a:b].astype("<u8").tobytes())
                    waiting[p].write(counts[a:b].astype("<i8").tobytes())
                sizes.append(np.diff(cuts))
                chunks.append(batch.column("chunk")[k].as_py())
        types = tokens = 0
        answers = []
        for p in range(parts):
            waiting[p].seek(0)
            each = [x[p] for x in sizes]
            numbers, counts = [], []
            for n in each:
                numbers.append(np.frombuffer(waiting[p].read(8 * n), "<u8"))
                counts.append(np.frombuffer(waiting[p].read(8 * n), "<i8"))
            waiting[p].close()
            u, inverse = np.unique(np.concatenate(numbers), return_inverse=True)
            totals = np.zeros(len(u), dtype=np.int64)
            np.add.at(totals, inverse, np.concatenate(counts))
            types, tokens = types + int((totals > 0).sum()), tokens + int(totals.sum())
            answers.append(spool())
            answers[-1].write(totals[inverse].astype("<i8").tobytes())
            answers[-1].seek(0)
        schema = pa.schema([("level", pa.int32()), ("slice", pa.int64()), ("chunk", pa.int64()), ("totals", pa.binary()), ("types", pa.int64()), ("tokens", pa.int64())])
        for chunk, each in zip(chunks, sizes):
            totals = np.concatenate([np.frombuffer(f.read(8 * n), "<i8") for f, n in zip(answers, each)])
            yield pa.RecordBatch.from_pylist([{"level": level, "slice": s, "chunk": chunk, "totals": counts_bytes(totals), "types": None, "tokens": None}], schema=schema)
        for f in answers:
            f.close()
        yield pa.RecordBatch.from_pylist([{"level": level, "slice": s, "chunk": None, "totals": None, "types": types, "tokens": tokens}], schema=schema)

    return asked.groupBy("level", "slice").applyInArrow(of_slice, "level int, slice long, chunk long, totals binary, types long, tokens long")


def _looked_up(t: pa.Table, replies: pa.Table) -> tuple[Chunk, dict]:
    """A chunk with the counts of each token's unigram and bigram, and numbers that tell its n-grams apart."""
    c, out = Chunk(t, 0), {}
    levels, slices = replies.column("level").to_numpy(), replies.column("slice").to_numpy()
    for level, numbers, name in ((1, c.uni, "c1"), (2, c.bi, "c2")):
        u, _, inverse = _distinct(numbers, c.trained)
        mine = np.flatnonzero(levels == level)
        mine = mine[np.argsort(slices[mine])]
        totals = np.concatenate([counts_of(replies.column("totals")[int(k)].as_py()) for k in mine]) if len(mine) else np.zeros(0, np.int64)
        if len(totals) != len(u):
            raise ValueError(f"chunk {c.number} asked for {len(u)} n-grams and got {len(totals)} answers")
        out[name], out[f"{name}_key"] = totals[inverse], inverse
    out |= {"first": c.first, "doc": c.doc}
    return c, out


def _before(values: np.ndarray, first: np.ndarray, at_start: np.ndarray | float) -> np.ndarray:
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first[:-1]] = at_start
    return out


def _own_counts(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How often each token's n-gram is in its own text."""
    both = mix64(key.astype(np.uint64) + (doc.astype(np.uint64) << np.uint64(40)))
    _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
    return counts[inverse]


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else one more than the whole part of the count's binary logarithm."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))).astype(np.int64) + 1, 0)


N_BUCKETS = 64
#: On the grid of logarithms, a probability of zero.
_ZERO = 1 << 20


def held_out_grid(found: DataFrame) -> list:
    """The bounded grid of held-out probabilities: context bucket, and the two estimates' logarithms on fixed steps."""
    return found.groupBy("bucket", "g2", "g1").agg(F.sum("n").alias("n")).collect()


def mixture_weights(rows: list, types: int, how: Interpolation) -> np.ndarray:
    """Weights of bigram, unigram and uniform share for each bucket, by expectation-maximisation on held-out counts."""
    weights = np.tile([0.4, 0.5, 0.1], (N_BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    if not rows:
        return weights
    b = np.array([r.bucket for r in rows])
    n = np.array([float(r.n) for r in rows])
    value = lambda g: np.where(g == _ZERO, 0.0, np.exp2(np.minimum(g, 0) / how.steps))
    p = np.stack([value(np.array([r.g2 for r in rows])), value(np.array([r.g1 for r in rows])), np.full(len(rows), 1.0 / (types + 1))], axis=1)
    for _ in range(how.rounds):
        part = weights[b] * p
        part *= (n / part.sum(1))[:, None]
        sums = np.stack([np.bincount(b, weights=part[:, j], minlength=N_BUCKETS) for j in range(3)], axis=1)
        # a bucket without much evidence stays near its neighbour below
        for k in range(N_BUCKETS):
            prior = weights[k - 1] if k > 1 else weights[k]
            mass = sums[k] + 5.0 * prior
            if k == 0:
                mass[0] = 0.0
            mass[2] = max(mass[2], 1e-6 * mass.sum())
            weights[k] = mass / mass.sum()
    return weights


def _probabilities(f: dict, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context count, bigram estimate and unigram estimate of each token."""
    context = _before(f["c1"], f["first"], f["ends"])
    p2 = np.where(context > 0, f["c2"] / np.maximum(context, 1), 0.0)
    return context, p2, f["c1"] / max(tokens, 1)


def score_language(df: DataFrame, how: Interpolation = Interpolation(), id_col: str = "doc_id", text_col: str = "text", train: Callable[[str], object] | None = None) -> DataFrame:
    """One row for each row of ``df``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` makes a condition from the identifier's column name: texts to learn from.
    Tokens are words, A-Z lower-cased, then one end.  ``score`` is log10 of the text's
    probability: each token's bigram estimate, unigram estimate and a uniform share
    over the trained vocabulary and one unknown word are mixed by weights that depend
    on how frequent the context is.  The weights are learned by expectation-
    maximisation on held-out counts: one training text in ``held_out_every`` is
    deleted, by itself, from the counts with which its tokens are predicted.

    A null text counts as empty: it has the end alone.  Rows with a null identifier are
    scored but not learned from.  Repeated rows count and are scored each.  An empty
    table gives an empty table.  Only the two named columns are read.
    """
    train = train or learned_from
    chunks = cut(formed(df, how, id_col, text_col, train))
    n_bytes, ends = (int(x or 0) for x in chunks.agg(F.sum("n_bytes"), F.sum("n_train")).first())  # each training text has one end
    slices = max(1, -(-n_bytes // how.slice_bytes))
    n_slices = min(slices, how.most_slices)
    answers = cut(answer(ask(chunks, n_slices), n_slices, -(-slices // n_slices)))
    types, tokens = (int(x or 0) for x in answers.filter("chunk is null and level = 1").agg(F.sum("types"), F.sum("tokens")).first())
    replies = answers.filter("chunk is not null").select("chunk", "level", "slice", "totals")
    steps = how.steps

    def events(t: pa.Table, r: pa.Table) -> pa.Table:
        schema = pa.schema([("bucket", pa.int64()), ("g2", pa.int64()), ("g1", pa.int64()), ("n", pa.int64())])
        if t.num_rows == 0:
            return schema.empty_table()
        _, f = _looked_up(t, r)
        lengths = np.diff(f["first"])
        own1, own2 = _own_counts(f["c1_key"], f["doc"]), _own_counts(f["c2_key"], f["doc"])
        f["c1"], f["c2"], f["ends"] = f["c1"] - own1, f["c2"] - own2, ends - 1
        context, p2, _ = _probabilities(f, tokens)
        p1 = f["c1"] / np.maximum(tokens - lengths[f["doc"]], 1)
        grid = lambda p: np.where(p > 0, np.rint(np.log2(np.where(p > 0, p, 1.0)) * steps).astype(np.int64), _ZERO)
        u, n = np.unique(np.stack([_bucket(context), grid(p2), grid(p1)], axis=1), axis=0, return_counts=True)
        return pa.table([pa.array(u[:, 0]), pa.array(u[:, 1]), pa.array(u[:, 2]), pa.array(n.astype(np.int64))], schema=schema)

    dev = F.col("chunk") % 2 == 1
    found = chunks.filter(dev).groupBy("chunk").cogroup(replies.filter(dev).groupBy("chunk")).applyInArrow(events, "bucket long, g2 long, g1 long, n long")
    weights = mixture_weights(held_out_grid(found), types, how)

    def scores(t: pa.Table, r: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        if t.num_rows == 0:
            return schema.empty_table()
        c, f = _looked_up(t, r)
        f["ends"] = ends
        context, p2, p1 = _probabilities(f, tokens)
        lam = weights[_bucket(context)]
        p = lam[:, 0] * p2 + lam[:, 1] * p1 + lam[:, 2] / (types + 1)
        base = np.log10((f["c1"] + 0.5) / (tokens + 0.5 * (types + 1)))
        add = lambda x: np.add.reduceat(x, f["first"][:-1])
        cols = [c.doc_ids, c.train, pa.array(np.diff(f["first"])), pa.array(add((f["c1"] > 0).astype(np.int64))), pa.array(add(base)), pa.array(add(np.log10(p)))]
        return pa.table(cols, schema=schema)

    out = chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(scores, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def learned_from(doc_id: str = "doc_id"):
    """crc32 of the identifier as text doesn't leave 1 when divided by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 != 1, F.lit(False))


def op4_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language(table(spark, sf_dir, "documents"))
