"""Packing token sequences into as few fixed windows as possible.

Lengths are at most the window, so how many pieces have which length is a table of fixed
size.  The plan is made on that table alone:

1. Large lengths are put in groups of about equal numbers of pieces (linear grouping) and
   rounded up to their group's longest.
2. The few sizes left are packed by configurations: a linear programme over ways of
   filling a window, its columns generated by a knapsack; the whole part of its solution
   is taken and the rest packed greedily.
3. Actual pieces take the slots of their group, longest first, so windows gain the room
   that rounding up had set aside.
4. Small pieces go, longest first, into the windows with the least room that holds them.

A plan is a list of runs: so many windows, each with the same lengths.  Pieces get their
rank among those of their length, and the rank gives window and offset.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.frames import cut, map_texts, table, texts
from llm.wordpieces import WordPieces


@dataclass(frozen=True)
class Packing:
    window: int = 4096
    large: tuple[int, ...] = (512, 1024, 1365)  # lengths above take part in the configurations; the thresholds are tried in turn
    groups: int = 128  # sizes left by linear grouping
    least_group: int = 4  # pieces a group has, about; fewer pieces make fewer groups
    gap: float = 1e-3  # pricing ends when a fractional plan needs at most so much more than the fewest windows
    most_columns: int = 10_000  # configurations priced in one go; the plan is whole, if less tight, wherever pricing ends
    rank_rows: int = 2_000  # pieces of a length that one ranking group takes, about
    vocabulary: str = "word_bpe_49k.json"
    end: int = 1  # the identifier after each text
    vocabulary_path: str | None = None


# --- the plan -------------------------------------------------------------------------


def linear_groups(counts: np.ndarray, large: int, groups: int) -> list[list[int]]:
    """Lengths above ``large``, longest first, in groups of about equal numbers of pieces."""
    sizes = [int(x) for x in np.flatnonzero(counts) if x > large][::-1]
    total = sum(int(counts[x]) for x in sizes)
    out: list[list[int]] = []
    seen = 0
    for x in sizes:
        if not out or seen >= len(out) * total / groups:
            out.append([])
        out[-1].append(x)
        seen += int(counts[x])
    return out


def _best_column(sizes: np.ndarray, values: np.ndarray, window: int) -> tuple[np.ndarray, float]:
    """The most valuable way of filling a window: an unbounded knapsack, a stretch of capacities as wide as the smallest size at a time."""
    some = np.flatnonzero(values > 0)
    if not len(some):
        return np.zeros(len(sizes), dtype=np.int64), 0.0
    sizes_, values_ = sizes[some], values[some]
    widest, least = int(sizes_.max()), int(sizes_.min())
    best = np.full(widest + window + 1, -np.inf)  # shifted, so that capacities below 0 are there, without a way of filling them
    best[widest : widest + least] = 0.0
    last = np.full(window + 1, -1)
    for start in range(least, window + 1, least):
        to = min(start + least, window + 1)
        ways = best[np.arange(start, to) + (widest - sizes_)[:, None]] + values_[:, None]
        pick = ways.argmax(0)
        best[widest + start : widest + to] = ways[pick, np.arange(to - start)]
        last[start:to] = pick
    out, room = np.zeros(len(sizes), dtype=np.int64), window
    while room >= least:
        out[some[last[room]]] += 1
        room -= int(sizes_[last[room]])
    return out, float(best[widest + window])


def configurations(sizes: np.ndarray, demand: np.ndarray, window: int, most: int = 10_000, gap: float = 1e-3) -> list[tuple[np.ndarray, float]]:
    """Ways of filling windows with rounded sizes, and how many windows of each a fractional optimum has, by column generation."""
    k = len(sizes)
    if not k:
        return []
    basis = np.diag(window // sizes).astype(float)
    inverse, level = np.linalg.inv(basis), demand / np.diag(basis)
    for turn in range(most):
        column, value = _best_column(sizes, inverse.sum(0), window)
        if value <= 1 + gap:  # no fractional plan needs fewer windows than this one's over ``value``
            break
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, np.maximum(level, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = column
        pivot = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, pivot)
        inverse[leave] = pivot
        if turn % 64 == 63:  # rounding errors of the updates don't add up
            inverse = np.linalg.inv(basis)
        level = inverse @ demand
    return [(basis[:, j].round().astype(np.int64), float(level[j])) for j in range(k) if level[j] > 1e-9]


def whole_windows(columns: list[tuple[np.ndarray, float]], demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of windows for fractional ones: the whole parts, and where these are none, one of each column that is still in demand, the largest fraction first."""
    left, out = demand.astype(np.int64).copy(), []
    ordered = sorted(columns, key=lambda c: (c[1] - np.floor(c[1] + 1e-9), c[1], c[0].tolist()), reverse=True)
    for part in (lambda level: int(np.floor(level + 1e-9)), lambda level: 1):
        for column, level in ordered:
            used = column > 0
            n = min(part(level), int((left[used] // column[used]).min()))
            if n > 0:
                left -= n * column
                out.append((column, n))
        if out:
            break
    return out


def _fill(runs: dict[int, list[list]], length: int, count: int, window: int) -> None:
    """Best fit of ``count`` pieces of one length: tightest windows first, as many in each as it holds.

    ``runs``: by room left, lists of [number of windows, lengths].
    """
    rooms = sorted(r for r in runs if r >= length and runs[r])
    for room in rooms:
        fit = room // length
        while runs[room] and count:
            number, lengths = runs[room].pop()
            full = min(number, count // fit)
            if full:
                runs[room - fit * length].append([full, [*lengths, *[length] * fit]])
                count -= full * fit
                number -= full
            if number and count and count < fit:
                runs[room - count * length].append([1, [*lengths, *[length] * count]])
                count, number = 0, number - 1
            if number:
                runs[room].append([number, lengths])
                if count < fit:
                    break
        if not count:
            return
    fit = window // length
    if count // fit:
        runs[window - fit * length].append([count // fit, [length] * fit])
    if count % fit:
        runs[window - (count % fit) * length].append([1, [length] * (count % fit)])


def _best_fit(counts: np.ndarray, window: int, runs: dict[int, list[list]]) -> list[tuple[int, list[int]]]:
    for length in np.flatnonzero(counts)[::-1]:
        if length:
            _fill(runs, int(length), int(counts[length]), window)
    return [(n, lengths) for room in sorted(runs) for n, lengths in runs[room]]


def best_fit(counts: np.ndarray, how: Packing = Packing()) -> list[tuple[int, list[int]]]:
    """The plan of best fit alone, for comparison."""
    return _best_fit(counts.astype(np.int64), how.window, defaultdict(list))


def _substituted(slots: list[int], number: int, left: list[int], loose: int, large: int, window: int, runs: dict[int, list[list]]) -> int:
    """Actual pieces take the slots of so many windows of one configuration; windows with equal lengths are one run.

    A slot takes the longest piece left that the window holds besides the slots to come.
    A piece longer than the slot's own group leaves its own place to a shorter one, so no
    piece loses its slot, and the room that rounding up had set aside comes together in
    few windows.  Windows with more room than ``loose`` aren't made; returns how many are.
    """
    made = 0
    while number:
        room, reserved, taken = window, sum(slots), {}
        for s in slots:
            reserved -= s
            x = room - reserved
            while x > large and left[x] <= taken.get(x, 0):
                x -= 1
            if x > large:
                taken[x] = taken.get(x, 0) + 1
                room -= x
        if not taken or room > loose:
            break
        n = min(number, *(left[x] // m for x, m in taken.items()))
        for x, m in taken.items():
            left[x] -= n * m
        made += n
        runs[room].append([n, [x for x, m in taken.items() for _ in range(m)]])
        number -= n
    return made


def _rounds(counts: np.ndarray, large: int, how: Packing) -> Iterator[tuple[int, list[int], dict[int, list[list]]]]:
    """After each round of configurations: the pieces these have placed, what is left by length, and the runs they make."""
    left = counts.astype(np.int64).tolist()
    runs: dict[int, list[list]] = defaultdict(list)
    loose = max(1, how.window >> 9)
    while loose < 2 * how.window:
        now = np.array(left)
        grouped = linear_groups(now, large, min(how.groups, 1 + int(now[large + 1 :].sum()) // how.least_group))
        sizes, demand = np.array([g[0] for g in grouped]), np.array([int(now[g].sum()) for g in grouped])
        chosen = whole_windows(configurations(sizes, demand, how.window, how.most_columns, how.gap), demand)
        made = 0
        for column, number in chosen:
            made += _substituted([int(sizes[k]) for k in np.flatnonzero(column) for _ in range(column[k])], number, left, loose, large, how.window, runs)
        if made:
            yield int(counts[1:].sum()) - sum(left[1:]), list(left), {room: [list(r) for r in some] for room, some in runs.items()}
        if made * 8 < sum(n for _, n in chosen) or not chosen:
            loose *= 2


def plan(counts: np.ndarray, how: Packing = Packing()) -> list[tuple[int, list[int]]]:
    """Runs of windows for so many pieces of each length (``counts`` by length).

    Linear grouping, configurations and substitution make the windows that come out
    nearly full; the pieces of the others go through the same again.  There are fewer
    each time, so groups get finer; when few windows come out
    nearly full, twice the room is allowed.  What is left, small pieces above all, goes
    by best fit into the room there is.

    Every round of every threshold gives a plan.  The one with the fewest windows is
    taken, with equal ones that with most pieces in configurations; only plans in which
    configurations place half of all pieces count, if there are such.  The search ends
    with one of those that needs no more windows than the tokens fill.
    """
    return _chosen(counts, how)[1]


def configured_share(counts: np.ndarray, how: Packing = Packing()) -> float:
    """The share of pieces that the plan's configurations place."""
    return _chosen(counts, how)[0] / max(1, int(counts[1:].sum()))


def _chosen(counts: np.ndarray, how: Packing) -> tuple[int, list[tuple[int, list[int]]]]:
    total, least = int(counts[1:].sum()), -(-int((counts * np.arange(len(counts))).sum()) // how.window)
    best, out = (False, 0, 0), None
    for large in how.large:
        for placed, left, runs in _rounds(counts, large, how):
            made = _best_fit(np.array(left), how.window, defaultdict(list, runs))
            found = (2 * placed >= total, -sum(n for n, _ in made), placed)
            if out is None or found > best:
                best, out = found, made
            if best[0] and -best[1] == least:
                return best[2], out
    return (best[2], out) if out is not None else (0, best_fit(counts, how))  # no piece is large


def places(runs: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first window, slots a window, and the first slot's offset, of each run that has it."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    rank: dict[int, int] = defaultdict(int)
    window = 0
    for n, lengths in runs:
        offset = 0
        slots: dict[int, list[int]] = {}
        for x in sorted(lengths, reverse=True):
            slots.setdefault(x, [0, offset])[0] += 1
            offset += x
        for x, (m, at) in slots.items():
            out[x].append((rank[x], window, m, at))
            rank[x] += n * m
        window += n
    return {x: tuple(np.array(c) for c in zip(*v)) for x, v in out.items()}


# --- tokens ---------------------------------------------------------------------------


_made: dict[str, WordPieces] = {}


def _tokenizer(path: str) -> WordPieces:
    if path not in _made:
        _made[path] = WordPieces(path)
    return _made[path]


def pieces(df: DataFrame, how: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each text's pieces.

    A text is its identifiers and the end; only longer ones than the window are cut.
    Null texts are empty: the end alone.
    """
    path, window, end = how.vocabulary_path, how.window, how.end
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(how.vocabulary)

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = _tokenizer(path).encode(block.column("text"))
        ids = np.insert(ids, offsets[1:], end).astype("<u4")
        offsets = offsets + np.arange(len(offsets))
        lengths = np.diff(offsets)
        n = -(-lengths // window)
        doc = np.repeat(np.arange(len(lengths)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        start = piece * window
        length = np.minimum(lengths[doc] - start, window)
        raw = memoryview(ids.tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((offsets[doc] + start).tolist(), (offsets[doc] + start + length).tolist())]
        cols = [block.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, type=pa.int64())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_texts(texts(df, id_col, text_col), of_block, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(df: DataFrame, how: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Windows hold at most ``window`` tokens, without gaps from offset 0.  Null texts are
    empty and hold the end token; null identifiers and repeated rows are packed like
    others.  An empty table gives an empty table.  Only the two named columns are read.

    Texts are read once and only numbers go on.  A length that many pieces share is
    ranked in many groups, by a hash of the piece: the groups' counts give each group's
    first rank.  The plan, some thousand rows at most, is sent with the last step.
    """
    found = cut(pieces(df, how, id_col, text_col))
    per = found.groupBy("length").agg(F.count("*").alias("n"))
    sizes = {r.length: r.n for r in per.collect()}  # at most `window` rows
    counts = np.zeros(how.window + 1, dtype=np.int64)
    for x, n in sizes.items():
        counts[x] = n
    where = places(plan(counts, how))
    share = F.broadcast(per.select("length", F.ceil(F.col("n") / how.rank_rows).alias("parts")))  # at most `window` rows
    dealt = found.join(share, "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts")))
    groups = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    first = groups.withColumn("first", F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = dealt.withColumn("at", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    ranked = ranked.join(first.select("length", "part", F.coalesce("first", F.lit(0)).alias("first")), ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("at")).alias("rank"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                r0, w0, m, off = where[x]
                run = np.searchsorted(r0, rank[at], side="right") - 1
                step = rank[at] - r0[run]
                sequence[at] = w0[run] + step // m[run]
                offset[at] = off[run] + (step % m[run]) * x
            cols = [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
