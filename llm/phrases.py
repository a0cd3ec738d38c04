"""Phrase collocation mining.

Words that are frequent enough to be part of a frequent phrase get dense numbers; all
others break pieces.  A phrase is the fixed-width big-endian numbers of its words in a
row, so that keys sort as bytes.  Tasks sort their keys by radix and send keys and run
lengths, many in a row, to buckets by a hash; there they are sorted again and runs added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.frames import cut, map_texts, table
from llm.words import _LOWER, _bytes_of, _words, blocks_of, mix64

_FOLD = _LOWER.astype(np.uint8)
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


@dataclass(frozen=True)
class Mining:
    least: int = 10  # occurrences of a candidate
    longest: int = 3  # words of a candidate
    covered_percent: int = 50  # a candidate goes if a longer one around it has so many of its occurrences
    top: int = 2000  # phrases reported for each part
    most_sent: int = 500_000  # words of a dictionary that is sent to all tasks; a larger one is joined with the blocks
    most_sent_bytes: int = 16 << 20
    buffer: int = 1 << 21  # keys a task sorts at once
    range_rows: int = 2_000_000  # phrases, counted each time they occur, that meet in a bucket


def tokens(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of some texts, the piece each is in and the text each is in; pieces have rising numbers.

    Words become a string array without copying each: separators are left out of the bytes.
    """
    data, offsets = _bytes_of(column)
    n = len(data)
    inside = ~_GAP[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < n]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    place = np.cumsum(inside, dtype=np.int64)
    ends = np.append(place[starts] - 1, place[-1] if n else 0)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(_FOLD[data[inside]])])
    text = np.searchsorted(offsets, starts, side="right") - 1
    return words, np.cumsum(_BREAK[data], dtype=np.int64)[starts] + text, text


def _numbers(words: pa.Array) -> np.ndarray:
    """A 64-bit number for each word of an array."""
    return _words(*_bytes_of(words), fold=False).hashes


class Dictionary:
    """Frequent words by part: sorted by their 64-bit numbers, and compared as strings where numbers are equal."""

    def __init__(self, rows: pa.Table):
        self.parts: dict[str, tuple[np.ndarray, pa.Array, np.ndarray]] = {}
        rows = rows.combine_chunks()
        part, word, ids = rows["part"].combine_chunks(), rows["word"].cast(pa.large_string()).combine_chunks(), rows["id"].to_numpy()
        for p in pc.unique(part).to_pylist():
            mine = np.flatnonzero(pc.equal(part, p).to_numpy(zero_copy_only=False))
            words = word.take(pa.array(mine))
            numbers = _numbers(words)
            order = np.argsort(numbers, kind="stable")
            self.parts[p] = (numbers[order], words.take(pa.array(order)), ids[mine][order])

    def ids(self, part: str, words: pa.Array) -> np.ndarray:
        """The number of each distinct word, 0 where the dictionary hasn't got it."""
        out = np.zeros(len(words), dtype=np.int64)
        if part not in self.parts or not len(words):
            return out
        numbers, known, ids = self.parts[part]
        mine = _numbers(words)
        at = np.searchsorted(numbers, mine)
        open_ = np.flatnonzero(at < len(numbers))
        while len(open_ := open_[numbers[np.minimum(at[open_], len(numbers) - 1)] == mine[open_]]):
            same = pc.equal(known.take(pa.array(at[open_])), words.take(pa.array(open_))).to_numpy(zero_copy_only=False)
            out[open_[same]] = ids[at[open_[same]]]
            open_ = open_[~same]  # another word with this number, if any, is the next one
            at[open_] += 1
            open_ = open_[at[open_] < len(numbers)]
        return out


def keys_of(ids: np.ndarray, piece: np.ndarray, longest: int, width: int) -> np.ndarray:
    """Rows of bytes: the numbers of 2 to ``longest`` successive words of a piece, none of them 0; shorter phrases end in zeros."""
    numbers = ids.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]
    out, n = [], len(ids)
    whole = np.flatnonzero(ids > 0)
    for m in range(2, longest + 1):
        whole = whole[whole + m - 1 < n]
        whole = whole[(ids[whole + m - 1] > 0) & (piece[whole + m - 1] == piece[whole])]
        rows = np.zeros((len(whole), longest * width), dtype=np.uint8)
        for k in range(m):
            rows[:, k * width : (k + 1) * width] = numbers[whole + k]
        out.append(rows)
    return np.concatenate(out)


def ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of some keys, and where in it each distinct one begins: a radix sort, two bytes a pass from the last.

    Besides the keys it holds their order in 32 bits, and one digit at a time.
    """
    wide = keys.shape[1]

    def digit(k: int) -> np.ndarray:
        return keys[:, k].astype(np.uint16) << np.uint16(8) | keys[:, k + 1] if k + 1 < wide else keys[:, k].astype(np.uint16)

    order = np.arange(len(keys), dtype=np.int32)
    for k in range((wide - 1) // 2 * 2, -1, -2):
        d = digit(k)
        if (d != d[0]).any():
            order = order[np.argsort(d[order], kind="stable")]  # numpy's stable sort of 16-bit numbers is a radix sort
    changes = np.zeros(len(keys) - 1, dtype=bool)
    for k in range(0, wide, 2):
        d = digit(k)[order]
        changes |= d[1:] != d[:-1]
    return order, np.concatenate([np.zeros(1, np.int32), np.flatnonzero(changes).astype(np.int32) + 1])


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each comes."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    order, at = ordered(keys)
    return keys[order[at]], np.diff(at, append=np.int32(len(keys)))


def _binary(keys: np.ndarray) -> pa.Array:
    n, wide = keys.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * wide), pa.py_buffer(np.ascontiguousarray(keys))])


def _as_numbers(keys: np.ndarray) -> list[np.ndarray]:
    """Keys' bytes by eights as big-endian numbers, the last ones first."""
    even = np.pad(keys, ((0, 0), (0, -keys.shape[1] % 8)))
    return [x.astype(np.uint64) for x in even.view(">u8").T[::-1]]


#: Keys that are sent with their run lengths: of one bucket, one after the other in each row.
SENT = "bucket long, keys binary, n binary"
#: Bytes of keys and run lengths in a batch, unless one bucket has more.
BATCH_BYTES = 1 << 20
_SENT = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])


def _counted(keys: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    keys, n = runs(keys)
    if not len(keys):
        return
    bucket = np.empty(len(keys), dtype=np.int32)
    for a in range(0, len(keys), 1 << 16):
        mixed = np.uint64(0)
        for number in _as_numbers(keys[a : a + (1 << 16)]):
            mixed = mix64(mixed ^ number)
        bucket[a : a + (1 << 16)] = mixed % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable").astype(np.int32)
    bucket = bucket[order]
    ends = [*(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
    some, most = [], BATCH_BYTES // (keys.shape[1] + 8)
    for a, b in zip([0, *ends], ends):
        if some and b - some[0].start > most:
            yield _packed(keys, n, bucket, order, some)
            some = []
        some.append(slice(a, b))
    yield _packed(keys, n, bucket, order, some)


def _packed(keys: np.ndarray, n: np.ndarray, bucket: np.ndarray, order: np.ndarray, some: list[slice]) -> pa.RecordBatch:
    """A row for each stretch of ``order``: the keys of one bucket."""
    columns = [bucket[x.start] for x in some], [keys[order[x]].tobytes() for x in some], [n[order[x]].astype("<i8").tobytes() for x in some]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _SENT.types)], schema=_SENT)


def word_counts(given: DataFrame) -> DataFrame:
    """part, word, n for every word; the row with a null word has the occurrences of all."""

    def of_block(block: pa.RecordBatch) -> pa.Table:
        words, _, text = tokens(block.column("text"))
        coded, parts = words.dictionary_encode(), block.column("part").dictionary_encode()
        part = parts.indices.to_numpy()[text].astype(np.int64)
        code, n = np.unique(part * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
        all_words = np.bincount(part, minlength=len(parts.dictionary))
        which = np.concatenate([code // max(1, len(coded.dictionary)), np.arange(len(all_words))])
        word = pa.concat_arrays([coded.dictionary.take(pa.array(code % max(1, len(coded.dictionary)))).cast(pa.string()), pa.nulls(len(all_words), pa.string())])
        return pa.table({"part": parts.dictionary.take(pa.array(which)), "word": word, "n": pa.array(np.concatenate([n, all_words]), pa.int64())})

    return map_texts(given, of_block, "part string, word string, n long").groupBy("part", "word").agg(F.sum("n").alias("n"))


def numbered(counts: DataFrame, how: Mining) -> tuple[DataFrame, int, int]:
    """The frequent words with dense numbers from 1 (column ``id``), how many they are, and their bytes.

    Words are numbered within hashed buckets, after the sizes of the buckets before;
    the totals of parts (null words) have no number.
    """
    size = counts.filter("word is not null").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("b")).first()
    buckets = min(4096, 1 + size.n // 100_000)
    placed = counts.withColumn("bucket", F.pmod(F.xxhash64("part", "word"), F.lit(buckets)))
    sizes = {r.bucket: r.n for r in placed.filter("word is not null").groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # at most 4096 rows
    before = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(buckets)])])[:-1]
    start = counts.sparkSession.createDataFrame([(k, int(b)) for k, b in enumerate(before)], "bucket long, start long")
    placed = placed.join(F.broadcast(start), "bucket")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.col("word").isNull(), "part", "word"))
    return cut(placed.select("part", "word", "n", F.when(F.col("word").isNotNull(), F.col("start") + rank).alias("id"))), size.n, size.b


def _sent(given: DataFrame, words: DataFrame, how: Mining, width: int, buckets: int) -> DataFrame:
    """Keys with their run lengths, by a dictionary in every task; a task sorts ``how.buffer`` keys at a time."""
    spark = given.sparkSession
    sent = spark.sparkContext.broadcast(words.select("part", "word", "id").toArrow())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Dictionary(sent.value)
        waiting, held = np.empty((how.buffer, how.longest * width), dtype=np.uint8), 0
        for batch in batches:
            for block in blocks_of(batch):
                found, piece, text = tokens(block.column("text"))
                coded, parts = found.dictionary_encode(), block.column("part").dictionary_encode()
                code, part = coded.indices.to_numpy(), parts.indices.to_numpy()[text]
                ids = np.zeros(len(code), dtype=np.int64)
                for k, p in enumerate(parts.dictionary.to_pylist()):
                    ids = np.where(part == k, words.ids(p, coded.dictionary)[code], ids) if len(code) else ids
                keys = keys_of(ids, piece, how.longest, width)
                while len(keys):
                    more = min(len(keys), how.buffer - held)
                    waiting[held : held + more], keys, held = keys[:more], keys[more:], held + more
                    if held == how.buffer:
                        yield from _counted(waiting, buckets)
                        held = 0
        if held:
            yield from _counted(waiting[:held], buckets)

    return given.mapInArrow(each, SENT)


def _joined(given: DataFrame, words: DataFrame, how: Mining, width: int, buckets: int) -> DataFrame:
    """The same by a join: each block sends the places of its distinct words, gets their numbers and is put together again.

    A word is one row a block and part, however frequent it is; a block is about a megabyte of text, or one longer text.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block_id = (TaskContext.get().partitionId() << 40) - 1
        for batch in batches:
            for block in blocks_of(batch):
                block_id += 1
                found, piece, text = tokens(block.column("text"))
                coded, parts = found.dictionary_encode(), block.column("part").dictionary_encode()
                n = max(1, len(coded.dictionary))
                code = parts.indices.to_numpy()[text].astype(np.int64) * n + coded.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                some, first = np.unique(code[order], return_index=True)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(code)), pa.int32()), pa.array(order, pa.int64()))
                part, word = parts.dictionary.take(pa.array(some // n)), coded.dictionary.take(pa.array(some % n)).cast(pa.string())
                ids = pa.array(np.full(len(some), block_id), pa.int64())
                yield pa.RecordBatch.from_arrays([ids, part, word, lists], names=["block", "part", "word", "places"])
                yield pa.RecordBatch.from_arrays([pa.array([block_id], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.array([piece], pa.list_(pa.int64()))], names=["block", "part", "word", "places"])

    def gather(group: pa.Table) -> pa.Table:
        lists, number = group["places"].combine_chunks(), group["id"].to_numpy()
        flat, sizes = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy()
        whole = np.repeat(number, sizes)
        piece = flat[whole == 0]  # the row without a word
        ids = np.zeros(len(piece), dtype=np.int64)
        ids[flat[whole != 0]] = whole[whole != 0]
        return pa.Table.from_batches(_counted(keys_of(ids, piece, how.longest, width), buckets), _SENT)

    places = cut(given.mapInArrow(spread, "block long, part string, word string, places array<long>"))
    known = places.filter("word is not null").join(words.select("part", "word", "id"), ["part", "word"]).select("block", "places", "id")
    return known.unionByName(places.filter("word is null").select("block", "places", F.lit(0).cast("long").alias("id"))).groupBy("block").applyInArrow(gather, SENT)


def frequent_phrases(given: DataFrame, words: DataFrame, size: int, size_bytes: int, how: Mining) -> tuple[DataFrame, int]:
    """key, words, a: the phrases of 2 to ``how.longest`` words with at least ``how.least`` occurrences; and the bytes of a word's number.

    Keys are dealt out by a hash into buckets, of at most about ``how.range_rows``
    occurrences each, as a phrase that occurs more often is one key and number a task's buffer.
    """
    width = max(1, (size.bit_length() + 7) // 8)
    wide = how.longest * width
    total = words.filter("word is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    buckets = max(1, -(-total * (how.longest - 1) // how.range_rows))
    keys = (_sent if size <= how.most_sent and size_bytes <= how.most_sent_bytes else _joined)(given, words.filter("word is not null"), how, width, buckets)

    def add_up(group: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in group["keys"]]).reshape(-1, wide)
        n = np.concatenate([np.frombuffer(x.as_buffer(), dtype="<i8") for x in group["n"]])
        order, at = ordered(rows)
        rows, a = rows[order[at]], np.add.reduceat(n[order], at)
        rows, a = rows[a >= how.least], a[a >= how.least]
        size_ = rows.reshape(len(rows), how.longest, width).any(2).sum(1)
        return pa.table({"key": _binary(rows), "words": pa.array(size_, pa.int32()), "a": pa.array(a, pa.int64())})

    return cut(keys.groupBy("bucket").applyInArrow(add_up, "key binary, words int, a long")), width


def _sub(key: Column, first: Column, size: Column, width: int, wide: int) -> Column:
    """The key of some successive words of a key."""
    return F.substring(F.concat(F.substring(key, first * width + 1, size * width), F.lit(bytearray(wide))), F.lit(1), F.lit(wide))


def collocations(df: DataFrame, how: Mining = Mining(), text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each part's highest scoring phrases.

    A null text has no words, a null part is ``und``.  Repeated rows count each.  Ties go
    by frequency, then by the phrase's bytes.  A text longer than a megabyte is a block of
    its own.  An empty table, or one without a frequent phrase, gives no rows.  Only the
    two named columns are read.  Words count as equal by their bytes, never by a hash alone.
    """
    if how.longest < 2:
        raise ValueError("phrases have two words or more")
    given = df.select(F.coalesce(F.col(part_col).cast("string"), F.lit("und")).alias("part"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = cut(word_counts(given).filter(f"word is null or n >= {how.least}"))
    words, size, size_bytes = numbered(counts, how)
    phrases, width = frequent_phrases(given, words, size, size_bytes, how)
    wide, key = how.longest * width, F.col("key")
    known = words.filter("word is not null")
    big = lambda number: F.unhex(F.lpad(F.hex(number), 2 * width, "0"))
    single = known.select(F.substring(F.concat(big(F.col("id")), F.lit(bytearray(wide))), F.lit(1), F.lit(wide)).alias("key"), F.col("n").alias("a"))
    f = single.unionByName(phrases.select("key", "a"))
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumn("head", _sub(key, F.lit(0), F.col("k"), width, wide)).withColumn("tail", _sub(key, F.col("k"), F.col("words") - F.col("k"), width, wide))
    cuts = cuts.join(f.select(F.col("key").alias("head"), F.col("a").alias("l")), "head").join(f.select(F.col("key").alias("tail"), F.col("a").alias("r")), "tail")
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", (F.lit(1_000_000).cast("decimal(7,0)") * exact("a") * exact("a")).cast("decimal(38,0)"), (exact("l") * exact("r")).cast("decimal(38,0)"))
    best = cuts.groupBy("key", "words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    inner = phrases.withColumn("size", F.explode(F.expr("filter(sequence(1, words), x -> x > 1 and x < words)"))).withColumn("first", F.explode(F.expr("sequence(0, words - size)")))
    inner = inner.groupBy(_sub(key, F.col("first"), F.col("size"), width, wide).alias("key")).agg(F.max("a").alias("longer"))
    best = best.join(inner, "key", "left").filter(f"longer is null or 100 * longer < {how.covered_percent} * a")
    spelled = best.withColumn("place", F.explode(F.expr("sequence(1, words)")))
    spelled = spelled.withColumn("id", F.conv(F.hex(F.substring(key, (F.col("place") - 1) * width + 1, F.lit(width))), 16, 10).cast("long"))
    small = size <= how.most_sent and size_bytes <= how.most_sent_bytes
    spelled = spelled.join(F.broadcast(known.select("id", "part", "word")) if small else known.select("id", "part", "word"), "id")
    spelled = spelled.groupBy("part", "key", "a", "c").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w"))  # at most ``longest`` words
    spelled = spelled.select("part", F.array_join("w.word", " ").alias("phrase"), "a", "c")
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("c.score"), F.desc("a"), "phrase"))
    ranked = spelled.withColumn("rank", rank).filter(F.col("rank") <= how.top)
    totals = words.filter("word is null").select("part", "n")
    return ranked.join(totals, "part").select(F.col("part").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "c.l", "c.r", "n", "c.score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_OP12 = r"""
with docs as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from docs)),
totals as (select lang, sum(len(w))::bigint as n from pieces group by lang),
grams as (
  select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from pieces, (select unnest([1, 2, 3]) as m) where len(w) >= m)),
f as (select lang, m, phrase, count(*) as c from grams group by all having count(*) >= 10),
cand as (select lang, m, phrase, c as a, string_split(phrase, ' ') as w from f where m > 1),
cuts as (
  select d.lang, d.m, d.phrase, d.a, k, l.c as l, r.c as r, ((1000000::hugeint * d.a * d.a) // (l.c::hugeint * r.c))::bigint as score
  from (select *, unnest(range(1, m)) as k from cand) d
  join f l on l.lang = d.lang and l.m = d.k and l.phrase = array_to_string(d.w[1:d.k], ' ')
  join f r on r.lang = d.lang and r.m = d.m - d.k and r.phrase = array_to_string(d.w[d.k + 1:d.m], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
  select lang, sub, max(a) as most from (
    select lang, a, array_to_string(w[1:2], ' ') as sub from cand where m = 3
    union all select lang, a, array_to_string(w[2:3], ' ') as sub from cand where m = 3)
  group by all),
kept as (select b.* from best b left join longer g on g.lang = b.lang and g.sub = b.phrase where g.most is null or 100 * g.most < 50 * b.a)
select lang, rank, phrase, a, l, r, n, score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join totals using (lang)
where rank <= 2000
"""
