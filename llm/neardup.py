"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets.

A table key of plain banding needs its own minhashes.  Here two collections hold ``half``
short keys each, made of ``width`` minhashes; every pair, one from each collection, makes
a table key.  So 2 * half * width minhashes serve half * half tables: about the square
root of what the tables would need.

Links are found in passes, each exact where it confirms and none capping anything:

* Texts with equal shingle sets are one class; one stands for all.
* In each bucket every member is compared with the bucket's smallest member.  In a large
  group of near copies that is a few comparisons a member, not all pairs.
* Where a bucket still holds several components, its members are compared in full, but
  for those that provably have no link to another component, because too few of their
  shingles occur there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.components import components
from llm.frames import cut, map_texts, table, texts, whole_id
from llm.words import combine, mix64, shingles, words_of


@dataclass(frozen=True)
class NearDuplicates:
    shingle_words: int = 5
    percent: int = 80  # links have 100 * intersection >= percent * union
    half: int = 12  # short keys in each of the two collections
    width: int = 3  # minhashes in a short key
    block_rows: int = 512  # texts that are compared in full with as many others at a time,
    block_grams: int = 200_000  # and about so many shingles of theirs at most
    broadcast_rows: int = 1_000_000  # identifiers up to this number are broadcast (8 MB), else joined by a shuffle


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    k = np.arange(1, n + 1, dtype=np.uint64)
    return mix64(k * np.uint64(7919)) | np.uint64(1), mix64(k * np.uint64(104729))


def short_keys(grams: np.ndarray, offsets: np.ndarray, how: NearDuplicates) -> np.ndarray:
    """Both collections' short keys of each set: shape (sets, 2 * half); undefined for empty sets."""
    n = len(offsets) - 1
    some = np.diff(offsets) > 0
    out = np.zeros((n, 2 * how.half), dtype=np.uint64)
    if not some.any():
        return out
    at = offsets[:-1][some]
    a, b = _coefficients(2 * how.half * how.width)
    for k in range(2 * how.half):
        key = np.full(len(at), np.uint64(k + 1))
        for j in range(k * how.width, (k + 1) * how.width):
            h = grams * a[j]
            h ^= h >> np.uint64(29)
            h *= b[j] | np.uint64(1)
            key = combine(key, np.minimum.reduceat(h, at))
        out[some, k] = key
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def signatures(docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (which tell sets apart), keys; docs has the columns of ``texts``."""

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        grams, offsets = shingles(words_of(block.column("text")), how.shingle_words)
        n = np.diff(offsets)
        some = n > 0
        f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
        if some.any():
            f1[some] = np.add.reduceat(mix64(grams), offsets[:-1][some])
            f2[some] = np.add.reduceat(mix64(grams ^ np.uint64(0xA5A5A5A5DEADBEEF)), offsets[:-1][some])
        keys = short_keys(grams, offsets, how)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * 2 * how.half), _signed(keys.reshape(-1)))
        return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(n), _signed(f1), _signed(f2), lists], names=["doc_id", "n_shingles", "f1", "f2", "keys"])

    return map_texts(docs, of_block, "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>")


def _sets(docs: DataFrame, how: NearDuplicates) -> DataFrame:
    """doc_id, grams: full shingle sets."""

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        grams, offsets = shingles(words_of(block.column("text")), how.shingle_words)
        return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), _signed(grams))], names=["doc_id", "grams"])

    return map_texts(docs, of_block, "doc_id long, grams array<long>")


def table_keys(representatives: DataFrame, how: NearDuplicates) -> DataFrame:
    """key, node, n: every table's key of every representative (columns node, n, keys)."""
    left, right = F.slice("keys", 1, how.half), F.slice("keys", how.half + 1, how.half)
    pairs = F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.xxhash64(a, b))))
    return representatives.select("node", "n", F.explode(pairs).alias("key"))


def confirmed(pairs: DataFrame, sets: DataFrame, how: NearDuplicates) -> DataFrame:
    """Of pairs a, b those whose sets are similar enough.  A set meets its pairs by two joins, so one in many pairs is split."""
    one = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb")), "b")
    two = one.join(sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga")), "a")
    both = F.size(F.array_intersect("ga", "gb"))
    return two.filter(100 * both >= how.percent * (F.size("ga") + F.size("gb") - both)).select("a", "b")


def _fits(how: NearDuplicates):
    """Sizes that can be similar enough at all."""
    return 100 * F.least("na", "nb") >= how.percent * F.greatest("na", "nb")


def _some(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def _mixed(members: DataFrame) -> DataFrame:
    """Rows of those keys whose members are of several components."""
    keys = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    return members.join(keys, "key")


def undecided(shared: DataFrame, links: DataFrame, sets: DataFrame, how: NearDuplicates) -> DataFrame:
    """key, node, n, component, shared: members of buckets with several components that may yet link across them.

    ``shared`` counts a text's shingles that texts of other components have.  A link
    across has at least percent / (100 + percent) of both sizes' sum in common, and that
    much must be shared; the other size is at least ``percent`` of the text's own, and at
    least the smallest in the bucket.  The first is asked of each text before its buckets
    are looked into, the second of each bucket member.  All bounds are exact: what they
    leave out has no link to another component.  A bucket member is at most one row in
    each step, and each step's rows are written, so none is joined again for a later one.
    """
    found = components(links)
    placed = shared.join(found, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    placed = cut(_mixed(placed))
    nodes = cut(placed.select("node", "n", "component").distinct())
    grams = sets.join(nodes, F.col("doc_id") == F.col("node")).select("node", "component", F.explode("grams").alias("gram"))
    across = grams.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("gram")
    counts = grams.join(across, "gram").groupBy("node").agg(F.count("*").alias("shared"))
    own = F.ceil(F.col("n") * how.percent / 100.0 - 1e-9)
    enough = lambda other: (100 + how.percent) * F.col("shared") >= how.percent * (F.col("n") + other)
    able = cut(nodes.join(counts, "node").filter(enough(own)).select("node", "shared"))
    members = cut(placed.join(able, "node"))
    keys = members.groupBy("key").agg(F.min("n").alias("least"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key", "least")
    members = cut(members.join(keys, "key").filter(enough(F.greatest("least", own))).drop("least"))
    return cut(_mixed(members))


def block_links(members: DataFrame, sets: DataFrame, how: NearDuplicates) -> DataFrame:
    """a, b: for each two components a link between them, if there is one; ``members`` as from ``undecided``.

    Texts that share buckets, by whatever chain, are a family, dealt into blocks of
    about ``block_rows`` texts and ``block_grams`` shingles.  Each two blocks of a family
    meet in one task, which counts shared shingles by products of 0/1 matrices, a stretch
    of shingles at a time; only links go on.  So no pair of texts is a row, and a task
    holds two blocks whatever the family's size and however long its texts are.
    """
    first = members.groupBy("key").agg(F.min("node").alias("first"))
    chains = members.join(first, "key").select(F.col("node").alias("a"), F.col("first").alias("b"))
    nodes = cut(_families(members, chains))
    sizes = nodes.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / how.block_rows), F.ceil(F.sum("n") / how.block_grams)).alias("blocks"))
    dealt = nodes.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.select("family", "node", "part_of", "block", other.alias("o"))
    dealt = dealt.select("family", "node", "part_of", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    rows = dealt.join(sets, F.col("node") == F.col("doc_id")).select("family", "i", "j", "block", "node", "part_of", "grams")
    percent, stretch = how.percent, 4096

    def compare(t: pa.Table) -> pa.Table:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        node, comp = t.column("node").to_numpy(), t.column("part_of").to_numpy()
        if len(np.unique(comp)) < 2:
            return schema.empty_table()
        order = np.argsort(node, kind="stable")
        node, comp, block = node[order], comp[order], t.column("block").to_numpy()[order]
        grams = t.column("grams").combine_chunks().take(pa.array(order))
        sizes = np.diff(grams.offsets.to_numpy())
        row = np.repeat(np.arange(len(node)), sizes)
        flat = grams.flatten().to_numpy()
        u, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        often = counts[inverse] > 1
        row, column = row[often], inverse[often]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        number = np.cumsum(np.concatenate([[0], np.diff(column) != 0])) if len(column) else column
        both = np.zeros((len(node), len(node)), dtype=np.float32)
        for low in range(0, int(number[-1]) + 1 if len(number) else 0, stretch):
            at = slice(*np.searchsorted(number, [low, low + stretch]))
            m = np.zeros((len(node), stretch), dtype=np.float32)
            m[row[at], number[at] - low] = 1
            both += m @ m.T  # counts below 2**24 are exact
        total = sizes[:, None] + sizes[None, :] - both
        close = (100.0 * both >= percent * total) & (comp[:, None] < comp[None, :])
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        if i != j:
            close &= block[:, None] != block[None, :]
        a, b = np.nonzero(close)
        _, one = np.unique(np.stack([comp[a], comp[b]]), axis=1, return_index=True) if len(a) else (None, np.zeros(0, dtype=np.int64))
        return pa.table([pa.array(node[a[one]]), pa.array(node[b[one]])], schema=schema)

    return rows.groupBy("family", "i", "j").applyInArrow(compare, "a long, b long")


def _families(members: DataFrame, chains: DataFrame) -> DataFrame:
    """node, n, part_of (its component so far), family."""
    nodes = members.select("node", "n", F.col("component").alias("part_of")).distinct()
    return nodes.join(components(chains).withColumnRenamed("component", "family"), "node", "left").select("node", "n", "part_of", F.coalesce("family", "node").alias("family"))


def near_duplicates(df: DataFrame, how: NearDuplicates = NearDuplicates(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``df``.

    A text's set holds its distinct shingles of ``shingle_words`` words, A-Z
    lower-cased; a shorter text's is its word sequence.  Texts link if 100 *
    intersection >= percent * union; ``component_id`` is the smallest identifier
    reached over links, and the text that has it is kept.

    Null and wordless texts have an empty set, link with nothing, and are kept.  A null
    identifier links with nothing: component_id is null and kept is true.  Rows that
    repeat an identifier with one text all get its component; rows with differing texts
    under one identifier get each their own text's component.  An empty table gives an empty table.  Only the two named columns are
    read.

    A pair at just 80 % meets in no table with a probability of about
    2 * (1 - 0.8 ** width) ** half: 4 in 10,000 with the values given.
    """
    docs = texts(df, id_col, text_col)
    signed = cut(signatures(docs, how).withColumn("row", F.monotonically_increasing_id()))
    real = signed.filter("doc_id is not null and n_shingles > 0")
    # minima of numbers only: they aggregate by hashing, where those of structs would sort every row
    first = real.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("node"), F.min("row").alias("row"))
    classes = cut(first.join(signed.select("row", "keys"), "row").select("f1", "f2", "n_shingles", "node", "keys"))
    keys = table_keys(classes.select("node", F.col("n_shingles").alias("n"), "keys"), how)
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members")).filter("members > 1").select("key", "hub")
    shared = cut(keys.join(hubs, "key"))

    sizes = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"))
    near = shared.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"), F.col("n").alias("na")).distinct()
    near = cut(near.join(sizes, "b").filter(_fits(how)).select("a", "b"))
    wanted = shared.select(F.col("node").alias("doc_id")).distinct()
    sets = cut(_sets(docs.join(_some(wanted, how.broadcast_rows), "doc_id", "left_semi"), how).dropDuplicates(["doc_id"]))
    links = cut(confirmed(near, sets, how))

    # buckets that may still hide a link between components are compared in full, blocks of texts at a time
    members = undecided(shared, links, sets, how)
    links = links.unionByName(cut(block_links(members, sets, how)))

    # equal sets: every row links with its class
    groups = components(links)
    of_class = classes.join(groups, "node", "left").select("f1", "f2", "n_shingles", F.coalesce("component", "node").alias("of_class"))
    found = real.select("doc_id", "n_shingles", "f1", "f2").join(of_class, ["f1", "f2", "n_shingles"]).select("doc_id", "n_shingles", "of_class")
    bare = signed.filter("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("of_class"))
    out = found.unionByName(bare)
    return out.select("doc_id", "n_shingles", F.col("of_class").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("of_class"), F.lit(True)).alias("kept"))


def keep_one(df: DataFrame, how: NearDuplicates = NearDuplicates(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` but for near copies: of each component the row with the smallest identifier; all columns stay.

    Rows that repeat that identifier all stay, as do those without words or identifier.
    Texts are looked up by the identifiers that go: a broadcast up to
    ``broadcast_rows`` of them, a shuffle beyond.
    """
    gone = cut(near_duplicates(df, how, id_col, text_col).filter("not kept").select("doc_id").distinct())
    return df.join(_some(gone.withColumnRenamed("doc_id", "__gone"), how.broadcast_rows), whole_id(df, id_col) == F.col("__gone"), "left_anti")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearDuplicates(shingle_words=2))
