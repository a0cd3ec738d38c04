"""Mixing sources to target weights, in DataFrame and SQL functions only.

Sources' shares of tokens are raised to an exponent and normalised; the exponent is
bisected until the weights have a target entropy, or no source repeats more often than a
limit.  Each source's documents are dealt into blocks; the blocks are permuted anew for
each pass over the source, and as many are taken as the source's budget holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.frames import cut, table, whole_id


@dataclass(frozen=True)
class Mixture:
    target_entropy: float = 0.95  # of the weights, as a share of the most that so many sources can have
    most_repeats: float = 4.0  # passes over a source
    budget: float = 1.0  # tokens of the mixture, as a multiple of all sources' tokens
    most_exponent: float = 8.0
    blocks: int = 128  # of each source, and of each block that the budget cuts
    seed: int = 7
    grid: int = 64  # exponents tried at once; each round of the bisection is that much finer
    rounds: int = 4
    broadcast_sources: int = 5_000  # block tables of so many sources (some 60 MB) are broadcast, larger ones joined by a shuffle


def token_count(text: str = "text"):
    """Words: runs of characters outside the six ASCII white-space characters; null texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def exponent(sources: DataFrame, how: Mixture) -> float:
    """The exponent between 0 and ``most_exponent`` whose weights have the target entropy, or the nearest to it that no source repeats too often with.

    ``sources``: source, tokens.  Entropy falls as the exponent grows.  At 1 every
    source is taken as often; below 1 small sources repeat most, above 1 large ones do,
    so the exponents that keep the limit on repeats are a stretch around 1.  Where
    entropy asks for one outside, the stretch's end is taken.  Each round tries ``grid``
    exponents for each of the three bounds by one aggregation, between the two that the
    round before found.
    """
    some = sources.filter("tokens > 0")
    whole = some.agg(F.sum("tokens").alias("all"), F.count("*").alias("n"))
    shares = some.join(F.broadcast(whole), F.lit(True)).select(F.log(F.col("tokens") / F.col("all")).alias("lp"), "n")  # one row is broadcast
    limit = max(how.most_repeats, how.budget) * (1 + 1e-12)
    bounds = {"entropy": (0.0, how.most_exponent), "least": (0.0, 1.0), "most": (1.0, how.most_exponent)}
    for _ in range(how.rounds):
        tried = [(k, low + (high - low) * i / how.grid) for k, (low, high) in bounds.items() for i in range(how.grid + 1)]
        points = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a")) for i, (_, a) in enumerate(tried)])).alias("p")
        z = shares.select("lp", "n", points).select("lp", "n", "p.i", "p.a").groupBy("i", "a").agg(
            F.sum(F.exp(F.col("a") * F.col("lp"))).alias("z"), F.sum(F.exp(F.col("a") * F.col("lp")) * F.col("a") * F.col("lp")).alias("s"), F.max("n").alias("n"), F.max((F.col("a") - 1) * F.col("lp")).alias("m")
        )
        entropy = F.log("z") - F.col("s") / F.col("z")
        repeats = how.budget * F.exp(F.col("m")) / F.col("z")  # of the source that repeats most
        found = {r.i: r for r in z.select("i", (entropy >= how.target_entropy * F.log("n") - 1e-12).alias("even"), (repeats <= limit).alias("few")).collect()}  # 3 * (grid + 1) rows
        if not found:
            return 1.0
        for k in bounds:
            mine = [(a, found[i].even if k == "entropy" else found[i].few) for i, (kind, a) in enumerate(tried) if kind == k]
            if k == "least":  # holds from some exponent on
                first = min((i for i, (_, holds) in enumerate(mine) if holds), default=how.grid)
                bounds[k] = (mine[max(first - 1, 0)][0], mine[first][0])
            else:  # holds up to some exponent
                last = max((i for i, (_, holds) in enumerate(mine) if holds), default=0)
                bounds[k] = (mine[last][0], mine[min(last + 1, how.grid)][0])
    return min(max(bounds["entropy"][0], bounds["least"][1]), bounds["most"][0])


def weights(sources: DataFrame, how: Mixture) -> DataFrame:
    """source, tokens, weight, budget: the normalised weights, and the tokens each source is to give."""
    a = exponent(sources, how)
    some = sources.filter("tokens > 0")
    whole = F.broadcast(some.agg(F.sum("tokens").alias("all")))  # one row
    powered = some.join(whole, F.lit(True)).withColumn("raised", F.exp(F.lit(a) * F.log(F.col("tokens") / F.col("all"))))
    z = F.broadcast(powered.agg(F.sum("raised").alias("z")))  # one row
    return powered.join(z, F.lit(True)).select("source", "tokens", (F.col("raised") / F.col("z")).alias("weight"), F.round(how.budget * F.col("all") * F.col("raised") / F.col("z")).cast("long").alias("budget"))


def _block(how: Mixture, level: int):
    return F.pmod(F.xxhash64(F.lit(how.seed + level), "doc_id", "source", "tokens"), F.lit(how.blocks))


def planned(docs: DataFrame, how: Mixture = Mixture()) -> tuple[DataFrame, DataFrame]:
    """What the mixture takes of each block and, of the blocks that the budget cuts, of each part.

    First source, block, copies, cut, places; then source, block, part.  ``docs``:
    source, tokens, block, part.  A source's budget gives a number of whole passes and
    a rest.  Each pass goes through the source's blocks in a permutation of its own:
    ``places`` has a block's place in each pass, the one of the rest last.  The rest
    takes whole blocks in order while they fit, then, of the first that doesn't, whole
    parts in an order of their own while they fit.  So at most a part of a block
    (1 / blocks**2 of the source, about) is left over, and no window is longer than
    ``blocks`` rows, however large a source is.  A source without words has no budget:
    one pass and no rest.
    """
    parts = cut(docs.groupBy("source", "block", "part").agg(F.sum("tokens").alias("tokens")))
    mixed = weights(parts.groupBy("source").agg(F.sum("tokens").alias("tokens")), how)
    mixed = mixed.withColumn("passes", F.floor(F.col("budget") / F.col("tokens"))).withColumn("rest", F.col("budget") - F.col("passes") * F.col("tokens")).select("source", "passes", "rest")
    blocks = parts.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")).join(mixed, "source", "left").fillna({"passes": 1, "rest": -1})
    order = lambda *by: F.xxhash64(F.lit(how.seed), "source", *by)
    each = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))))
    turn = Window.partitionBy("source", "pass").orderBy(order("pass", "block"), "block")
    upto = turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("place", F.row_number().over(turn) - 1).withColumn("upto", F.sum("tokens").over(upto))
    last = F.col("pass") == F.col("passes")
    room = F.col("rest") - (F.col("upto") - F.col("tokens"))
    blocks = each.groupBy("source", "block", "passes").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pass", "place"))), lambda x: x["place"]).alias("places"),
        F.max(last & (F.col("upto") <= F.col("rest"))).alias("whole"), F.max(F.when(last & (room > 0) & (F.col("upto") > F.col("rest")), room)).alias("room"),
    )
    blocks = cut(blocks.select("source", "block", (F.col("passes") + F.col("whole").cast("long")).cast("int").alias("copies"), F.col("room").isNotNull().alias("cut"), "places", "room"))
    inside = parts.join(blocks.filter("cut").select("source", "block", "room"), ["source", "block"])
    upto = Window.partitionBy("source", "block").orderBy(order("block", "part"), "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = cut(inside.withColumn("upto", F.sum("tokens").over(upto)).filter(F.col("upto") <= F.col("room")).select("source", "block", "part"))
    return blocks.drop("room"), inside


def placed(docs: DataFrame, plan: tuple[DataFrame, DataFrame], how: Mixture) -> DataFrame:
    """``docs`` (source, block, part and others) with copies and places.  Texts stay in place unless there are very many sources."""
    blocks, inside = (F.broadcast(t) if t.count() <= how.blocks * how.broadcast_sources else t for t in plan)
    out = docs.join(blocks, ["source", "block"]).join(inside.withColumn("more", F.lit(1)), ["source", "block", "part"], "left")
    return out.withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).withColumn("places", F.slice("places", F.lit(1), F.col("copies"))).drop("more", "cut")


def _keyed(df: DataFrame, how: Mixture, id_col: str, source_col: str, text_col: str, *more: Column) -> DataFrame:
    docs = df.select(whole_id(df, id_col).alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), token_count(text_col).alias("tokens"), *more)
    return docs.withColumn("block", _block(how, 0)).withColumn("part", _block(how, 1))


def mix_sources(df: DataFrame, how: Mixture = Mixture(), id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, tokens, copies, block, part, places: one row for each row of ``df``.

    ``copies`` is how often the mixture has the row, and ``places`` has for each of
    them, pass by pass, the place of its block in that pass's order: reading passes in
    turn, blocks by place, gives each source's part of the mixture.

    Tokens are words of the whole text.  Null texts have none and are taken once for each
    whole pass, as they cost nothing; a source without words is taken once.  Null
    sources are one source, written as empty.  Rows with null identifiers and repeated
    rows are dealt like others, repeats into the same block; equal shares stay equal.
    With one source, or equal ones, no exponent changes the weights.  An empty table
    gives an empty table.  Only the three named columns are read.
    """
    kept = cut(_keyed(df, how, id_col, source_col, text_col))
    return placed(kept, planned(kept, how), how).select("doc_id", "source", "tokens", "copies", "block", "part", "places")


def repeat_rows(df: DataFrame, how: Mixture = Mixture(), id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, each as often as the mixture has it; all columns stay.

    Texts stay in place: copies are looked up by source and block, in tables of bounded size.
    """
    names = df.columns
    plan = planned(_keyed(df, how, id_col, source_col, text_col), how)
    rows = placed(_keyed(df, how, id_col, source_col, text_col, F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")), plan, how)
    return rows.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select(*[F.col("row")[c].alias(c) for c in names])


def op8_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))
