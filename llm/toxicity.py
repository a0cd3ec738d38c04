"""Toxicity by weak supervision.

Many voters (lexicon words for either class, and surface patterns) vote on each text.  A
generative label model estimates how accurate each is, and which of them are correlated,
from how often they agree, on labelled and unlabelled texts alike; a text's own label is
one more voter, whose accuracy is estimated like the others'.  The posterior labels train a
linear classifier, which scores every text.

All that is gathered has a fixed bound: voters are at most ``most_words`` words and a few
patterns; lexicon, label model and classifier are fitted on at most ``most_rows`` labelled
and ``most_unlabelled`` unlabelled texts.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.frames import cut, map_texts, table, texts
from llm.words import blocks_of

_TERM = re.compile(r"[^\W\d_]{2,}")
#: Words from which the lexicon starts; labelled texts add to them.
SEED_WORDS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "disgusting", "pathetic", "clown", "hate", "dumb", "vermin", "filthy")
#: Surface patterns that vote when no word does.
PATTERNS: tuple[tuple[str, re.Pattern[str]], ...] = (
    ("you_are", re.compile(r"\byou(?:'re| are)\b.{0,20}\b(?:idiot|moron|loser|scum|trash)", re.I)),
    ("shut_up", re.compile(r"\b(?:shut up|go away and die|kill yourself)\b", re.I)),
    ("censored", re.compile(r"\b[a-z]\*{2,}[a-z]\b", re.I)),
    ("many_marks", re.compile(r"!{3,}")),
)


@dataclass(frozen=True)
class Supervision:
    most_words: int = 400  # lexicon voters for toxic texts, words and stems, and as many again for clean ones
    most_rows: int = 20_000  # labelled texts on which lexicon, label model and classifier are fitted
    most_unlabelled: int = 10_000  # unlabelled texts on which label model and classifier are fitted, too
    least_texts: int = 4  # labelled toxic texts a lexicon word is in
    chance: float = 8.0  # powers of ten
    least_lift: float = 8.0  # how much more frequent a lexicon word is in toxic texts
    least_precision: float = 0.8  # toxic share of the texts with a lexicon feature
    rounds: int = 60
    seed_words: tuple[str, ...] = SEED_WORDS
    threshold: float = 0.3


@dataclass(frozen=True)
class ToxicityModel:
    words: tuple[str, ...]
    voter_weights: np.ndarray  # log odds that each voter adds in the label model, alone and in company
    weights: np.ndarray  # of the classifier: voters alone and in company, whether any fires, and how many
    intercept: float
    prior: float
    accuracies: np.ndarray = field(default_factory=lambda: np.zeros(0))
    correlated: tuple[tuple[int, int], ...] = ()
    gold_rates: tuple[float, float] = (0.9, 0.1)  # of toxic and of clean texts, the estimated share that is labelled toxic


#: Lengths of stems: inflected and compounded words share one.
STEMS = (4, 5, 6)


def terms(text: str) -> set[str]:
    return set(_TERM.findall(text.lower()))


def word_features(words: set[str]) -> set[str]:
    """Words, written =word, and the stems of longer words."""
    return {f"={w}" for w in words}.union(*({w[:n] for w in words if len(w) > n} for n in STEMS))


def _votes(text: str, have: set[str], at: dict[str, int]) -> np.ndarray:
    out = np.zeros(len(at) + len(PATTERNS), dtype=np.float64)
    for w in word_features(have) & at.keys():
        out[at[w]] = 1
    for k, (_, p) in enumerate(PATTERNS):
        if p.search(text):
            out[len(at) + k] = 1
    return out


def lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int, how: Supervision) -> tuple[str, ...]:
    """Seed words, features that toxic texts have far more often than clean ones, and those only clean texts have; the strongest first, ties in order of the alphabet.

    ``counts``: a feature, the families of toxic and of clean texts it is in; near
    copies are one family.  A feature must be so lopsided that chance would bring it
    about once in 10**``chance`` features.  What only continues a chosen stem that clean
    texts hardly have says nothing new and is left out.
    """
    p = min(0.5, max(1, toxic) / max(1, toxic + clean))
    lift = {w: (a / max(1, toxic)) / ((b + 0.5) / max(1, clean)) for w, a, b in counts if a >= how.least_texts}
    much = {w: (a, b) for w, a, b in counts}
    odd = {w: much[w][0] * math.log10(1 / p) - math.log10(math.comb(sum(much[w]), much[w][0])) for w in lift}
    ranked = sorted((w for w in lift if lift[w] >= how.least_lift and odd[w] >= how.chance and much[w][0] >= how.least_precision * sum(much[w])), key=lambda w: (-odd[w], w))
    chosen: list[str] = [f"={w}" for w in how.seed_words]
    pure: set[str] = set()
    for w in ranked:
        bare, (a, b) = w.lstrip("="), much[w]
        if len(chosen) < how.most_words and w not in chosen and not any(bare[:n] in pure for n in STEMS):
            chosen.append(w)
            if w == bare and b <= 0.02 * a:
                pure.add(w)
    quiet = {w: b * -math.log10(1 - p) for w, a, b in counts if a == 0 and w not in chosen}
    calm = sorted((w for w in quiet if quiet[w] >= how.chance), key=lambda w: (-quiet[w], w))
    return (*chosen[: how.most_words], *calm[: how.most_words])


def _groups(dependent: np.ndarray) -> np.ndarray:
    """A number for each voter, the same for voters joined by a chain of correlated pairs."""
    group = np.arange(len(dependent))
    while True:
        low = np.minimum(group, np.where(dependent, group[None, :], len(group)).min(1, initial=len(group)))
        if (low == group).all():
            return group
        group = low


def _label_rates(q: np.ndarray, label: np.ndarray, belief: float = 0.5) -> tuple[float, float]:
    """How often toxic and clean texts are labelled toxic.

    A belief in 0.9 and 0.1 is worth ``belief`` times the texts of each class, and ten
    more: posteriors ``q`` know the labels, and so would only confirm them.
    """
    toxic, clean = q.sum(), (1 - q).sum()
    right = (0.9 * (10 + belief * toxic) + q @ label) / (10 + (1 + belief) * toxic)
    wrong = (0.1 * (10 + belief * clean) + (1 - q) @ label) / (10 + (1 + belief) * clean)
    return float(right), float(wrong)


def label_model(votes: np.ndarray, prior: float, gold: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[tuple[int, int], ...], tuple[float, float]]:
    """Posterior labels, accuracies, log-odds weights and correlated pairs of voters, and how often toxic and clean texts are labelled toxic, by expectation-maximisation.

    A voter fires or abstains; how often it fires in either class is estimated, and an
    abstention is no evidence.  Pairs that agree far beyond what the classes explain
    are correlated; of correlated voters that fire on a text only the strongest counts.
    Texts on which none fires have a share of their own.  ``gold`` has a text's label,
    0 or 1, or nan: a voter that never abstains where there is one, and whose accuracy
    is estimated like the others', against a belief that it is right nine times in ten.
    """
    n, k = votes.shape
    some, said = votes.any(1), ~np.isnan(gold)
    label = np.where(said, gold, 0.0)
    right, wrong = 0.9, 0.1  # of toxic and of clean texts, the share that is labelled toxic
    q = np.clip(np.where(some, 0.5, prior * 0.2), 1e-3, 1 - 1e-3)
    q = np.where(said, 0.5 * q + 0.5 * np.clip(label, 0.02, 0.98), np.where(some, prior, q))
    fires = votes.sum(0)
    group = np.arange(k)
    pairs: tuple[tuple[int, int], ...] = ()
    one = zero = np.zeros(k)
    for step in range(rounds):
        one = (q @ votes + 0.05) / (q.sum() + 0.1)
        zero = ((1 - q) @ votes + 0.05) / ((1 - q).sum() + 1.0)
        weights = np.log(one / zero)
        if step == rounds // 2:
            joint = votes.T @ votes / n
            p = q.mean()
            expected = p * np.outer(one, one) + (1 - p) * np.outer(zero, zero)
            spread = np.sqrt(np.maximum(expected * (1 - expected), 1e-9) / n)
            more = joint - expected
            dep = (more > 6 * spread) & (more > 0.3 * (np.minimum.outer(fires, fires) / n - expected)) & (np.minimum.outer(fires, fires) >= 20)
            np.fill_diagonal(dep, False)
            group = _groups(dep)
            pairs = tuple((int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(dep))))
        odds = np.full(n, np.log(prior / (1 - prior)))
        for g in np.unique(group):
            mine = np.flatnonzero(group == g)
            up = (votes[:, mine] * np.maximum(weights[mine], 0)).max(1)
            down = (votes[:, mine] * np.minimum(weights[mine], 0)).min(1)
            odds += up + down
        none = np.clip(q[~some].mean() if (~some).any() else prior, 1e-3, 1 - 1e-3)
        odds[~some] = np.log(none / (1 - none))
        if step:
            right, wrong = _label_rates(q[said], label[said])
        odds += np.where(said, np.where(label > 0.5, np.log(right / wrong), np.log((1 - right) / (1 - wrong))), 0.0)
        q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    accuracy = one * prior / np.maximum(one * prior + zero * (1 - prior), 1e-12)
    return q, accuracy, np.log(one / zero), pairs, (float(right), float(wrong))


def _company(votes: np.ndarray) -> np.ndarray:
    """Each voter as two: where it fires alone, and where others fire, too.  One word in a long text says less than several."""
    n = votes.sum(1, keepdims=True)
    return np.hstack([votes * (n == 1), votes * (n > 1)])


def _features(votes: np.ndarray) -> np.ndarray:
    """Voters alone and in company, whether any fires, and how many do."""
    n = votes.sum(1, keepdims=True)
    return np.hstack([_company(votes), n > 0, np.log1p(n)])


def fit(words: tuple[str, ...], votes: np.ndarray, gold: np.ndarray, how: Supervision = Supervision()) -> ToxicityModel:
    """The model from the votes, with gold labels or nan; without labels of both classes, the seed words alone decide."""
    k = 2 * (len(words) + len(PATTERNS))
    labels = gold[~np.isnan(gold)]
    if len(set(labels.tolist())) < 2:
        w = np.tile(np.concatenate([np.full(len(words), 3.0), np.full(len(PATTERNS), 1.0)]), 2)
        return ToxicityModel(words, w, np.concatenate([w, [0.0, 0.0]]), -3.0, 0.05, np.full(k, 0.5))
    prior = float(np.clip(labels.mean(), 0.005, 0.5))
    posterior, accuracies, voter_weights, pairs, gold_rates = label_model(_company(votes), prior, gold, how.rounds)
    x1 = np.hstack([_features(votes), np.ones((len(votes), 1))])
    beta, ridge = np.zeros(x1.shape[1]), np.full(x1.shape[1], 0.05)
    ridge[-1] = 1e-6
    for _ in range(30):  # Newton steps on cross entropy with soft labels
        p = 1 / (1 + np.exp(-np.clip(x1 @ beta, -30, 30)))
        g = x1.T @ (p - posterior) + ridge * beta
        h = (x1 * (p * (1 - p) + 1e-6)[:, None]).T @ x1 + np.diag(ridge)
        step = np.linalg.solve(h, g)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return ToxicityModel(words, voter_weights, beta[:-1], float(beta[-1]), prior, accuracies, pairs, gold_rates)


def score_texts(model: ToxicityModel, column: pa.Array) -> np.ndarray:
    at = {w: k for k, w in enumerate(model.words)}
    out = np.empty(len(column))
    if not len(column):
        return out
    votes = np.array([_votes(t, terms(t), at) for t in ((x or "") for x in column.to_pylist())])
    z = _features(votes) @ model.weights + model.intercept
    out[:] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return out


def score_toxicity(df: DataFrame, model: ToxicityModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: ``score`` between 0 and 1, and ``predicted``, 1 from the threshold up.

    A null text scores as an empty one: no voter fires.  Null ids and repeated rows
    stay.  An empty table gives an empty table.  Only the two named columns are read.
    Rows never leave their partition; the model is a few kilobytes.
    """

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        s = score_texts(model, block.column("text"))
        return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_texts(texts(df, id_col, text_col), of_block, "doc_id long, score double, predicted int")


def keep_clean(df: DataFrame, model: ToxicityModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores below the threshold; all columns stay, and rows don't leave their partition."""

    def each(batches):
        for batch in batches:
            for block in blocks_of(batch, text_col):
                yield block.filter(pa.array(score_texts(model, block.column(text_col)) < threshold))

    return df.mapInArrow(each, df.schema)


def held_out(doc_id: str = "doc_id"):
    """Rows no label may be learned from: crc32 of the identifier as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


_MINIMA = 8


def _minima(words: set[str]) -> list[int]:
    """Minima of so many hashes of a text's words."""
    return [min((zlib.crc32(w.encode(), salt) for w in words), default=0) for salt in range(1, _MINIMA + 1)]


def families(signatures: dict[int, list[int]]) -> dict[int, int]:
    """Near copies by identifier: the first text, in order of identifiers, with which at least half of the minima agree stands for a family."""
    leaders: dict[tuple[int, int], list[int]] = {}
    out: dict[int, int] = {}
    for i in sorted(signatures):
        mine = signatures[i]
        agree: dict[int, int] = {}
        for key in enumerate(mine):
            for leader in leaders.get(key, ()):
                agree[leader] = agree.get(leader, 0) + 1
        best = min(((-n, leader) for leader, n in agree.items()), default=(0, i))
        if -best[0] * 2 >= _MINIMA:
            out[i] = best[1]
        else:
            out[i] = i
            for key in enumerate(mine):
                leaders.setdefault(key, []).append(i)
    return out


def learn_toxicity(docs: DataFrame, labels: DataFrame, how: Supervision = Supervision()) -> ToxicityModel:
    """Fits on at most ``how.most_rows`` labelled and ``how.most_unlabelled`` other texts, those whose identifiers hash lowest.

    Rows without label or identifier, and held-out rows, are left out; several labels
    of a text count as the worst.  Texts stay on the executors: the driver gets the
    counts of lopsided features and the voters that fired on each text.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(~held_out())
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.most_rows)
    other = texts(docs).select("doc_id").filter("doc_id is not null").filter(~held_out()).join(labels.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_anti")
    other = other.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.most_unlabelled).withColumn("toxic", F.lit(None).cast("int"))
    ids = cut(ids.unionByName(other))
    sample = cut(texts(docs).join(F.broadcast(ids), "doc_id"))  # at most most_rows + most_unlabelled rows of two numbers are broadcast

    labelled = sample.filter("toxic is not null")

    def sign(batches):
        for batch in batches:
            signed = [_minima(terms(x or "")) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed, type=pa.list_(pa.int64()))], names=["doc_id", "minima"])

    found = families({r.doc_id: r.minima for r in labelled.mapInArrow(sign, "doc_id long, minima array<long>").collect()})  # at most most_rows rows
    spark = docs.sparkSession
    found = F.broadcast(spark.createDataFrame(pa.table({"doc_id": pa.array(list(found), pa.int64()), "family": pa.array(list(found.values()), pa.int64())})))

    def digest(batches):
        for batch in batches:
            have = [sorted(word_features(terms(x or ""))) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("family"), pa.array(have, type=pa.list_(pa.string()))], names=["toxic", "family", "words"])

    family = labelled.join(found, "doc_id").select("toxic", "family", "text").mapInArrow(digest, "toxic int, family long, words array<string>")
    sizes = {r.toxic: r.families for r in family.groupBy("toxic").agg(F.count_distinct("family").alias("families")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    pairs = family.select("toxic", "family", F.explode("words").alias("word")).distinct()
    pairs = pairs.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    share = min(0.5, max(1, toxic) / max(1, toxic + clean))
    strong = (F.col("a") >= how.least_texts) & ((F.col("a") / max(1, toxic)) / ((F.col("b") + 0.5) / max(1, clean)) >= how.least_lift)
    calm = (F.col("a") == 0) & (F.col("b") * -math.log10(1 - share) >= how.chance)
    words = lexicon([(r.word, int(r.a), int(r.b)) for r in pairs.filter(strong | calm).collect()], toxic, clean, how)
    at = {w: k for k, w in enumerate(words)}

    def vote(batches):
        for batch in batches:
            fired = [np.flatnonzero(_votes(x or "", terms(x or ""), at)) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(fired, type=pa.list_(pa.int32()))], names=["doc_id", "toxic", "fired"])

    rows = sorted(((r.doc_id, math.nan if r.toxic is None else float(r.toxic), r.fired) for r in sample.mapInArrow(vote, "doc_id long, toxic int, fired array<int>").collect()), key=lambda r: (r[0], r[2]))
    votes = np.zeros((len(rows), len(words) + len(PATTERNS)), dtype=np.float32)
    for k, (_, _, fired) in enumerate(rows):
        votes[k, fired] = 1
    return fit(words, votes, np.array([y for _, y, _ in rows]), how)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, how = table(spark, sf_dir, "documents"), Supervision()
    model = learn_toxicity(docs, table(spark, sf_dir, "labels"), how)
    return score_toxicity(docs, model, how.threshold).select("doc_id", held_out().alias("held_out"), "score", "predicted")
