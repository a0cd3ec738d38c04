"""Quality of texts: gradient-boosted trees over statistics of the text.

Statistics come from a text's bytes, words and lines alone, as arrays for a block of
texts at a time.  Trees are fitted on at most ``most_rows`` labelled texts; only their
statistics reach the driver, some 30 numbers a text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.frames import cut, map_texts, table, texts
from llm.quality import _line_facts, _seen_before, _sum_at, repeated_words
from llm.toxicity import held_out
from llm.trees import Boosting, Trees, fit_trees
from llm.words import combine, words_of


@dataclass(frozen=True)
class QualityModel:
    most_rows: int = 20_000  # labelled texts the trees are fitted on
    threshold: float = 0.7
    boosting: Boosting = field(default_factory=Boosting)


def _set(*members: int | bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for m in members:
        out[list(m) if isinstance(m, (bytes, range)) else m] = True
    return out


#: Classes of bytes, each counted per word or per code point.
_CLASSES = {
    "capital": _set(range(65, 91)), "small": _set(range(97, 123)), "digit": _set(range(48, 58)), "beyond_ascii": _set(range(0xC0, 0x100)),
    "stop": _set(b".!?"), "comma": _set(b",;:"), "exclaim": _set(b"!"), "symbol": _set(b"#*$%&@^~_=+\\"), "bar": _set(b"|"), "bracket": _set(b"<>{}[]()"),
    "quote": _set(b"\"'`"), "slash": _set(b"/"), "dash": _set(b"-"), "space": _set(0x20, range(9, 14)), "control": _set(range(0, 9), range(14, 32), 127),
}
_WIDE = ("capital", "small", "digit", "beyond_ascii", "space", "control")
FEATURES = (
    "log_words", "log_points", *(f"{c}_share" for c in _WIDE), *(f"{c}_per_word" for c in _CLASSES if c not in _WIDE),
    "word_length", "word_length_deviation", "longest_word", "short_words", "initial_capitals", "closing_marks", "distinct_words", "commonest_word", "stutter", "repeated_windows",
    "repeated_lines", "words_per_line", "closed_lines", "short_lines",
)
_POINT = (np.arange(256) & 0xC0) != 0x80
_ALNUM = _CLASSES["capital"] | _CLASSES["small"] | _CLASSES["digit"] | (np.arange(256) >= 0x80)


def statistics(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; a null text counts as empty, whose figures are all 0."""
    w = words_of(column, fold=False)
    n = len(w.first) - 1
    text, words = w.document_of_word(), np.diff(w.first)
    per_word, out = np.maximum(words, 1), {}
    spread = np.bincount(np.repeat(np.arange(n) * 256, np.diff(w.offsets)) + w.data, minlength=n * 256).reshape(n, 256)  # each text's bytes by value
    of_word = lambda values: np.bincount(text, values, n)[:n]
    points = spread @ _POINT
    for name, members in _CLASSES.items():
        count = spread @ members
        out[f"{name}_share" if name in _WIDE else f"{name}_per_word"] = count / (np.maximum(points, 1) if name in _WIDE else per_word)
    length = _sum_at(_POINT[w.data], w.starts, w.ends)
    mean = of_word(length) / per_word
    out |= {"log_words": np.log1p(words), "log_points": np.log1p(points), "word_length": mean}
    out["word_length_deviation"] = np.sqrt(of_word((length - mean[text]) ** 2) / per_word)
    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, text, length)
    out["longest_word"] = np.log1p(longest)
    out["short_words"] = of_word(length <= 3) / per_word
    out["initial_capitals"] = of_word(_CLASSES["capital"][w.data[w.starts]]) / per_word
    out["closing_marks"] = of_word(~_ALNUM[w.data[w.ends - 1]]) / per_word
    key = combine(text.astype(np.uint64), w.hashes)
    distinct, where, count = np.unique(key, return_index=True, return_counts=True)
    commonest = np.zeros(n, dtype=np.int64)
    np.maximum.at(commonest, text[where], count)
    out["distinct_words"] = np.bincount(text[where], minlength=n)[:n] / per_word
    out["commonest_word"] = commonest / per_word
    out["stutter"] = of_word(np.append(False, (key[1:] == key[:-1]))[: len(key)]) / per_word
    out["repeated_windows"] = of_word(repeated_words(w)) / per_word
    lines = _line_facts(w)
    some = lines["words"] > 0
    count = np.bincount(lines["doc"][some], minlength=n)[:n]
    per_line = np.maximum(count, 1)
    of_line = lambda flag: np.bincount(lines["doc"][some & flag], minlength=n)[:n] / per_line
    out["repeated_lines"] = of_line(_seen_before(lines["doc"], lines["number"]))
    out["words_per_line"] = np.log1p(words / per_line)
    last = np.maximum(lines["first"] + lines["words"] - 1, 0)
    closed = np.zeros(len(some), dtype=bool)
    if len(w.ends):
        closed = ~_ALNUM[w.data[w.ends[last] - 1]]
    out["closed_lines"] = of_line(closed)
    out["short_lines"] = of_line(lines["words"] < 4)
    return np.column_stack([out[name] for name in FEATURES]) if n else np.zeros((0, len(FEATURES)))


def learn_quality(docs: DataFrame, labels: DataFrame, how: QualityModel = QualityModel()) -> Trees:
    """Trees fitted on at most ``how.most_rows`` labelled texts, those whose identifiers hash lowest.

    Rows without label or identifier, and held-out rows, are left out; several labels of a
    text count as the worst.  The broadcast is of at most ``how.most_rows`` pairs of numbers.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)").filter(~held_out())
    marks = cut(marks.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(how.most_rows))
    sample = texts(docs).join(F.broadcast(marks), "doc_id").dropDuplicates(["doc_id", "text"])

    def measure(block: pa.RecordBatch) -> pa.RecordBatch:
        rows = statistics(block.column("text"))
        return pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("quality"), pa.array(list(rows), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    found = map_texts(sample, measure, "doc_id long, quality int, x array<double>").toArrow()
    rows = sorted(zip(found["doc_id"].to_pylist(), found["quality"].to_pylist(), found["x"].to_pylist()), key=lambda r: (r[0], r[2]))
    x = np.array([r[2] for r in rows]).reshape(-1, len(FEATURES))
    return fit_trees(x, np.array([float(r[1]) for r in rows]), how.boosting)


def score_quality(df: DataFrame, trees: Trees, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: ``score`` between 0 and 1, and ``predicted``, 1 from the threshold up.

    A null text scores as an empty one, whose statistics are all 0.  Null ids and
    repeated rows stay.  An empty table gives an empty table.  Only the two named
    columns are read.  Rows never leave their partition; the trees are some 50 kilobytes.
    """

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        s = trees.scores(statistics(block.column("text")))
        return pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return map_texts(texts(df, id_col, text_col), of_block, "doc_id long, score double, predicted int")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, how = table(spark, sf_dir, "documents"), QualityModel()
    trees = learn_quality(docs, table(spark, sf_dir, "labels"), how)
    return score_quality(docs, trees, how.threshold).select("doc_id", held_out().alias("held_out"), "score", "predicted")
