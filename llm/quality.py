"""Line-first cleaning: rules judge lines, failing lines go, and texts that lose too much are rejected."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.frames import map_texts, table, texts
from llm.words import _EXACT, _SPACE, Words, _power, combine, mix64, words_of

#: A line with one of these phrases is boilerplate.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "use cookies", "privacy policy", "terms of use", "terms of service", "enable javascript",
    "click here", "read more", "subscribe to our", "sign up for", "share this", "lorem ipsum", "skip to content", "powered by",
)
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[list(b"|>")] = True
_END = np.zeros(256, dtype=bool)
_END[list(b".!?:;)]}\"'")] = True
WINDOW = 5


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the verdict on texts."""

    short_words: int = 3  # an unpunctuated line of fewer words is debris
    navigation_percent: int = 20  # separators per hundred words
    symbol_percent: int = 20  # symbols per hundred words
    shouting_percent: int = 70  # capitals per hundred ASCII letters
    shouting_words: int = 5
    repeat_percent: int = 60  # words in repeated windows per hundred words
    stutter_percent: int = 40  # words equal to the word before per hundred words
    lost_percent: int = 30  # a text losing more of its word characters is rejected


def _line_facts(w: Words) -> dict[str, np.ndarray]:
    """Lines of all texts, with where they lie, the words they hold and a number for their bytes."""
    data, n = w.data, len(w.data)
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([w.offsets[:-1], breaks + 1]))
    starts = starts[starts < n]
    doc = np.searchsorted(w.offsets, starts, side="right") - 1
    ends = np.append(starts[1:], n)
    body = np.where(data[ends - 1] == 10, ends - 1, ends) if n else ends
    if n:
        terms = _EXACT[data] * _power("up", n)
        terms[breaks] = 0
        number = mix64(np.add.reduceat(terms, starts) * _power("down", n)[starts] + (body - starts).astype(np.uint64)) if len(starts) else np.zeros(0, np.uint64)
    else:
        number = np.zeros(0, np.uint64)
    first = np.searchsorted(w.starts, starts)
    return {"start": starts, "end": body, "doc": doc, "first": first, "words": np.diff(np.append(first, len(w.starts))), "number": number}


def _seen_before(doc: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Whether an equal number came earlier in the same text."""
    key = combine(doc.astype(np.uint64), number)
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return again


def repeated_words(w: Words, size: int = WINDOW) -> np.ndarray:
    """Whether each word lies in a window of ``size`` words that its text has twice or more."""
    n, out = len(w.hashes), np.zeros(len(w.hashes), dtype=bool)
    if n < size:
        return out
    doc = w.document_of_word()
    gram = w.hashes[: n - size + 1].copy()
    for k in range(1, size):
        gram = combine(gram, w.hashes[k : n - size + 1 + k])
    gram = combine(gram, doc[: n - size + 1].astype(np.uint64))
    whole = np.flatnonzero(doc[: n - size + 1] == doc[size - 1 :])
    gram = gram[whole]
    order = np.argsort(gram, kind="stable")
    same = gram[order[1:]] == gram[order[:-1]]
    twice = np.zeros(len(gram), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = whole[twice]
    for k in range(size):
        out[at + k] = True
    return out


def _sum_at(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def _phrases(w: Words, lines: dict[str, np.ndarray]) -> np.ndarray:
    """Which lines hold a phrase of BOILERPLATE; nearly all texts are dismissed by one search for each phrase."""
    hit = np.zeros(len(lines["start"]), dtype=bool)
    low = w.data.tobytes().lower()
    for phrase in BOILERPLATE:
        p, at = phrase.encode(), 0
        while (at := low.find(p, at)) >= 0:
            k = int(np.searchsorted(lines["start"], at, side="right")) - 1
            hit[k] |= at + len(p) <= lines["end"][k]
            at += len(p)
    return hit


def judge(column: pa.Array, rules: LineRules) -> dict[str, np.ndarray]:
    """Figures and verdicts for an Arrow column of texts."""
    w = words_of(column, fold=False)
    n = len(w.first) - 1
    offsets = w.offsets
    lines = _line_facts(w)
    byte_chars = (w.data & 0xC0) != 0x80
    word_char = byte_chars & ~_SPACE[w.data]
    repeat = repeated_words(w)
    again = _seen_before(lines["doc"], lines["number"]) & (lines["words"] > 0)
    n_words = np.diff(w.first)
    n_repeat = _sum_at(repeat, w.first[:-1], w.first[1:])

    some = lines["words"] > 0
    last = lines["first"] + lines["words"] - 1
    close = np.zeros(len(some), dtype=bool)
    if len(w.ends):
        tail = w.data[w.ends[np.maximum(last, 0)] - 1]
        close = _END[tail] | (tail >= 0x80)  # closing quotes and ellipses beyond ASCII end a sentence too
    in_line = lambda flag: _sum_at(flag, lines["start"], lines["end"])
    letters, capitals = in_line(_LETTER[w.data]), in_line(_UPPER[w.data])
    bad = some & ~close & (lines["words"] < rules.short_words)
    bad |= some & (100 * in_line(_SEPARATOR[w.data]) > rules.navigation_percent * lines["words"])
    bad |= some & (100 * in_line(_SYMBOLS[w.data]) > rules.symbol_percent * lines["words"])
    bad |= (lines["words"] >= rules.shouting_words) & (letters > 0) & (100 * capitals > rules.shouting_percent * letters)
    bad |= some & (100 * _sum_at(repeat, lines["first"], lines["first"] + lines["words"]) > rules.repeat_percent * lines["words"])
    stutter = np.zeros(len(w.hashes), dtype=bool)
    stutter[1:] = w.hashes[1:] == w.hashes[:-1]
    stutter[w.first[:-1][w.first[:-1] < len(stutter)]] = False
    bad |= some & (100 * _sum_at(stutter, lines["first"], lines["first"] + lines["words"]) > rules.stutter_percent * lines["words"])
    bad |= again | _phrases(w, lines)

    chars_line = in_line(word_char)
    word_chars = _sum_at(word_char, offsets[:-1], offsets[1:])
    lost = np.bincount(lines["doc"][bad], weights=chars_line[bad], minlength=n)[:n].astype(np.int64)
    base_failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": _sum_at(_SYMBOLS[w.data], offsets[:-1], offsets[1:]),
        "n_dup_lines": np.bincount(lines["doc"][again], minlength=n)[:n], "n_repeat_words": n_repeat, "lost_chars": lost,
        "n_bad_lines": np.bincount(lines["doc"][bad], minlength=n)[:n], "base_failed": base_failed,
        "kept": ~base_failed & (100 * lost <= rules.lost_percent * word_chars),
        "_lines": lines, "_bad": bad, "_words": w,
    }


def clean_lines(column: pa.Array, found: dict[str, np.ndarray]) -> pa.Array:
    """The texts without their failing lines."""
    w, lines, bad = found["_words"], found["_lines"], found["_bad"]
    raw = w.data.tobytes()
    out: list[list[str]] = [[] for _ in range(len(w.first) - 1)]
    for k in range(len(bad)):
        if not bad[k]:
            out[lines["doc"][k]].append(raw[lines["start"][k] : lines["end"][k]].decode())
    return pa.array(["\n".join(x) for x in out], type=pa.string())


_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "lost_chars")
SCHEMA = ", ".join(["doc_id long", *(f"{x} long" for x in _FIELDS), "base_failed boolean", "kept boolean"])


def line_quality(df: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text", cleaned: bool = False) -> DataFrame:
    """One row for each row of ``df``: figures, ``base_failed`` and ``kept``; with ``cleaned`` also the text without failing lines.

    A null text counts as empty: no words, so ``base_failed`` and not kept.  Null ids
    stay null.  Repeated rows give repeated rows.  An empty table gives an empty table.
    Only the two named columns are read, so others may have any name.  Rows never
    leave their partition: there is no shuffle, and a block of about 1 MB of text (or
    one longer text) is in memory at a time.
    """

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(block.column("text"), rules)
        cols = [block.column("doc_id"), *(pa.array(found[x], type=pa.int64()) for x in _FIELDS), pa.array(found["base_failed"]), pa.array(found["kept"])]
        names = ["doc_id", *_FIELDS, "base_failed", "kept"]
        if cleaned:
            cols.append(clean_lines(block.column("text"), found))
            names.append("cleaned_text")
        return pa.RecordBatch.from_arrays(cols, names=names)

    return map_texts(texts(df, id_col, text_col), of_block, SCHEMA + ", cleaned_text string" * cleaned)


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("n_bad_lines"), F.col("lost_chars"))
