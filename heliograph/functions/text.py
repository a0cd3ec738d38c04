"""Text normalisation, phrases and n-grams as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters whose full case folding has letters a-z that lower-casing doesn't give.
_FOLDS = (
    ("ß", "ss"), ("ẞ", "ss"), ("\u0149", "\u02bcn"), ("ſ", "s"), ("\u01f0", "j\u030c"), ("\u1e96", "h\u0331"), ("\u1e97", "t\u0308"), ("\u1e98", "w\u030a"), ("\u1e99", "y\u030a"), ("\u1e9a", "a\u02be"),
    ("\ufb00", "ff"), ("\ufb01", "fi"), ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl"), ("\ufb05", "st"), ("\ufb06", "st"),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once a row, however often the body has it: branches don't share subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def casefold(text: Column) -> Column:
    """Lower case, and the folds that add ASCII letters; enough before everything outside a-z0-9 becomes a space."""
    low = out = F.lower(text)
    for a, b in _FOLDS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(low.rlike("[" + "".join(a for a, _ in _FOLDS) + "]"), out).otherwise(low)  # few texts have one, and each fold is a pass over the text


def normalize_words(text: Column) -> Column:
    """Folded text with each run outside a-z0-9 as one space, trimmed.  Accented letters become spaces."""
    return F.trim(F.regexp_replace(casefold(text), "[^a-z0-9]+", " "))


def contains_phrase(text: Column, phrase: Column) -> Column:
    """Whether normalised text has the normalised phrase as whole words; an empty phrase is nowhere."""
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    return (phrase != "") & F.contains(pad(text), pad(phrase))


def anchor_matches(text: Column, anchor: str) -> Column:
    """``stem*`` begins a token; several words are a phrase; one word is a token.  ``text`` is normalised."""
    a = anchor.strip()
    if a.endswith("*"):
        return F.contains(F.concat(F.lit(" "), text), F.lit(" " + a[:-1]))
    return contains_phrase(text, F.lit(a))


def compact(text: Column, most: int, empty_is_null: bool = False) -> Column:
    """White space as single spaces; longer text is cut to ``most`` characters with an ellipsis."""
    flat = F.trim(F.regexp_replace(text, r"(?U)[\s\x{1c}-\x{1f}]+", " "))
    out = F.when(F.length(flat) <= most, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, most - 1)), F.lit("…")))
    return F.when(out == "", None).otherwise(out) if empty_is_null else out


def tokens(text: Column) -> Column:
    """Words of normalised text; none of an empty one."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def word_ngrams(words: Column, low: int, high: int) -> Column:
    """Runs of ``low`` to ``high`` words, joined by spaces.

    Runs of n words are runs of n - 1 words zipped with the words from the n-th on, so
    ``words`` is evaluated once a length, not once an element as in a lambda's body.
    """
    runs, out = words, []
    for n in range(1, high + 1):
        if n > 1:
            tail = F.slice(words, F.lit(n), F.greatest(F.size(words), F.lit(1)))
            runs = F.filter(F.zip_with(runs, tail, lambda a, b: F.concat(a, F.lit(" "), b)), lambda g: g.isNotNull())
        if n >= low:
            out.append(runs)
    return F.concat(*out)


def _part_of(word: Column, n: int):
    return lambda i: F.substring(word, i, F.lit(n))


def char_ngrams(words: Column, low: int, high: int) -> Column:
    """Runs of ``low`` to ``high`` characters inside each word with a space on either side."""
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def of(word: Column) -> Column:
        parts = []
        for n in range(low, high + 1):
            at = F.when(F.length(word) >= n, F.sequence(F.lit(1), F.length(word) - n + 1)).otherwise(F.array().cast("array<int>"))
            parts.append(F.transform(at, _part_of(word, n)))
        return F.concat(*parts)

    return F.flatten(F.transform(padded, of))


def escape_markdown(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("["), F.lit("\\[")), F.lit("]"), F.lit("\\]"))


def search_score(words: list[str], phrase: str, title: Column, extra: Column, summary: Column) -> Column:
    """Per word the best of title 10, other fields 5, summary 3; a word found nowhere makes 0; the phrase in the title adds 30."""
    if not words:
        return F.lit(0)
    each = [F.when(F.contains(title, F.lit(w)), 10).when(F.contains(extra, F.lit(w)), 5).when(F.contains(summary, F.lit(w)), 3).otherwise(0) for w in words]
    every, total = F.lit(True), F.lit(0)
    for e in each:
        every, total = every & (e > 0), total + e
    return F.when(every, total + F.when(F.contains(title, F.lit(phrase)), 30).otherwise(0)).otherwise(0)
