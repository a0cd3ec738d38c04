"""What no built-in expression gives: Arrow functions on whole batches."""

from __future__ import annotations

import difflib
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"[a-z0-9]+")


def _plain(text: str | None) -> str | None:
    if text is None:
        return None
    flat = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return " ".join(_TOKEN.findall(flat.casefold()))


def normalize_names(text: Column) -> Column:
    """Accents dropped (é is e), folded, runs of a-z0-9 joined by spaces.  Used for titles and authors when linking."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(_plain)

    return run(text)


def sequence_ratio(a: Column, b: Column) -> Column:
    """Share of characters in matching blocks."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)], dtype="float64")

    return run(a, b)


_OTHER = re.compile(r"[^a-z0-9]+")


def phrases_in(text: Column, phrases: list[str]) -> Column:
    """The distinct phrases, words joined by spaces, that folded text has as whole words, in order of place."""
    by_first: dict[str, list[tuple[int, str]]] = {}
    for p in phrases:
        by_first.setdefault(p.split(" ", 1)[0], []).append((p.count(" ") + 1, p))

    def of(t: str | None) -> list[str]:
        words = _OTHER.sub(" ", (t or "").casefold()).split()
        found: dict[str, None] = {}
        for k, w in enumerate(words):
            for n, p in by_first.get(w, ()):
                if n == 1 or " ".join(words[k : k + n]) == p:
                    found[p] = None
        return list(found)

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(of)

    return run(text)


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data):
        if not data.isspace():
            self.parts.append(data)


#: Marks that take no space on their left, on their right, and on either side.
_CLOSE = ",.;:!?%)]}\u00bb\u201d\u2019"
_OPEN = "([{\u00ab\u201c\u2018"
_JOIN = "-'\u2010\u2011\u2012\u2013\u2014/\\"
_TIGHT = re.compile(rf"(?:[\s{re.escape(_OPEN + _JOIN)}]\0|\0[\s{re.escape(_CLOSE + _JOIN)}])")


def plain_text(html: str | None) -> str | None:
    """Text between tags, all of it (that of scripts and styles, too), white space as single spaces.

    Between fragments a space is added unless there is white space, or a mark that takes
    none on that side.
    """
    if html is None:
        return None
    p = _Text()
    p.feed(html)
    p.close()
    seams = _TIGHT.sub(lambda m: m.group().replace("\0", ""), "\0".join(x.replace("\0", "") for x in p.parts))
    return " ".join(seams.replace("\0", " ").split())


def html_to_text(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(plain_text)

    return run(html)
