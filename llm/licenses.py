"""Licence scans: windows of normalised text against licence templates, by Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from llm.frames import map_texts, table, texts
from llm.license_texts import TEMPLATES

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")


@dataclass(frozen=True)
class LicenseScan:
    threshold: float = 0.9  # least Dice coefficient


def normalised(text: str) -> list[str]:
    """Words, lower-cased, without punctuation; version numbers keep their points."""
    return _WORD.findall(text.lower())


def dice(a: Counter, b: Counter) -> float:
    """Twice the shared bigrams over all, with multiplicity."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Templates:
    """Bigrams of the templates, ordered by size so that a size bound is a range."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        made = []
        for k, (name, text) in enumerate(templates):
            w = normalised(text)
            made.append((len(w) - 1, k, name, Counter(zip(w, w[1:]))))
        made.sort(key=lambda x: x[:2])
        self.sizes = np.array([x[0] for x in made])
        self.names = [x[2] for x in made]
        self.bigrams = [x[3] for x in made]
        self.known = {b for x in self.bigrams for b in x}
        self.leads = {a for a, _ in self.known}

    def best(self, found: Counter, threshold: float) -> tuple[float, str] | None:
        """The best template at or above the threshold; equal ones by name.

        Sizes a and b allow a coefficient of 2 * min(a, b) / (a + b) at most, so only
        templates between t / (2 - t) and (2 - t) / t of the stretch's size are compared.
        """
        n = found.total()
        low = int(np.searchsorted(self.sizes, np.ceil(n * threshold / (2 - threshold) - 1e-9)))
        high = int(np.searchsorted(self.sizes, np.floor(n * (2 - threshold) / threshold + 1e-9), side="right"))
        hits = [(dice(found, self.bigrams[k]), self.names[k]) for k in range(low, high)]
        hits = [h for h in hits if h[0] >= threshold]
        return min(hits, key=lambda h: (-h[0], h[1])) if hits else None


def windows(at: list[int], grams: list[tuple[str, str]], template: Counter, threshold: float) -> list[tuple[int, int, float, int]]:
    """Windows that reach the threshold for one template: first and last bigram, the coefficient, and bigrams shared over those not.

    ``at``, ``grams``: places of bigrams that any template has, and the bigrams.  The
    best window begins and ends at bigrams of the template, so only those are tried,
    and of each first one the best last one is kept.  A window at the threshold shares
    t / (2 - t) of the template's size at least and is (2 - t) / t of it long at most.
    """
    mine = [(k, g) for k, g in zip(at, grams) if g in template]
    n = template.total()
    need, most = n * threshold / (2 - threshold) - 1e-9, n * (2 - threshold) / threshold + 1e-9
    if len(mine) < need:
        return []
    out, end = [], 0
    for i, (first, _) in enumerate(mine):
        while end < len(mine) and mine[end][0] - first + 1 <= most:
            end += 1
        if end - i < need:
            continue
        used: Counter = Counter()
        shared, best = 0, None
        for last, g in mine[i:end]:
            used[g] += 1
            if used[g] <= template[g]:
                shared += 1
                score = 2 * shared / (last - first + 1 + n)
                if score >= threshold and (best is None or score > best[2]):
                    best = (first, last, score, 3 * shared - (last - first + 1) - n)
        if best:
            out.append(best)
    return out


def scan(text: str, templates: Templates, how: LicenseScan) -> list[tuple[str, float]]:
    """Licences in a text and their coefficients, in order of place.

    Each template is looked for in all windows of the text.  Of windows that overlap
    the one that shares most beyond what either side has alone is kept, so notices
    that stand side by side are all found, edited or not, and a long notice wins over a
    short one it begins with.
    """
    words = normalised(text)
    leads, known = templates.leads, templates.known
    at = [k for k in range(len(words) - 1) if words[k] in leads and (words[k], words[k + 1]) in known]
    grams = [(words[k], words[k + 1]) for k in at]
    have = set(grams)
    found = []
    for name, template in zip(templates.names, templates.bigrams) if have else ():
        if sum(c for g, c in template.items() if g in have) * (2 - how.threshold) >= how.threshold * template.total() - 1e-9:
            found += [(-gain, -score, name, a, b) for a, b, score, gain in windows(at, grams, template, how.threshold)]
    kept: list[tuple[int, int, str, float]] = []
    taken = bytearray(len(words))
    for _, score, name, a, b in sorted(found):
        if not any(taken[a : b + 2]):
            taken[a : b + 2] = b"\x01" * (b + 2 - a)
            kept.append((a, b, name, -score))
    return [(name, score) for _, _, name, score in sorted(kept)]


#: What templates have some of; no filter, as a text may break or edit these.
_HINT = re.compile(r"licen[sc]|permission|redistribut|copyright|as.is|public domain|free software|waived", re.I)


def license_scan(df: DataFrame, how: LicenseScan = LicenseScan(), id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_matches, licenses, best_license, best_dice: one row for each row of ``df``.

    ``licenses`` are the distinct licences found, sorted and joined by commas.  A text
    without any, or null, has 0 matches, an empty list, a null licence and a
    coefficient of 0.  Repeated rows and null identifiers stay.  An empty table gives
    an empty table.  Only the two named columns are read; rows never leave their
    partition.  Every text is scanned.
    """
    made = Templates(templates)

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        n, names, best, score = [], [], [], []
        for text in block.column("text").to_pylist():
            found = scan(text, made, how) if text else []
            n.append(len(found))
            names.append(",".join(sorted({x for x, _ in found})))
            top = min(found, key=lambda x: (-x[1], x[0]), default=(None, 0.0))
            best.append(top[0])
            score.append(float(top[1]))
        cols = [block.column("doc_id"), pa.array(n, pa.int64()), pa.array(names, pa.string()), pa.array(best, pa.string()), pa.array(score, pa.float64())]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_matches", "licenses", "best_license", "best_dice"])

    return map_texts(texts(df, id_col, text_col), of_block, "doc_id long, n_matches long, licenses string, best_license string, best_dice double")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
