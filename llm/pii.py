"""Personal data: fixed patterns give seeds, seeds induce contexts, and trusted contexts find what no pattern names.

A context is a pair of words by an entity: the two before it, the two after it, or the one
on either side; digits count as alike.  Contexts and the strings seen in them form a
bipartite graph, which Spark scores by turns: a context is as reliable as the strings it
holds, and a string not among the seeds is as likely as its contexts say.  Round by round,
contexts with enough believed strings are looked for in all texts, whatever stands in them
joins the graph, the graph is scored, and the strings that trusted contexts reveal are
looked for in turn, to give further contexts.  Strings in trusted contexts become spans of
kind ``context``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.frames import cut, map_texts, table, texts
from llm.words import blocks_of, combine, words_of

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
#: Seeds beyond the four kinds: long hexadecimal keys.
SECRET = "secret"
CONTEXT = "context"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # with + it would try each digit of a long run anew
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HEX = re.compile(r"(?<![A-Za-z0-9])(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[A-Fa-f0-9]{32,64}(?![A-Za-z0-9])")
#: Marks around a word that are no part of a revealed string.
_STRIP = b"\"'`.,;:!?()[]{}<>#*$%&|=~"
_ALL_BUT_DIGITS = {i: None for i in range(128) if not 48 <= i <= 57}


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ so that long runs of letters cost nothing."""
    out, at, free = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Of a chain of dotted numbers, each four in turn; those with a part above 255 are dropped."""
    out = []
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        digits = m.group().translate(_ALL_BUT_DIGITS)
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(m.group().translate(_ALL_BUT_DIGITS)) <= 15]


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    return {
        "email": emails(text) if "@" in text else [],
        "ip": ips(text),
        "card": cards(text),
        "phone": phones(text) if "+" in text else [],
    }


def joined(kind: str, spans: list[tuple[int, int]]) -> list[str]:
    return [f"{kind}:{a}:{b}" for a, b in spans]


@dataclass(frozen=True)
class Bootstrap:
    """How contexts become trusted."""

    rounds: int = 3  # of looking for contexts, scoring, and looking for what was revealed
    sweeps: int = 3  # over the graph in each round
    least_seeds: int = 5  # different believed strings a trusted context has
    least_confidence: float = 0.7
    least_share: float = 0.35  # of a context's sightings that are of believed strings, for what else stands in it to be looked into
    longest_run: int = 3  # words of a string between two words of a context
    pass_numbers: int = 1_000_000  # contexts or strings sent to all tasks at once (8 MB); more are looked for in several passes


def seeds_of(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[int, int]]]:
    """Base spans, and secrets that overlap none of them."""
    base = base_spans(text)
    taken = sorted({span for spans in base.values() for span in spans})
    secrets, k = [], 0
    for m in _HEX.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if not any(a < m.end() and m.start() < b for a, b in taken[k : k + 4]):
            secrets.append(m.span())
    return base, secrets


class Around:
    """The words of several texts, and the contexts of any run of them, as numbers."""

    _EDGE = np.uint64(0x452821E638D01377)
    _KINDS = tuple(np.uint64(x) for x in (0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89))

    def __init__(self, column: pa.Array):
        self.words = w = words_of(column, fold="shape")
        n = len(w.hashes)
        doc = w.document_of_word()
        place, rest = np.arange(n) - w.first[doc], w.first[1:][doc] - np.arange(n) - 1
        self.l1, self.l2, self.r1, self.r2 = (np.full(n, self._EDGE) for _ in range(4))
        for k, left, right in ((1, self.l1, self.r1), (2, self.l2, self.r2)):
            left[k:] = np.where(place[k:] >= k, w.hashes[: n - k] if k <= n else w.hashes[:0], self._EDGE)
            right[: max(n - k, 0)] = np.where(rest[: max(n - k, 0)] >= k, w.hashes[k:], self._EDGE)
        self.rest = rest

    def contexts(self, a: np.ndarray, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of runs from word a to word b: each kind's numbers, and which runs have it (a text's edge alone is no context)."""
        pairs = ((self.l2[a], self.l1[a]), (self.l1[a], self.r1[b]), (self.r1[b], self.r2[b]))
        return [(combine(x ^ kind, y), (x != self._EDGE) | (y != self._EDGE)) for kind, (x, y) in zip(self._KINDS, pairs)]

    def within(self, wanted: np.ndarray, longest: int) -> np.ndarray:
        """Runs of up to ``longest`` words (of one, unless between two words of a context) in contexts of a sorted array: first word, last word, context's place."""
        hits = [np.zeros((3, 0), dtype=np.int64)]
        everywhere = np.arange(len(self.words.hashes))
        for run in range(1, longest + 1):
            a = everywhere[self.rest >= run - 1]
            for kind, (c, ok) in enumerate(self.contexts(a, a + run - 1)):
                if (run == 1 or kind == 1) and len(wanted):
                    at = np.searchsorted(wanted, c)
                    at[at == len(wanted)] = 0
                    yes = np.flatnonzero(ok & (wanted[at] == c))
                    hits.append(np.stack([a[yes], a[yes] + run - 1, at[yes]]))
        return np.concatenate(hits, axis=1)

    def characters(self, k: int) -> np.ndarray:
        """The byte at which each character of text k starts, from the text's first."""
        return np.flatnonzero((self.words.data[self.words.offsets[k] : self.words.offsets[k + 1]] & 0xC0) != 0x80)


def _stripped(raw: bytes) -> tuple[int, int]:
    """Where a run of words starts and ends without the marks around it."""
    lead = len(raw) - len(raw.lstrip(_STRIP))
    return lead, lead + len(raw.strip(_STRIP))


_SCANNED = (
    "doc_id long, h1 long, h2 long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, secrets string, "
    "found array<struct<instance: string, contexts: array<long>>>"
)


def _keyed(df: DataFrame, id_col: str | None, text_col: str) -> DataFrame:
    """doc_id, text (null as empty), and two hashes of the text, under which all that is found in it is kept."""
    docs = texts(df.withColumn("__none", F.lit(None)) if id_col is None else df, id_col or "__none", text_col)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))


def _scanned(docs: DataFrame) -> DataFrame:
    """Base spans and secrets of each text, and the contexts they stand in."""
    found_type = pa.list_(pa.struct([("instance", pa.string()), ("contexts", pa.list_(pa.int64()))]))
    empty = hashlib.sha256(b"").hexdigest()

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        column = block.column("text")
        marked = np.flatnonzero(pc.match_substring_regex(column, r"[0-9@]").to_numpy(zero_copy_only=False))
        n = block.num_rows
        counts, sha, base, secret, found = np.zeros((4, n), np.int64), [empty] * n, [""] * n, [""] * n, [[] for _ in range(n)]
        seen = {}
        for k in marked.tolist():
            text = column[k].as_py()
            spans, secrets = seeds_of(text)
            if any(spans.values()) or secrets:
                seen[k] = (text, [*sorted({x for s in spans.values() for x in s}), *secrets])
                base[k] = ",".join(x for kind in KINDS for x in joined(kind, spans[kind]))
                secret[k] = ",".join(joined(SECRET, secrets))
                counts[:, k] = [len(spans[kind]) for kind in KINDS]
                sha[k] = hashlib.sha256(base[k].encode()).hexdigest()
        if seen:
            rows = np.array(list(seen))
            around = Around(column.take(pa.array(rows)))
            w = around.words
            for j, (k, (text, spans)) in enumerate(seen.items()):
                at = np.append(around.characters(j), w.offsets[j + 1] - w.offsets[j]) + w.offsets[j]
                starts, ends = at[[a for a, _ in spans]], at[[b for _, b in spans]]
                a, b = np.searchsorted(w.starts, starts, side="right") - 1, np.searchsorted(w.starts, ends, side="left") - 1
                each = [(c.view(np.int64), ok) for c, ok in around.contexts(a, b)]
                found[k] = [{"instance": text[x:y].lower(), "contexts": [int(c[i]) for c, ok in each if ok[i]]} for i, (x, y) in enumerate(spans)]
        cols = [block.column(c) for c in ("doc_id", "h1", "h2")] + [pa.array(c) for c in counts]
        cols += [pa.array(x, type=pa.string()) for x in (sha, base, secret)] + [pa.array(found, type=found_type)]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "h1", "h2", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "secrets", "found"])

    return map_texts(docs, of_block, _SCANNED)


def _in_passes(wanted: DataFrame, how: Bootstrap, look: Callable[[Broadcast], DataFrame]) -> DataFrame:
    """All that ``look`` finds for the numbers in ``wanted`` (one column), which are sent to the tasks so many at a time."""
    spark, name = wanted.sparkSession, wanted.columns[0]
    passes = max(1, -(-wanted.count() // how.pass_numbers))
    out = None
    for k in range(passes):
        mine = wanted.filter(F.pmod(F.xxhash64(name), F.lit(passes)) == k).toArrow().column(0).to_numpy()
        part = cut(look(spark.sparkContext.broadcast(np.sort(mine.astype(np.int64).view(np.uint64)))))
        out = part if out is None else out.unionByName(part)
    return out


def _among(numbers: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(wanted, numbers)
    at[at == len(wanted)] = 0
    return wanted[at] == numbers if len(wanted) else np.zeros(len(numbers), bool)


def sightings(docs: DataFrame, contexts: DataFrame, how: Bootstrap) -> DataFrame:
    """context, n: how often anything stands in the given contexts.  Each task counts them all in one array."""

    def look(wanted: Broadcast) -> DataFrame:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers = wanted.value
            counts = np.zeros(len(numbers), dtype=np.int64)
            for batch in batches:
                for block in blocks_of(batch):
                    counts += np.bincount(Around(block.column("text")).within(numbers, how.longest_run)[2], minlength=len(numbers))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(numbers[some].view(np.int64)), pa.array(counts[some])], names=["context", "n"])

        return docs.select("text").mapInArrow(each, "context long, n long")

    return _in_passes(contexts, how, look).groupBy("context").agg(F.sum("n").alias("n"))


_SLOTS = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("context", pa.int64())])


def slots(docs: DataFrame, contexts: DataFrame, how: Bootstrap) -> DataFrame:
    """h1, h2, start, end, instance, context: what stands in the given contexts but overlaps no seed."""

    def look(wanted: Broadcast) -> DataFrame:
        def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
            column, numbers = block.column("text"), wanted.value
            around = Around(column)
            w = around.words
            first, last, at = around.within(numbers, how.longest_run)
            order = np.argsort(first, kind="stable")
            first, last, context = first[order], last[order], numbers.view(np.int64)[at[order]] if len(at) else at
            doc = np.searchsorted(w.first, first, side="right") - 1
            h1, h2 = (block.column(c).to_numpy() for c in ("h1", "h2"))
            rows: list[tuple] = []
            raw = w.data.tobytes()
            for k in np.unique(doc).tolist():
                text, at, low = column[k].as_py(), around.characters(k), int(w.offsets[k])
                spans, secrets = seeds_of(text)
                taken = np.array(sorted({*secrets, *(x for s in spans.values() for x in s)}), dtype=np.int64).reshape(-1, 2)
                reach = np.maximum.accumulate(taken[:, 1]) if len(taken) else taken[:, 1]
                for j in np.flatnonzero(doc == k).tolist():
                    a, e = int(w.starts[first[j]]), int(w.ends[last[j]])
                    x, y = _stripped(raw[a:e])
                    if y <= x:
                        continue
                    s, t = (int(v) for v in np.searchsorted(at, [a + x - low, a + y - low]))
                    before = int(np.searchsorted(taken[:, 0], t))  # seeds that start before the end
                    if not before or reach[before - 1] <= s:
                        rows.append((int(h1[k]), int(h2[k]), s, t, text[s:t].lower(), int(context[j])))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(_SLOTS)], schema=_SLOTS)

        return map_texts(docs, of_block, "h1 long, h2 long, start long, end long, instance string, context long")

    return _in_passes(contexts, how, look)


def occurrences(docs: DataFrame, strings: DataFrame, how: Bootstrap) -> DataFrame:
    """context, instance: the contexts in which given strings (column instance) stand as single words, anywhere."""
    spark = strings.sparkSession
    passes = max(1, -(-strings.count() // how.pass_numbers))
    out = None
    for k in range(passes):
        mine = strings.filter(F.pmod(F.xxhash64("instance"), F.lit(passes)) == k).toArrow().column("instance").combine_chunks()
        mine = mine.filter(pc.invert(pc.match_substring_regex(mine, r"[\x20\x09-\x0D]")))
        sent = spark.sparkContext.broadcast((frozenset(mine.to_pylist()), np.sort(words_of(mine).hashes)))

        def of_block(block: pa.RecordBatch, sent=sent) -> pa.RecordBatch:
            column, (names, numbers) = block.column("text"), sent.value
            w = words_of(column, strip=_STRIP)
            yes = np.flatnonzero(_among(w.hashes, numbers))
            rows: list[tuple[int, str]] = []
            if len(yes):
                around, raw = Around(column), w.data.tobytes()
                each = [(c.view(np.int64), ok) for c, ok in around.contexts(yes, yes)]
                for j, i in enumerate(yes.tolist()):
                    a, e = int(w.starts[i]), int(w.ends[i])
                    x, y = _stripped(raw[a:e])
                    name = raw[a + x : a + y].decode().lower()
                    if name in names:
                        rows += [(int(c[j]), name) for c, ok in each if ok[j]]
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([n for _, n in rows], pa.string())], names=["context", "instance"])

        part = cut(map_texts(docs, of_block, "context long, instance string"))
        out = part if out is None else out.unionByName(part)
    return out


def trusted_contexts(edges: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """Contexts whose strings are believed.  ``edges``: context, instance, seed; one row for each sighting or pair.

    All contexts stay in the graph.  Sweep by sweep, a context with at least
    ``least_seeds`` different believed strings, seeds or revealed ones, has as its
    confidence the mean belief in its strings, smoothed by two disbelieved ones; a
    string that is no seed is believed as far as its contexts of enough confidence say,
    and so can support further contexts.  Counts combine on the map side, so one
    frequent context is no hot group.
    """
    pairs = cut(edges.groupBy("context", "instance").agg(F.max(F.col("seed").cast("double")).alias("belief")))
    believed = pairs.filter("belief = 0")
    contexts = None
    for _ in range(how.sweeps):
        rows = pairs.select("context", "instance", "belief")
        if contexts is not None:
            better = believed.join(contexts, "context").groupBy("instance").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("raised"))
            rows = rows.join(better, "instance", "left").select("context", F.greatest("belief", F.coalesce("raised", F.lit(0.0))).alias("belief"))
        scored = rows.groupBy("context").agg((F.sum("belief") / (F.count("*") + 2)).alias("confidence"), F.count_if(F.col("belief") >= how.least_confidence).alias("support"))
        contexts = cut(scored.filter((F.col("support") >= how.least_seeds) & (F.col("confidence") >= how.least_confidence)).select("context", "confidence"))
    return contexts


def revealed(docs: DataFrame, seeds: DataFrame, how: Bootstrap) -> DataFrame:
    """h1, h2, start, end: what stands in trusted contexts.  ``seeds``: context, instance; a row for each sighting of a seed.

    A context's sightings are counted once it has ``least_seeds`` different believed
    strings, and what else stands in it is looked into once ``least_share`` of them are
    of believed strings: so the graph grows with the seeds, and words that stand
    everywhere, like ``of the``, stay out.  A revealed string is looked for once.  Ends
    when a round brings nothing new.
    """
    support = cut(seeds.groupBy("context", "instance").agg(F.count("*").alias("n")))
    seeds, seen, totals, looked, asked, inside = support.select("context", "instance"), None, None, None, None, None
    new_of = lambda df, before, key: cut(df if before is None else df.join(before.select(key), key, "left_anti"))
    more = lambda before, df: df if before is None else cut(before.unionByName(df))
    for step in range(how.rounds):
        ready = support.groupBy("context").agg(F.sum("n").alias("believed"), F.count("*").alias("strings")).filter(F.col("strings") >= how.least_seeds).select("context", "believed")
        new = new_of(ready.select("context"), totals, "context")
        if not new.isEmpty():
            totals = more(totals, cut(new.join(sightings(docs, new, how), "context", "left").select("context", F.coalesce("n", F.lit(0)).alias("n"))))
        if totals is None:
            break
        rich = ready.join(totals, "context").filter(F.col("believed") >= how.least_share * F.greatest("believed", "n")).select("context")
        new = new_of(rich, looked, "context")
        if new.isEmpty():
            break
        looked = more(looked, new)
        found = slots(docs, new, how)
        seen = found if seen is None else seen.unionByName(found)
        edges = seeds.join(looked, "context", "left_semi").withColumn("seed", F.lit(True)).unionByName(seen.select("context", "instance", F.lit(False).alias("seed")))
        inside = seen.join(trusted_contexts(edges, how).select("context"), "context")
        if step + 1 == how.rounds:
            break
        strings = new_of(inside.select("instance").distinct(), asked, "instance")
        if strings.isEmpty():
            break
        asked = more(asked, strings)
        support = cut(support.unionByName(occurrences(docs, strings, how).groupBy("context", "instance").agg(F.count("*").alias("n"))))
    if inside is None:
        return docs.select("h1", "h2", F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")).filter("false")
    return inside.select("h1", "h2", "start", "end").distinct()


def without_overlaps(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """From the left, the longest first; what overlaps one taken goes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def _found(df: DataFrame, how: Bootstrap, id_col: str | None, text_col: str) -> DataFrame:
    """What ``_scanned`` has but found, and the spans in trusted contexts: more, an array of start and end, or null."""
    docs = _keyed(df, id_col, text_col)
    seen = cut(_scanned(docs))
    seeds = seen.select(F.explode("found").alias("x")).select(F.explode("x.contexts").alias("context"), "x.instance")
    more = revealed(docs, seeds, how).groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "end")).alias("more"))  # as many as a text has words, times the run
    return seen.drop("found").join(more, ["h1", "h2"], "left")


def personal_data(df: DataFrame, how: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: counts by kind, the base spans' digest, all spans, and how many.

    Spans are ``kind:start:end`` in code points, end exclusive: the four kinds in
    order, then ``secret`` seeds, then strings that trusted contexts reveal.  Of
    revealed strings that overlap, the leftmost and then the longest stays; none
    overlaps a seed.  A null text counts as empty.  Repeated rows stay repeated, and
    equal texts have equal spans.  An empty table gives an empty table.  Only the two
    named columns are read.

    Texts are read once for seeds and up to three times a round after that.  What they hold (spans
    and contexts, no text) is written to the shared folder; the graph and the result are
    made from that.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, secrets, more = (batch.column(c).to_pylist() for c in ("base", "secrets", "more"))
            kept = [[b, s, *joined(CONTEXT, without_overlaps([(x["start"], x["end"]) for x in m or ()]))] for b, s, m in zip(base, secrets, more)]
            spans = [",".join(x for x in each if x) for each in kept]
            cols = [batch.column(c) for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")]
            cols += [pa.array(spans, pa.string()), pa.array([x.count(",") + 1 if x else 0 for x in spans], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])

    return _found(df, how, id_col, text_col).mapInArrow(lines, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def redact(text: str | None, spans: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are replaced together."""
    if not text or not spans:
        return text
    found = sorted((int(a), int(b), kind) for kind, a, b in (x.split(":") for x in spans.split(",")))
    out, at = [], 0
    for a, b, kind in found:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_rows(df: DataFrame, how: Bootstrap = Bootstrap(), text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with personal data in ``text_col`` replaced; all columns and their order stay.

    Contexts are learned over the whole table first.  What was found is looked up by two
    hashes of the text: broadcast while texts with spans number at most 100,000, else
    joined by a shuffle.  Null texts stay null, and repeated rows repeat.
    """
    names = df.columns
    found = _found(df, how, None, text_col).filter("base <> '' or secrets <> '' or more is not null")
    found = cut(found.select("h1", "h2", "base", "secrets", "more").dropDuplicates(["h1", "h2"]))
    if found.count() <= 100_000:
        found = F.broadcast(found)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    schema = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).schema
    rows = rows.join(found, ["h1", "h2"], "left").select("row", "base", "secrets", "more")

    def of_block(block: pa.RecordBatch) -> pa.RecordBatch:
        row, at = block.column("row"), names.index(text_col)
        column = row.field(at)
        some = [k for k, (b, m) in enumerate(zip(block.column("base").is_valid().to_pylist(), block.column("more").is_valid().to_pylist())) if b or m]
        if not some:
            return pa.RecordBatch.from_arrays([row], names=["row"])
        out = column.to_pylist()
        for k in some:
            more = joined(CONTEXT, without_overlaps([(x["start"], x["end"]) for x in block.column("more")[k].as_py() or ()]))
            out[k] = redact(out[k], ",".join(x for x in (block.column("base")[k].as_py(), block.column("secrets")[k].as_py(), *more) if x))
        fields = [pa.array(out, type=column.type) if i == at else row.field(i) for i in range(row.type.num_fields)]
        return pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=list(row.type))], names=["row"])

    def each_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield of_block(batch)

    return rows.mapInArrow(each_batch, schema).select(*[F.col("row")[c].alias(c) for c in names])


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
