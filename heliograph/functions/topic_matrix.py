"""Similarities of texts to topic profiles on whole batches: a text's features are counted, weighed and multiplied in its task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Similarities are rounded to six places before they are compared.
SLACK = 2e-6


#: Bytes to symbols: a space is 0, then letters and digits; normalised texts have no others.
_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = np.arange(1, 37)


class Grams:
    """Runs of characters as a tree: each step of all places of a text is one look into a table."""

    def __init__(self, grams: dict[str, int], low: int, high: int) -> None:
        self.low, self.high = low, high
        nodes, steps, ends = {"": 0}, [], []
        for gram, k in grams.items():
            for n in range(1, len(gram) + 1):
                if gram[:n] not in nodes:
                    nodes[gram[:n]] = len(nodes)
                    steps.append((nodes[gram[: n - 1]] * 37 + int(_SYMBOL[ord(gram[n - 1])]), nodes[gram[:n]]))
            ends.append((nodes[gram], k))
        self.next = np.full((len(nodes) + 1) * 37, len(nodes), np.int32)  # the last node leads nowhere but to itself
        self.feature = np.full(len(nodes) + 1, -1, np.int32)
        if grams:
            at, to = np.array(steps).T
            self.next[at] = to
            at, to = np.array(ends).T
            self.feature[at] = to

    def found(self, texts: list[str], width: int) -> list[np.ndarray]:
        """Number of the text times ``width`` plus the feature, of each run inside a word with a space on either side."""
        padded = [f" {t.replace(' ', '  ')} " if t else "" for t in texts]
        row = np.repeat(np.arange(len(texts)) * width, np.fromiter(map(len, padded), np.int64, len(padded)))
        symbol = _SYMBOL[np.frombuffer("".join(padded).encode("ascii"), np.uint8)]
        node, out = np.zeros(len(symbol), np.int32), []
        for n in range(1, self.high + 1):
            if n > len(symbol):
                break
            node = self.next[node[: len(symbol) - n + 1] * 37 + symbol[n - 1 :]]
            if n >= self.low:
                f = self.feature[node]
                at = np.flatnonzero(f >= 0)
                out.append(row[at] + f[at])
        return out


class TopicMatrix:
    """Profiles of some topics, and the weights of the features that any topic has.

    ``names``: the features, w:… and c:…; ``weights``: their idf times the weight of their
    kind.  ``entries``: a feature, a topic (both numbers) and the value in the topic's unit
    vector.  Features that many topics have are multiplied as a dense matrix, others entry by
    entry.  ``lengths``: shortest and longest run of words and of characters.
    """

    most_cells, most_chars = 2_000_000, 1 << 20

    def __init__(self, names: list[str], weights: np.ndarray, topics: int, entries: tuple[np.ndarray, np.ndarray, np.ndarray], lengths: tuple[int, int, int, int]) -> None:
        self.low, self.high, char_low, char_high = lengths
        self.weights, self.topics, self.width = weights, topics, max(1, len(names))
        grams = {name[2:]: k for k, name in enumerate(names) if name.startswith("c:")}
        runs = [(name[2:].split(" "), k) for k, name in enumerate(names) if name.startswith("w:")]
        self.places = places = {w: k for k, w in enumerate(sorted({w for run, _ in runs for w in run}))}
        self.grams = Grams(grams, char_low, char_high)
        self.base = max(1, len(places))
        self._tree([([places[w] for w in run], k) for run, k in runs])
        feature, topic, value = entries
        order = np.argsort(feature, kind="stable")
        self.topic, self.value = topic[order].astype(np.int64), value[order]
        self.start = np.searchsorted(feature[order], np.arange(self.width + 1))
        dense = np.flatnonzero(np.diff(self.start) * 16 >= max(16, topics))
        self.column = np.full(self.width, -1)
        self.column[dense] = np.arange(len(dense))
        self.dense = np.zeros((len(dense), topics))
        at = self.column[feature]
        self.dense[at[at >= 0], topic[at >= 0]] = value[at >= 0]
        self.rows = int(max(1, min(256, self.most_cells // max(self.width, topics))))

    def _tree(self, runs: list[tuple[list[int], int]]) -> None:
        """By length, the sorted keys (number of the run without its last word, last word) and each run's feature, -1 if only longer ones have it."""
        self.keys, self.feature = [np.arange(self.base)], []
        prefixes = {tuple(run[:n]) for run, _ in runs for n in range(1, len(run))} | {tuple(run) for run, _ in runs}
        number = {run: run[0] for run in prefixes if len(run) == 1}
        for n in range(2, self.high + 1):
            key = {run: number[run[:-1]] * self.base + run[-1] for run in prefixes if len(run) == n}
            self.keys.append(np.array(sorted(key.values()), np.int64))
            number |= {run: int(np.searchsorted(self.keys[-1], k)) for run, k in key.items()}
        for n in range(1, self.high + 1):
            self.feature.append(np.full(max(1, len(self.keys[n - 1])), -1))
        for run, k in runs:
            self.feature[len(run) - 1][number[tuple(run)]] = k

    def _counted(self, texts: list[str], tail: list[str] | None = None) -> np.ndarray:
        """Counts, texts by features.  ``tail``: the words before a single text, which only begin its runs: they were counted before."""
        words, carried, get = [t.split() for t in texts], len(tail or ()), self.places.get
        if tail:
            words = [tail + words[0]]
        row = np.repeat(np.arange(len(words)), [len(t) for t in words])
        place = np.array([get(w, -1) for t in words for w in t], np.int64)
        node, codes = place, self.grams.found(texts, self.width)
        for n in range(1, self.high + 1):
            if n > len(place):
                break
            if n > 1:
                key = node[:-1] * self.base + place[n - 1 :]
                at = np.flatnonzero((node[:-1] >= 0) & (place[n - 1 :] >= 0) & (row[: len(key)] == row[n - 1 :]))
                to = np.searchsorted(self.keys[n - 1], key[at])
                same = to < len(self.keys[n - 1])
                same[same] = self.keys[n - 1][to[same]] == key[at[same]]
                node = np.full(len(key), -1)
                node[at[same]] = to[same]
            if n >= self.low:
                at = np.flatnonzero(node >= 0)
                f, at = self.feature[n - 1][node[at]], at + n - 1
                good = (f >= 0) & (at >= carried)
                codes.append(row[at[good]] * self.width + f[good])
        return np.bincount(np.concatenate([np.zeros(0, np.int64), *codes]), minlength=len(texts) * self.width).reshape(len(texts), self.width)

    def _counts_of_long(self, text: str) -> np.ndarray:
        """``_counted`` of one text, a bounded part at a time."""
        total, tail, at = np.zeros((1, self.width), np.int64), [], 0
        while at < len(text):
            end = text.find(" ", at + self.most_chars)
            end = len(text) if end < 0 else end
            part = text[at:end].strip(" ")
            total += self._counted([part], tail)
            last = tail + part.split()
            tail, at = last[max(0, len(last) - self.high + 1) :], end
        return total

    def _similar(self, counts: np.ndarray) -> np.ndarray:
        """Similarities, texts by topics; 0 exactly where no feature is shared."""
        n, at = len(counts), np.flatnonzero(counts)
        row, feature = np.divmod(at, self.width)
        value = (1 + np.log(counts.reshape(-1)[at])) * self.weights[feature]
        norm = np.sqrt(np.bincount(row, value * value, n))
        value = value / np.where(norm > 0, norm, 1.0)[row]
        column = self.column[feature]
        vectors = np.zeros((n, len(self.dense)))
        vectors[row[column >= 0], column[column >= 0]] = value[column >= 0]
        out = vectors @ self.dense
        row, feature, value = row[column < 0], feature[column < 0], value[column < 0]
        many = self.start[feature + 1] - self.start[feature]
        upto = np.cumsum(many)
        cuts = np.unique([0, *np.searchsorted(upto, np.arange(self.most_cells, upto[-1], self.most_cells)), len(many)]) if len(many) else []
        for a, b in zip(cuts[:-1], cuts[1:]):  # a bounded number of entries at a time
            m = many[a:b]
            entry = np.repeat(self.start[feature[a:b]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            out += np.bincount(np.repeat(row[a:b] * self.topics, m) + self.topic[entry], np.repeat(value[a:b], m) * self.value[entry], n * self.topics).reshape(n, self.topics)
        return out

    def near(self, texts: list[str], barred: list[list[int]] | None, minimum: float, relative: float, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of texts and topics, and similarities: every pair that may be among a text's ``most`` best above the thresholds.

        ``texts``: normalised words, one space between.  ``barred``: by text, topics it can't have.
        """
        at = 0
        while at < len(texts):
            end, chars = at + 1, len(texts[at])
            while end < min(len(texts), at + self.rows) and chars + len(texts[end]) <= self.most_chars:
                chars += len(texts[end])
                end += 1
            if chars > self.most_chars:
                counts = self._counts_of_long(texts[at])
            else:
                counts = self._counted(texts[at:end])
            s = self._similar(counts)
            if barred is not None:
                for k, topics in enumerate(barred[at:end]):
                    s[k, topics] = 0.0
            best = s.max(axis=1, keepdims=True)
            good = (s > 0) & (s >= minimum - SLACK) & (s >= relative * best - SLACK)
            if most < self.topics:
                good &= s >= np.partition(s, self.topics - most, axis=1)[:, [self.topics - most]] - SLACK
            row, topic = np.nonzero(good)
            yield row + at, topic, s[row, topic]
            at = end
