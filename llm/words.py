"""Vectorised word hashing over Arrow string columns.

Words are maximal runs of bytes outside ``\\x20`` and ``\\x09-\\x0D``, with A-Z
lower-cased.  Those separators are ASCII, so working on UTF-8 bytes finds the same
words as the pattern ``[^\\x20\\x09-\\x0D]+`` finds on characters.  Each word becomes a
64-bit number; everything after that (shingles, n-grams, windows) is numpy arithmetic
on whole Arrow batches, so no Python object is made per word.

Two different words share a number with probability about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes handled at once: bounds the memory of the arrays below, whatever the batch holds.
BLOCK_BYTES = 1 << 20


def _mix_scalar(x: int) -> int:
    x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer: a bijection of 64-bit numbers."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An ordered pair's number."""
    return mix64(a * _U(0xD6E8FEB86659FD93) + b)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])
_FOLDED = np.array([_mix_scalar(int(b) + 1) for b in _LOWER], dtype=np.uint64)
_SHAPE = np.where((np.arange(256) >= 48) & (np.arange(256) <= 57), _FOLDED[48], _FOLDED)
_EXACT = np.array([_mix_scalar(b + 1) for b in range(256)], dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        size = max(n, 2 * BLOCK_BYTES)
        out = np.full(size, _U(_BASE if which == "up" else _BASE_INVERSE))
        out[0] = 1
        have = _powers[which] = np.multiply.accumulate(out)
    return have[:n]


@dataclass
class Words:
    """The words of several texts, in order."""

    hashes: np.ndarray  # uint64, one for each word
    starts: np.ndarray  # int64, byte offset of each word in `data`
    ends: np.ndarray
    first: np.ndarray  # int64, len(texts) + 1: text i has words first[i] to first[i + 1]
    data: np.ndarray  # uint8, the bytes the offsets point into
    offsets: np.ndarray  # int64, len(texts) + 1: byte offsets of the texts in `data`

    def document_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its offsets; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, fold: bool | str = True, strip: bytes = b"") -> Words:
    """The words of each text.  ``fold`` lower-cases A-Z; as "shape" it makes digits alike, too.

    With ``strip`` a word's number is that of the word without such bytes at either end;
    a word of nothing else has number 0.
    """
    return _words(*_bytes_of(texts), fold, strip)


def _words(data: np.ndarray, offsets: np.ndarray, fold: bool | str, strip: bytes = b"") -> Words:
    n = len(data)
    table = _SHAPE if fold == "shape" else _FOLDED if fold else _EXACT
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, dtype=np.uint64), none, none, np.zeros(len(offsets), dtype=np.int64), data, offsets)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[:-1]
    cut = cut[cut < n]
    begins[cut] = inside[cut]  # a text's first byte begins a word even right after another text's word
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    ends_mask = np.zeros(n + 1, dtype=bool)
    ends_mask[1:] = inside
    ends_mask[1:-1] &= ~inside[1:] | begins[1:]
    ends = np.flatnonzero(ends_mask)
    if len(starts) == 0:
        return Words(np.zeros(0, dtype=np.uint64), starts, ends, first, data, offsets)
    terms = table[data]
    terms *= _power("up", n)
    terms[~inside] = 0
    low, high = starts, ends
    if strip:
        core = np.ones(256, dtype=bool)
        core[list(strip)] = False
        core = np.flatnonzero(core[data] & inside)
        low = np.minimum(np.append(core, n)[np.searchsorted(core, starts)], ends)
        high = np.maximum(np.append(-1, core)[np.searchsorted(core, ends)] + 1, low)
        edges = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edges, low, 1)
        np.add.at(edges, high, -1)
        terms[np.cumsum(edges[:-1]) == 0] = 0
    sums = np.add.reduceat(terms, starts)
    hashes = mix64(sums * _power("down", n)[np.minimum(low, n - 1)] + (high - low).astype(np.uint64))
    if strip:
        hashes[high <= low] = 0
    return Words(hashes, starts, ends, first, data, offsets)


def stretches(data: np.ndarray, offsets: np.ndarray, fold: bool | str = True) -> Iterator[tuple[int, int, Words]]:
    """The first text, the first byte and the words of each stretch of some texts.

    Stretches are of about ``BLOCK_BYTES`` and end where a text or a word does, so memory
    is bounded, but for a single longer word.
    """
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1)
        low, high = int(offsets[at]), int(offsets[to])
        if to > at + 1 or high - low <= BLOCK_BYTES:
            yield at, low, _words(data[low:high], offsets[at : to + 1] - low, fold)
        else:
            while low < high:
                end = min(low + BLOCK_BYTES, high)
                while end < high and not _SPACE[data[end]]:
                    step = np.flatnonzero(_SPACE[data[end : end + BLOCK_BYTES]])
                    end = end + int(step[0]) if len(step) else min(end + BLOCK_BYTES, high)
                yield at, low, _words(data[low:end], np.array([0, end - low]), fold)
                low = end
        at = to


def word_numbers(texts: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Each word's number, and offsets by text, as in ``words_of``; long texts are taken in stretches."""
    data, offsets = _bytes_of(texts)
    out, counts = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for at, _, w in stretches(data, offsets, fold):
        out.append(w.hashes)
        counts[at : at + len(w.first) - 1] += np.diff(w.first)
    return np.concatenate([np.zeros(0, np.uint64), *out]), np.concatenate([[0], np.cumsum(counts)])


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes at ``a`` and at ``b`` are equal: eight at a time, and what is beyond 64 in one go."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded.data, 0, (1,))
    same = np.ones(len(a), dtype=bool)
    live = np.flatnonzero(length > 0)
    for step in range(0, 64, 8):
        left = np.minimum(length[live] - step, 8)
        differ = (eight[a[live] + step] ^ eight[b[live] + step]) << (64 - 8 * left).astype(np.uint64)
        same[live[differ != 0]] = False
        live = live[(differ == 0) & (length[live] > step + 8)]
    for k in live.tolist():
        same[k] = bool((data[a[k] + 64 : a[k] + length[k]] == data[b[k] + 64 : b[k] + length[k]]).all())
    return same


def blocks_of(batch: pa.RecordBatch, column: str = "text", most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts come to about ``most`` bytes; a longer text is a slice of its own."""
    if batch.num_rows == 0:
        return
    data, offsets = _bytes_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles of ``size`` words: their numbers, and offsets by text.

    A text with fewer words, but at least one, has its whole word sequence as one
    shingle; a text without words has none.  Numbers are sorted within a text.
    """
    h, first = words.hashes, words.first
    counts = np.diff(first)
    n = len(h)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(first), dtype=np.int64)
    doc = words.document_of_word()
    left = first[1:][doc] - np.arange(n)  # words from here to the end of the text
    out = h.copy()
    for k in range(1, min(size, n)):
        out[: n - k] = np.where(left[: n - k] > k, combine(out[: n - k], h[k:]), out[: n - k])
    short = counts[doc] < size
    keep = np.where(short, left == counts[doc], left >= size)
    # a short text's sequence must not equal a prefix of a longer text's shingle
    grams, owner = out[keep], doc[keep]
    if short.any():
        grams = np.where(short[keep], mix64(grams ^ _U(0x5bd1e995)), grams)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    fresh = np.ones(len(grams), dtype=bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[fresh], owner[fresh]
    return grams, np.searchsorted(owner, np.arange(len(first)))
