"""A public tokenizer's identifiers of whole texts, with its merges done on arrays.

The tokenizer drops white space, lower-cases, splits words into units (runs of letters,
single digits, runs of anything else) and merges each unit's bytes by rank.  All of that
is done here for many units at once where letters are ASCII or U+00C0 to U+00FF.  A word
with anything else (other scripts, combining marks, apostrophes, control characters, the
``|`` of the added tokens) goes to the library as a whole.  A vocabulary file that isn't
built of exactly these parts goes to the library for every word.

Identifiers are kept by unit, in a table of bounded size that forgets what was used
longest ago; frequent units are merged once a worker.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from llm.words import _bytes_of, _mix_scalar, _power, mix64

#: Bytes of a unit merged here; longer ones go to the library, whose time grows less with a unit's length.
_LONGEST = 512
_NONE = np.int64(1) << np.int64(40)  # rank of a pair that doesn't merge
_SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)

#: The splitting pattern that the rules below stand for.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _classes() -> np.ndarray:
    out = np.full(256, _ODD, dtype=np.uint8)
    out[0x21:0x7F] = _OTHER
    out[[ord("'"), ord("|")]] = _ODD
    out[[0x20, *range(0x09, 0x0E)]] = _SPACE
    out[ord("0") : ord("9") + 1] = _DIGIT
    out[ord("A") : ord("Z") + 1] = out[ord("a") : ord("z") + 1] = _LETTER
    return out


_CLASS = _classes()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
_TERM = np.array([_mix_scalar(b + 257) for b in range(256)], dtype=np.uint64)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, more = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + more)
            more += 1
    return out


class PairTable:
    """Ranks of pairs of identifiers: open addressing, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        n = len(left)
        self.bits = max(4, int(4 * max(n, 1)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, _NONE, dtype=np.int64)
        keys, ranks = self._key(left, right), np.arange(n)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            slots, first = np.unique(at[free], return_index=True)
            took = np.flatnonzero(free)[first]
            self.keys[slots], self.ranks[slots] = keys[took], ranks[took]
            rest = np.ones(len(keys), dtype=bool)
            rest[took] = False
            keys, ranks, at = keys[rest], ranks[rest], (at[rest] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << np.int64(31)) | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).view(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left, right)
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.ranks[at], _NONE)
        going = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        while len(going):
            at[going] = (at[going] + 1) & (len(self.keys) - 1)
            have = self.keys[at[going]]
            hit = have == keys[going]
            out[going[hit]] = self.ranks[at[going[hit]]]
            going = going[~hit & (have >= 0)]
        return out


class Merges:
    """Byte-pair merges of many units at once."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        chars = byte_characters()
        self.inner = np.array([vocabulary[c] for c in chars], dtype=np.int64)
        self.last = np.array([vocabulary[c + suffix] for c in chars], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.table = PairTable(np.array([vocabulary[a] for a, _ in pairs]), np.array([vocabulary[b] for _, b in pairs]))
        self.made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)

    def identifiers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All units' identifiers in turn, and how many each has; units are the bytes from starts to ends, none empty."""
        lengths = ends - starts
        first = np.cumsum(lengths) - lengths
        total = int(lengths.sum())
        flat = data[np.repeat(starts - first, lengths) + np.arange(total)]
        ids = self.inner[flat]
        tail = first + lengths - 1
        ids[tail] = self.last[flat[tail]]
        unit = np.repeat(np.arange(len(starts)), lengths)
        rank = np.full(total, _NONE)
        rank[:-1] = self.table.rank(ids[:-1], ids[1:]) if total > 1 else rank[:-1]
        rank[tail] = _NONE
        done_ids, done_unit = [], []
        while len(ids):
            begins = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            sizes = np.diff(np.append(begins, len(ids)))
            best = np.minimum.reduceat(rank, begins)
            open_ = np.repeat(best < _NONE, sizes)
            if not open_.all():
                done_ids.append(ids[~open_])
                done_unit.append(unit[~open_])
                ids, unit, rank, best, sizes = ids[open_], unit[open_], rank[open_], best[best < _NONE], sizes[best < _NONE]
                if not len(ids):
                    break
            joins = rank == np.repeat(best, sizes)
            # of overlapping pairs, as in aaa, every other one from the left
            at = np.flatnonzero(joins)
            run = np.concatenate([[True], np.diff(at) != 1])
            begin = np.maximum.accumulate(np.where(run, at, 0))
            at = at[(at - begin) % 2 == 0]
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            ids, unit, rank = ids[keep], unit[keep], rank[keep]
            at = place[at]
            for changed in (at, at[at > 0] - 1):
                changed = changed[changed + 1 < len(ids)]
                within = unit[changed] == unit[changed + 1]
                rank[changed] = _NONE
                changed = changed[within]
                rank[changed] = self.table.rank(ids[changed], ids[changed + 1])
            if len(at) and at[-1] == len(ids) - 1:
                rank[at[-1]] = _NONE
        ids, unit = np.concatenate([np.zeros(0, np.int64), *done_ids]), np.concatenate([np.zeros(0, np.int64), *done_unit])
        order = np.argsort(unit, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(unit, minlength=len(starts))


class Kept:
    """Identifiers by a unit's number, at most ``most`` units; the half used longest ago goes first."""

    def __init__(self, most: int):
        self.most, self.clock = most, 0
        self.number = np.zeros(0, dtype=np.uint64)
        self.start, self.count, self.used = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.flat = np.zeros(0, dtype=np.uint32)

    def find(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of sorted distinct numbers, and which are there."""
        self.clock += 1
        at = np.searchsorted(self.number, numbers)
        have = at < len(self.number)
        have[have] = self.number[at[have]] == numbers[have]
        self.used[at[have]] = self.clock
        return at, have

    def add(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        if len(self.number) + len(numbers) > self.most:
            self._forget(max(0, self.most // 2 - len(numbers)))
        at = np.searchsorted(self.number, numbers)
        begin = len(self.flat) + np.cumsum(counts) - counts
        self.flat = np.concatenate([self.flat, ids])
        self.number = np.insert(self.number, at, numbers)
        self.start, self.count = np.insert(self.start, at, begin), np.insert(self.count, at, counts)
        self.used = np.insert(self.used, at, self.clock)

    def _forget(self, left: int) -> None:
        """Units of this moment always stay."""
        rank = np.argsort(-self.used, kind="stable")
        stay = np.zeros(len(rank), dtype=bool)
        stay[rank[:left]] = True
        stay |= self.used == self.clock
        self.number, self.start, self.count, self.used = self.number[stay], self.start[stay], self.count[stay], self.used[stay]
        self.flat = self.flat[np.repeat(self.start - (np.cumsum(self.count) - self.count), self.count) + np.arange(int(self.count.sum()))]
        self.start = np.cumsum(self.count) - self.count


class WordPieces:
    """Encodes texts of a column with the tokenizer in a file, as the library would."""

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            about = json.load(f)
        self.merges = Merges(about["model"]["vocab"], about["model"]["merges"], about["model"]["end_of_word_suffix"]) if self._known(about) else None
        self.kept = Kept(most)

    @staticmethod
    def _known(about: dict) -> bool:
        model, before = about["model"], about.get("pre_tokenizer") or {}
        steps = before.get("pretokenizers", [])
        return (
            [x.get("type") for x in (about.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [x.get("type") for x in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"] == {"Regex": _PATTERN} and steps[0]["invert"] and steps[0]["behavior"] == "Removed"
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and all("|" in x["content"] for x in about["added_tokens"])
        )

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' identifiers in turn, and offsets by text.  Null texts are empty."""
        data, offsets = _bytes_of(column)
        n = len(data)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        lower, starts, ends, odd = self._units(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        numbers = self._numbers(lower, starts, ends, odd)
        unique, first, inverse = np.unique(numbers, return_index=True, return_inverse=True)
        at, have = self.kept.find(unique)
        if not have.all():
            new = np.flatnonzero(~have)
            ids, counts = self._merged(lower, starts[first[new]], ends[first[new]], odd[first[new]])
            self.kept.add(unique[new], ids, counts)
            at = np.searchsorted(self.kept.number, unique)
        counts = self.kept.count[at][inverse]
        total = np.concatenate([[0], np.cumsum(counts)])
        pick = np.repeat(self.kept.start[at][inverse] - total[:-1], counts) + np.arange(total[-1])
        return self.kept.flat[pick], total[np.searchsorted(starts, offsets)]

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes (odd words as they are), units' starts and ends, and which are odd words."""
        n = len(data)
        kind, lower = _CLASS[data], _LOWER[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        if len(lead):  # U+00C0 to U+00FF but for the multiplication and division signs
            low = data[lead + 1]
            ok = (low != 0x97) & (low != 0xB7)
            lead, low = lead[ok], low[ok]
            kind[lead] = kind[lead + 1] = _LETTER
            lower[lead + 1] = np.where(low <= 0x9E, low + 0x20, low)
        inside = kind != _SPACE
        cut = offsets[:-1]
        cut = cut[cut < n]
        word = inside.copy()
        word[1:] &= ~inside[:-1]
        word[cut] = inside[cut]
        words = np.flatnonzero(word)
        if not len(words):
            return lower, words, words, np.zeros(0, bool)
        odd_byte = (kind == _ODD) if self.merges else inside
        odd_word = np.logical_or.reduceat(odd_byte, words)
        begins = inside.copy()
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        if odd_word.any():
            odd_at = np.repeat(odd_word, np.diff(np.append(words, n)))  # up to the next word, white space too
            odd_at = np.concatenate([np.zeros(words[0], bool), odd_at])
            begins &= ~odd_at
            lower = np.where(odd_at, data, lower)
        begins |= word
        starts = np.flatnonzero(begins)
        stops = np.zeros(n + 1, dtype=bool)
        stops[1:] = inside
        stops[1:-1] &= ~inside[1:] | begins[1:]
        ends = np.flatnonzero(stops)
        return lower, starts, ends, odd_word[np.searchsorted(words, starts, side="right") - 1]

    @staticmethod
    def _numbers(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> np.ndarray:
        """A 64-bit number for each unit; two different ones share it with probability about 2**-64 a pair."""
        n = len(lower)
        terms = _TERM[lower] * _power("up", n)
        # bytes between units add nothing: sums run from each start to its end
        sums = np.add.reduceat(terms, np.stack([starts, np.minimum(ends, n - 1)], axis=1).reshape(-1))[::2]
        whole = (ends == n) & (starts == n - 1)
        sums = np.where(whole, terms[starts], sums)
        long = ends == n  # reduceat stopped a byte early there
        sums = np.where(long & ~whole, sums + terms[n - 1], sums)
        return mix64(sums * _power("down", n)[starts] + (2 * (ends - starts) + odd).astype(np.uint64))

    def _merged(self, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers of new units in turn, and how many each has."""
        counts = np.zeros(len(starts), dtype=np.int64)
        plain_unit = ~odd & (ends - starts <= _LONGEST)
        plain = np.flatnonzero(plain_unit)
        flat = np.zeros(0, np.uint32)
        if len(plain):
            flat, counts[plain] = self.merges.identifiers(lower, starts[plain], ends[plain])
        if len(plain) == len(starts):
            return flat, counts
        rest = np.flatnonzero(~plain_unit)
        raw = lower.tobytes()
        found = [x.ids for x in self.library.encode_batch_fast([raw[a:b].decode() for a, b in zip(starts[rest].tolist(), ends[rest].tolist())], add_special_tokens=False)]
        counts[rest] = [len(f) for f in found]
        out = np.empty(int(counts.sum()), np.uint32)
        mine = np.repeat(~plain_unit, counts)
        out[~mine] = flat
        out[mine] = np.fromiter((i for f in found for i in f), dtype=np.uint32, count=int(counts[rest].sum()))
        return out, counts
