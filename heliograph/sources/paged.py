"""A Python data source for paged APIs that list records by time, read whole or as a stream.

Planning splits ranges that are too full, or leaves a range to pages that come newest
first and end where they reach back beyond it.  The transport is a class with ``latest()``
and either ``count(start, end)`` and ``page(start, end, number)`` or ``newest(number)``;
one that reads fixture files serves where there is no network.  ``register`` makes it a
format.

As a stream, the offset is the end of what has been read, by target.  Each batch reads
from the offset less an overlap, so late records are found; what the overlap repeats is
left to a sink that knows identifiers (``operators.commits``).  Spark moves the offset only
after the sink has taken a batch.
"""

from __future__ import annotations

import importlib
import json
import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from heliograph.shipping import ship

#: What is done about a failure of each kind: how many more attempts, and the seconds before the first of them, which double with each.
POLICY = {"unreachable": (3, 1.0), "busy": (3, 1.0), "limited": (2, 60.0), "missing": (0, 0.0), "refused": (0, 0.0), "malformed": (0, 0.0)}


class Failed(Exception):
    """A transport's failure, of a kind in POLICY; ``wait`` are the seconds the other side asks for."""

    def __init__(self, kind: str, message: str = "", wait: float | None = None):
        super().__init__(kind, message, wait)
        self.kind, self.message, self.wait = kind, message, wait

    def __str__(self) -> str:
        return f"{self.kind}: {self.message}"


def attempt(call: Callable, longest_wait: float = 120.0, sleep: Callable[[float], None] = time.sleep):
    """The call's result, tried again as POLICY says; a wait beyond ``longest_wait`` ends the attempts."""
    tried = 0
    while True:
        try:
            return call()
        except Failed as f:
            more, first = POLICY[f.kind]
            wait = first * 2**tried if f.wait is None else f.wait
            if tried >= more or wait > longest_wait:
                raise
            tried += 1
            sleep(wait)


@dataclass
class Slice(InputPartition):
    start: int
    end: int
    count: int  # -1: not counted, pages come newest first
    target: str = ""


class FileTransport:
    """Records of a JSON-lines file, each with a ``ts`` in seconds and, where there are targets, a ``target``; pages of ``size``."""

    def __init__(self, options: dict, target: str = ""):
        with open(options["path"]) as f:
            rows = [json.loads(x) for x in f if x.strip()]
        self.rows = [r for r in rows if not target or r.get("target") == target]
        self.size = int(options.get("pageSize", 100))

    def latest(self) -> int:
        return max((r["ts"] for r in self.rows), default=-1) + 1

    def _within(self, start: int, end: int) -> list[dict]:
        return sorted((r for r in self.rows if start <= r["ts"] < end), key=lambda r: (-r["ts"], str(r["id"])))

    def count(self, start: int, end: int) -> int:
        return len(self._within(start, end))

    def page(self, start: int, end: int, number: int) -> list[dict]:
        rows = self._within(start, end)
        return rows[number * self.size : (number + 1) * self.size]


class FolderTransport(FileTransport):
    """Records of JSON-lines files in folders ``slot=n``, each of ``slotSeconds`` seconds from n times as many on: a range reads its own folders only."""

    def __init__(self, options: dict, target: str = ""):
        self.root, self.slot, self.size, self.target = options["path"].removeprefix("file://"), int(options.get("slotSeconds", 86_400)), int(options.get("pageSize", 100)), target

    def _slots(self) -> list[int]:
        return sorted(int(d[5:]) for d in os.listdir(self.root) if d.startswith("slot="))

    def _read(self, slot: int) -> list[dict]:
        folder, rows = f"{self.root}/slot={slot}", []
        for name in sorted(os.listdir(folder)):
            if name.endswith(".json"):
                with open(f"{folder}/{name}") as f:
                    rows += [json.loads(x) for x in f if x.strip()]
        return [r for r in rows if not self.target or r.get("target") == self.target]

    def latest(self) -> int:
        return max((r["ts"] for r in self._read(self._slots()[-1])), default=-1) + 1

    def _within(self, start: int, end: int) -> list[dict]:
        rows = [r for s in self._slots() if s * self.slot < end and (s + 1) * self.slot > start for r in self._read(s)]
        return sorted((r for r in rows if start <= r["ts"] < end), key=lambda r: (-r["ts"], str(r["id"])))


class SortedFolderTransport(FolderTransport):
    """The same where each file's records come in order of time, one a line.

    A range is found in a file by halving: counting keeps no records, whatever the
    range, and a page reads its range alone, once for all pages.
    """

    def __init__(self, options: dict, target: str = ""):
        super().__init__(options, target)
        self.slots, self.files, self.whole, self.last = self._slots(), {}, {}, (None, [])

    def _names(self, slot: int) -> list[str]:
        if slot not in self.files:
            folder = f"{self.root}/slot={slot}"
            self.files[slot] = [f"{folder}/{n}" for n in sorted(os.listdir(folder)) if n.endswith(".json")]
        return self.files[slot]

    @staticmethod
    def _place(f, size: int, ts: int) -> int:
        """Where the first line of at least this time begins; the file's size if there is none."""
        low, high = 0, size
        while low < high:
            middle = (low + high) // 2
            f.seek(max(0, middle - 1))
            if middle:
                f.readline()
            if f.tell() >= high:
                high = middle
            elif json.loads(f.readline())["ts"] < ts:
                low = f.tell()
            else:
                high = middle
        return low

    def _parts(self, start: int, end: int) -> Iterator[tuple[int, str, int, int]]:
        """Slot, file, and the bytes from and to which the range's lines go; -1 for whole files."""
        for s in self.slots:
            if s * self.slot >= end or (s + 1) * self.slot <= start:
                continue
            for name in self._names(s):
                if start <= s * self.slot and (s + 1) * self.slot <= end:
                    yield s, name, 0, -1
                else:
                    with open(name, "rb") as f:
                        size = os.path.getsize(name)
                        yield s, name, self._place(f, size, start), self._place(f, size, end)

    def _lines(self, name: str, a: int, b: int) -> Iterator[bytes]:
        with open(name, "rb") as f:
            f.seek(a)
            while (b < 0 or f.tell() < b) and (line := f.readline()):
                yield line

    def _number(self, name: str, a: int, b: int) -> int:
        if self.target:
            return sum(json.loads(x).get("target") == self.target for x in self._lines(name, a, b))
        n, left, chunk = 0, (os.path.getsize(name) if b < 0 else b) - a, b""
        with open(name, "rb") as f:
            f.seek(a)
            while left > 0 and (more := f.read(min(left, 1 << 20))):
                chunk, left = more, left - len(more)
                n += chunk.count(b"\n")
        return n + (1 if chunk and not chunk.endswith(b"\n") else 0)

    def count(self, start: int, end: int) -> int:
        n = 0
        for _, name, a, b in self._parts(start, end):
            if b < 0:
                if name not in self.whole:
                    self.whole[name] = self._number(name, a, b)
                n += self.whole[name]
            else:
                n += self._number(name, a, b)
        return n

    def latest(self) -> int:
        if not self.slots:
            return 0
        times = (json.loads(x) for n in self._names(self.slots[-1]) for x in self._lines(n, 0, -1))
        return max((r["ts"] for r in times if not self.target or r.get("target") == self.target), default=-1) + 1

    def _within(self, start: int, end: int) -> list[dict]:
        if self.last[0] != (start, end):
            rows: list[dict] = []
            for _, name, a, b in self._parts(start, end):
                before = None
                for x in self._lines(name, a, b):
                    r = json.loads(x)
                    if not start <= r["ts"] < end or (before is not None and r["ts"] < before):
                        raise Failed("malformed", f"{name} isn't in order of time")
                    before = r["ts"]
                    if not self.target or r.get("target") == self.target:
                        rows.append(r)
            self.last = ((start, end), sorted(rows, key=lambda r: (-r["ts"], str(r["id"]))))
        return self.last[1]


class FileFeed(FileTransport):
    """The same as a feed without counts: pages newest first."""

    count = page = None

    def newest(self, number: int) -> list[dict]:
        return self._within(0, 1 << 62)[number * self.size : (number + 1) * self.size]


def split_range(count, start: int, end: int, capacity: int, least: int, target: str = "") -> list[Slice]:
    """Halves of the range until each holds at most ``capacity``; below ``least`` seconds that is an error, never a cut."""
    n = count(start, end)
    if n <= capacity:
        return [Slice(start, end, n, target)] if n else []
    if end - start <= least:
        raise ValueError(f"{n} records from {start} to {end} exceed the capacity of {capacity}")
    middle = (start + end) // 2
    return split_range(count, start, middle, capacity, least, target) + split_range(count, middle, end, capacity, least, target)


class _Pages:
    """What reading whole and reading as a stream share."""

    def __init__(self, options: dict):
        self.options = options  # names in any case
        self.targets = json.loads(self.options.get("targets", "[]")) or [""]

    def _transport(self, target: str = ""):
        module, _, name = self.options.get("transport", "heliograph.sources.paged.FileTransport").rpartition(".")
        kind = getattr(importlib.import_module(module), name)
        return kind(self.options, target) if target else kind(self.options)

    def plan(self, start: int, end: int, target: str) -> list[Slice]:
        transport, o = self._transport(target), self.options
        if getattr(transport, "count", None) is None:
            return [Slice(start, end, -1, target)] if start < end else []
        return split_range(lambda a, b: attempt(lambda: transport.count(a, b)), start, end, int(o.get("capacity", 1000)), int(o.get("leastSeconds", 900)), target)

    def _pages(self, part: Slice) -> Iterator[list[dict]]:
        """Pages of a slice: as many as it was counted to have, or newest first until one reaches back beyond it."""
        transport, number, seen = (self._transport(part.target) if part.target else self._transport()), 0, 0
        most, pause = int(self.options.get("mostPages", 10_000)), float(self.options.get("pause", 0))
        while part.count < 0 or seen < part.count:
            rows = attempt(lambda: transport.newest(number) if part.count < 0 else transport.page(part.start, part.end, number))
            if not rows and part.count >= 0:
                raise ValueError(f"{part.start} to {part.end}: {seen} records came of the {part.count} that were counted")
            yield [r for r in rows if part.count >= 0 or part.start <= r["ts"] < part.end]
            seen, number = seen + len(rows), number + 1
            if part.count < 0 and (not rows or min(r["ts"] for r in rows) < part.start):
                return
            if part.count < 0 and number >= most:
                raise ValueError(f"{most} pages don't reach back to {part.start}")
            if pause:
                time.sleep(pause)

    def read(self, partition: Slice) -> Iterator[tuple]:
        """Records of a slice; with ``onError`` as ``row`` a failure is one more row and costs no other slice's rows."""
        if not partition.count:
            return
        wide = "targets" in self.options
        try:
            for rows in self._pages(partition):
                for r in rows:
                    yield (str(r["id"]), int(r["ts"]), json.dumps(r, sort_keys=True), *((partition.target, None) if wide else ()))
        except (Failed, ValueError) as e:
            if self.options.get("onError") != "row" or not wide:
                raise
            yield (None, None, None, partition.target, str(e))


class PagedReader(_Pages, DataSourceReader):
    def partitions(self):
        start, end = int(self.options["start"]), int(self.options["end"])
        out: list[Slice] = []
        for target in self.targets:
            try:
                out += self.plan(start, end, target)
            except (Failed, ValueError):
                if self.options.get("onError") != "row":
                    raise
                out.append(Slice(start, end, -2, target))  # its task fails likewise, and says so in a row
        return out or [Slice(start, end, 0)]

    def _pages(self, part: Slice) -> Iterator[list[dict]]:
        if part.count == -2:
            self.plan(part.start, part.end, part.target)
            raise ValueError("planning failed, and then did not")
        return super()._pages(part)


class PagedStreamReader(_Pages, DataSourceStreamReader):
    """Offsets are the ends of what has been read, by target, in seconds."""

    def initialOffset(self) -> dict:
        if "start" in self.options:
            return {t: int(self.options["start"]) for t in self.targets} | {"first": True}
        back = int(float(self.options.get("lookbackHours", 24)) * 3600)
        return {t: self._transport(t).latest() - back for t in self.targets} | {"first": True}

    def latestOffset(self) -> dict:
        most = int(self.options["until"]) if "until" in self.options else None
        return {t: n if most is None else min(n, most) for t in self.targets for n in [attempt(self._transport(t).latest)]}

    def partitions(self, start: dict, end: dict):
        overlap, oldest = int(float(self.options.get("overlapMinutes", 0)) * 60), int(float(self.options.get("mostHours", 24 * 365)) * 3600)
        out: list[Slice] = []
        for t in self.targets:
            if t not in start:  # a target that came later begins with the others
                start = start | {t: min(v for k, v in start.items() if k != "first")}
            if end[t] <= start[t]:
                continue
            if end[t] - start[t] > oldest and not start.get("first"):
                raise ValueError(f"the offset {start[t]} of {t or 'the source'} is older than the longest catch-up")
            out += self.plan(start[t] if start.get("first") else start[t] - overlap, end[t], t)
        return out or [Slice(0, 0, 0)]


class PagedSource(DataSource):
    """id, ts, record; with ``targets``, a JSON list, also target and error."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id string, ts bigint, record string" + ", target string, error string" * ("targets" in self.options)

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)

    def streamReader(self, schema) -> PagedStreamReader:
        return PagedStreamReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark, "heliograph")
    spark.dataSource.register(PagedSource)


def collection_window(now: int, checkpoint: int | None, lookback_hours: float, overlap_minutes: float, most_hours: float) -> tuple[int, int]:
    """Start and end in seconds: a first run looks back, later ones overlap the last; a checkpoint that is too old is an error."""
    if checkpoint is None:
        return now - int(lookback_hours * 3600), now
    if now - checkpoint > most_hours * 3600:
        raise ValueError("the checkpoint is older than the longest catch-up")
    return checkpoint - int(overlap_minutes * 60), now
