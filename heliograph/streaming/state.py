"""State by key on streams: map, list and value state with time to live and timers.

State lies in RocksDB, a row for each entry, so a key with much state isn't read and
written whole; the state reader (``states``) shows it as a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heliograph.shipping import ship

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State of these operators needs this provider; a session that names it already keeps its settings."""
    ship(spark, "heliograph")
    if not spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _text(value: object) -> str | None:
    return None if value is None or (not isinstance(value, str) and pd.isna(value)) else str(value)


def _rows(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    """Rows to emit; text stays Python objects, as Arrow strings in several chunks don't fit the struct that Spark makes of them."""
    out = pd.DataFrame(rows, columns=columns)
    return out.astype({c: object for c in ("id", "field", "old", "new", "member") if c in columns})


def _sorted(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """A key's rows of one micro-batch, in order; what a trigger brings of a key bounds it."""
    return pd.concat(list(batches)).sort_values(order, kind="stable")


class SnapshotProcessor(StatefulProcessor):
    """A row for each field that differs from the record's version before.

    Map state: field to its value as text, each entry living ``ttl_ms`` beyond its last sight.
    """

    def __init__(self, fields: list[str], order: list[str], ttl_ms: int | None = None):
        self.fields, self.order, self.ttl_ms = fields, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.snapshot = handle.getMapState("snapshot", "field string", "value string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = {k[0]: v[0] for k, v in self.snapshot.iterator()}
        out = []
        for r in _sorted(rows, self.order).to_dict("records"):
            now = {f: _text(r[f]) for f in self.fields}
            if before:
                out += [(_text(key[0]), *(r[o] for o in self.order), f, before.get(f), now[f]) for f in self.fields if before.get(f) != now[f]]
            before = now
        for f, v in before.items():
            self.snapshot.updateValue((f,), (v,))
        yield _rows(out, ["id", *self.order, "field", "old", "new"])

    def close(self) -> None:
        pass


class StatusProcessor(StatefulProcessor):
    """A row for each change of a record's status.  Value state: the status; a timer forgets a record that has been silent for ``silent_ms``."""

    def __init__(self, status: str, order: list[str], silent_ms: int | None = None):
        self.status, self.order, self.silent_ms = status, order, silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("status", "status string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.value.exists()
        before, out = self.value.get()[0] if known else None, []
        for r in _sorted(rows, self.order).to_dict("records"):
            now = _text(r[self.status])
            if known and now != before:
                out.append((_text(key[0]), *(r[o] for o in self.order), before, now))
            before, known = now, True
        self.value.update((before,))
        if self.silent_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)
        yield _rows(out, ["id", *self.order, "old", "new"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.value.clear()
        yield _rows([], ["id", *self.order, "old", "new"])

    def close(self) -> None:
        pass


class SeenProcessor(StatefulProcessor):
    """A row for each member not seen before; a key's first batch is a baseline.  List state: the newest ``most`` members, newest first."""

    def __init__(self, member: str, order: list[str], most: int = 200):
        self.member, self.order, self.most = member, order, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "member string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        seen = [x[0] for x in self.seen.get()] if known else []
        arrived = list(dict.fromkeys(x for x in map(_text, _sorted(rows, self.order)[self.member]) if x is not None))
        have = set(seen)
        fresh = [x for x in arrived if x not in have] if known else []
        kept = list(dict.fromkeys([*reversed(arrived), *seen]))[: self.most]
        if kept:
            self.seen.put([(x,) for x in kept])
        yield _rows([(_text(key[0]), x) for x in fresh], ["id", "member"])

    def close(self) -> None:
        pass


def _order_types(stream: DataFrame, order: list[str]) -> str:
    return "".join(f"{o} {stream.schema[o].dataType.simpleString()}, " for o in order)


def snapshot_stream(stream: DataFrame, key: str, order: list[str], fields: list[str], ttl_ms: int | None = None) -> DataFrame:
    """id, the columns of ``order``, field, old, new: changes between a record's versions, over all batches; first sights are a baseline."""
    use_rocksdb(stream.sparkSession)
    schema = f"id string, {_order_types(stream, order)}field string, old string, new string"
    stream = stream.select(key, *order, *[F.col(f).cast("string") for f in fields])  # values as Spark writes them: pandas would make whole numbers with nulls floats
    return stream.groupBy(key).transformWithStateInPandas(SnapshotProcessor(fields, order, ttl_ms), schema, "append", "ProcessingTime" if ttl_ms else "None")


def status_stream(stream: DataFrame, key: str, order: list[str], status: str, silent_ms: int | None = None) -> DataFrame:
    """id, the columns of ``order``, old, new: changes of status; a record's first status is none."""
    use_rocksdb(stream.sparkSession)
    schema = f"id string, {_order_types(stream, order)}old string, new string"
    stream = stream.select(key, *order, F.col(status).cast("string"))
    return stream.groupBy(key).transformWithStateInPandas(StatusProcessor(status, order, silent_ms), schema, "append", "ProcessingTime" if silent_ms else "None")


def seen_stream(stream: DataFrame, key: str, order: list[str], member: str, most: int = 200) -> DataFrame:
    """id, member: members that a key hasn't had among its newest ``most``."""
    use_rocksdb(stream.sparkSession)
    stream = stream.select(key, *order, F.col(member).cast("string"))
    return stream.groupBy(key).transformWithStateInPandas(SeenProcessor(member, order, most), "id string, member string", "append", "None")


def states(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """A state variable of a stream's newest batch as a table: snapshot, status or seen."""
    return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
