"""Incremental loads and change detection on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from heliograph.operators.ingest import append_items
from heliograph.shipping import ship


def once_by_id(stream: DataFrame, key: str, ts: str, overlap: str) -> DataFrame:
    """Each identifier once, though overlapping reads repeat it within ``overlap``."""
    return stream.withWatermark(ts, overlap).dropDuplicatesWithinWatermark([key])


def daily_counts(stream: DataFrame, ts: str, by: str, late: str = "1 hour") -> DataFrame:
    """Counts by days that begin at 23:00 UTC, which is 08:00 in Tokyo."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day", "1 day", "23 hours"), by).agg(F.count("*").alias("n"))


def append_sink(stream: DataFrame, path: str, checkpoint: str):
    """An idempotent append of each micro-batch; the checkpoint advances only after the write."""
    return stream.writeStream.foreachBatch(lambda batch, _: append_items(batch, path)).option("checkpointLocation", checkpoint)


_CHANGE = "id string, ts timestamp, field string, old string, new string"


def field_changes(stream: DataFrame, key: str, ts: str, fields: list[str], first_emits: bool = False) -> DataFrame:
    """A row for each field that differs from the record's version before; first sights are a baseline.

    State is one version a key; a key's versions of a batch are taken in order of time.
    """
    ship(stream.sparkSession, "heliograph")
    state_schema = ", ".join(f"{f} string" for f in fields)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get if state.exists else None
        rows = pd.concat(list(batches)).sort_values(ts, kind="stable")
        out = []
        for r in rows.itertuples(index=False):
            now = tuple(None if pd.isna(v) else str(v) for v in (getattr(r, f) for f in fields))
            if before is not None or first_emits:
                for f, a, b in zip(fields, before or (None,) * len(fields), now):
                    if a != b:
                        out.append((str(k[0]), getattr(r, ts), f, a, b))
            before = now
        state.update(before)
        yield pd.DataFrame(out, columns=["id", "ts", "field", "old", "new"])

    return stream.groupBy(key).applyInPandasWithState(step, _CHANGE, state_schema, "append", GroupStateTimeout.NoTimeout)


def new_members(stream: DataFrame, key: str, member: str, most: int = 200) -> DataFrame:
    """key, member: members not seen before; a key's first batch is a baseline.  The newest ``most`` are remembered."""
    ship(stream.sparkSession, "heliograph")

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = list(state.get[0]) if state.exists else None
        arrived = list(dict.fromkeys(str(x) for b in batches for x in b[member] if x is not None))
        fresh = [] if seen is None else [x for x in arrived if x not in set(seen)]
        state.update((list(dict.fromkeys([*arrived, *(seen or [])]))[:most],))
        yield pd.DataFrame({"id": [str(k[0])] * len(fresh), "member": fresh})

    return stream.groupBy(key).applyInPandasWithState(step, "id string, member string", "seen array<string>", "append", GroupStateTimeout.NoTimeout)
