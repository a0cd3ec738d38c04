"""Tables that grow by whole commits.

Rows are written by Spark into a folder of their own, where its committer keeps task
attempts apart; nothing there is part of the table yet.  One small document then commits
the folder under the next version's name.  Only one writer can create that name, so
writers that meet see it, and the later one looks again which of its rows are new.  A
failed or killed job leaves a folder that no version names.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.operators.ingest import keep_first
from heliograph.storage import _path, read_text, written


@dataclass(frozen=True)
class Version:
    number: int
    folders: tuple[str, ...]  # all that are part of the table
    batches: dict[str, int]  # by stream, the newest batch that is in it

    @property
    def empty(self) -> bool:
        return not self.folders


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""


def _name(path: str, number: int) -> str:
    return f"{path}/_versions/{number:012d}.json"


def version(spark: SparkSession, path: str) -> Version:
    """The newest version; 0, without folders, where there is no table."""
    where, fs = _path(spark, f"{path}/_versions")
    numbers = sorted(int(s.getPath().getName()[:12]) for s in fs.listStatus(where) if s.getPath().getName()[12:] == ".json") if fs.exists(where) else []
    if not numbers:
        return Version(0, (), {})
    value = json.loads(read_text(spark, _name(path, numbers[-1])))
    return Version(numbers[-1], tuple(value["folders"]), value["batches"])


def _publish(spark: SparkSession, path: str, new: Version) -> None:
    """Creates a version's document, complete, under a name that must not exist: by a link on mounted folders, else by a rename that doesn't overwrite."""
    text = json.dumps({"folders": new.folders, "batches": new.batches})
    place, fs = _path(spark, _name(path, new.number))
    early, _ = _path(spark, f"{_name(path, new.number)}.{uuid.uuid4().hex}")
    out = fs.create(early, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if place.toUri().getScheme() in (None, "file"):
            os.link(early.toUri().getPath(), place.toUri().getPath())
            return
        jvm = spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(early, place, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except FileExistsError as e:
        raise CommitConflict(_name(path, new.number)) from e
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise CommitConflict(_name(path, new.number)) from e
        raise
    finally:
        fs.delete(early, False)


def read_committed(spark: SparkSession, path: str, at: Version | None = None) -> DataFrame | None:
    """The table's rows, or null where nothing is committed; folders of failed writers aren't read."""
    at = at or version(spark, path)
    return None if at.empty else spark.read.parquet(*[f"{path}/{f}" for f in at.folders])


def append_committed(batch: DataFrame, path: str, key: str = "id", order: list[Column] | None = None, stream: str | None = None, batch_id: int | None = None, tries: int = 20) -> int:
    """Commits the rows whose key the table hasn't got, the first of each key, and returns how many.

    With ``stream`` and ``batch_id``, a batch that is in the table already adds nothing, even
    under other keys.  A null key counts as one key.  The batch is computed once, however often
    writers meet; keys are compared with those of the table by a shuffle on the key alone.
    """
    spark = batch.sparkSession
    rows = written(keep_first(batch, [key], order or [F.lit(0)]))
    for _ in range(tries):
        now = version(spark, path)
        if stream is not None and batch_id is not None and now.batches.get(stream, -1) >= batch_id:
            return 0
        known = read_committed(spark, path, now)
        fresh = rows if known is None else rows.join(known.select(F.col(key).alias("__key")), F.col(key).eqNullSafe(F.col("__key")), "left_anti")
        folder = f"data/{uuid.uuid4().hex}"
        fresh.write.parquet(f"{path}/{folder}")
        n = spark.read.schema(rows.schema).parquet(f"{path}/{folder}").count()
        if not n and stream is None:
            _drop(spark, path, folder)
            return 0
        batches = now.batches | ({stream: batch_id} if stream is not None and batch_id is not None else {})
        try:
            _publish(spark, path, Version(now.number + 1, (*now.folders, *([folder] if n else [])), batches))
            return n
        except CommitConflict:
            _drop(spark, path, folder)
    raise CommitConflict(f"{tries} times another writer was faster: {path}")


def _drop(spark: SparkSession, path: str, *folders: str) -> None:
    for f in folders:
        p, fs = _path(spark, f"{path}/{f}")
        fs.delete(p, True)


def compact(spark: SparkSession, path: str, files: int = 1) -> int:
    """Replaces all folders by one of so many files, as a commit of its own; returns the version.  Old folders stay for readers of older versions, until ``vacuum``."""
    now = version(spark, path)
    if len(now.folders) < 2:
        return now.number
    folder = f"data/{uuid.uuid4().hex}"
    read_committed(spark, path, now).coalesce(files).write.parquet(f"{path}/{folder}")
    _publish(spark, path, Version(now.number + 1, (folder,), now.batches))
    return now.number + 1


def vacuum(spark: SparkSession, path: str, older_than_ms: int = 24 * 3600 * 1000) -> int:
    """Deletes folders that the newest version hasn't got and that are older than any writer at work; returns how many."""
    now = set(version(spark, path).folders)
    where, fs = _path(spark, f"{path}/data")
    limit = spark.sparkContext._jvm.System.currentTimeMillis() - older_than_ms
    gone = [s.getPath() for s in fs.listStatus(where) if f"data/{s.getPath().getName()}" not in now and s.getModificationTime() <= limit]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def committed_sink(stream: DataFrame, path: str, checkpoint: str, key: str = "id", name: str = "stream"):
    """A stream's batches as commits: each once, though a restart replays the last one, and each key once, though overlaps repeat it."""
    return stream.writeStream.foreachBatch(lambda batch, n: append_committed(batch, path, key, stream=name, batch_id=n) and None).option("checkpointLocation", checkpoint)


__all__ = ["CommitConflict", "Version", "append_committed", "committed_sink", "compact", "read_committed", "vacuum", "version"]
