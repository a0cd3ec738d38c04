"""Queries over streams that stop and go on, and over tables that grow by commits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from heliograph.functions.times import instant
from heliograph.operators import commits, diagnostics
from heliograph.sources import paged
from heliograph.storage import shared_dir
from heliograph.streaming import state


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _in_turns(spark, parts, operator):
    """The rows of an operator over a stream that stops after each part and goes on from its checkpoint."""
    to = f"{shared_dir(spark)}/turns-{uuid.uuid4().hex}"
    schema = parts[0].schema
    for part in parts:
        part.write.mode("append").parquet(f"{to}/in")
        out = operator(spark.readStream.schema(schema).parquet(f"{to}/in"))
        out.writeStream.format("parquet").option("path", f"{to}/out").option("checkpointLocation", f"{to}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{to}/out")


def status_transitions_stream(spark, d):
    """Changes of role between turns, from a stream that restarts twice."""
    t = _t(spark, d, "conversations").select("conv_id", "turn", "role")
    parts = [t.filter("turn < 2"), t.filter("turn >= 2 and turn < 5"), t.filter("turn >= 5")]
    out = _in_turns(spark, parts, lambda s: state.status_stream(s, "conv_id", ["turn"], "role"))
    return out.select(F.col("id").cast("long").alias("conv_id"), "turn", F.col("old").alias("old_role"), F.col("new").alias("role"))


TRANSITIONS_STREAM = "SELECT conv_id, turn, old_role, role FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS old_role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS v FROM conversations) WHERE v > 1 AND old_role IS DISTINCT FROM role"


def snapshot_changes_stream(spark, d):
    """Fields that change between a user's events, from a stream that restarts."""
    e = _t(spark, d, "events").select("user_id", instant(F.col("ts")).alias("ts"), "event_id", "event_type", (F.col("value") > 50).alias("large"))
    half = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp")
    out = _in_turns(spark, [e.filter(half), e.filter(~half)], lambda s: state.snapshot_stream(s, "user_id", ["ts", "event_id"], ["event_type", "large"]))
    return out.select(F.col("id").cast("long").alias("user_id"), "event_id", "field", "old", "new")


SNAPSHOT_STREAM = """
WITH p AS (
  SELECT user_id, event_id, event_type AS t, CAST(value > 50 AS VARCHAR) AS l, lag(event_type) OVER w AS pt, lag(CAST(value > 50 AS VARCHAR)) OVER w AS pl, row_number() OVER w AS v
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, 'event_type' AS field, pt AS old, t AS new FROM p WHERE v > 1 AND pt IS DISTINCT FROM t
UNION ALL SELECT user_id, event_id, 'large' AS field, pl AS old, l AS new FROM p WHERE v > 1 AND pl IS DISTINCT FROM l"""


def seen_members_stream(spark, d):
    """Event types a user hasn't had before, from a stream of the month in three parts; the first part is a baseline."""
    e = _t(spark, d, "events").select("user_id", instant(F.col("ts")).alias("ts"), F.concat("event_type", F.lit("/"), F.col("props")).alias("member"))
    at = lambda day: F.lit(f"2024-01-{day} 00:00:00").cast("timestamp")
    parts = [e.filter(F.col("ts") < at(10)), e.filter((F.col("ts") >= at(10)) & (F.col("ts") < at(20))), e.filter(F.col("ts") >= at(20))]
    out = _in_turns(spark, parts, lambda s: state.seen_stream(s, "user_id", ["ts"], "member", 1_000_000))
    return out.select(F.col("id").cast("long").alias("user_id"), "member")


SEEN_STREAM = """
WITH e AS (SELECT user_id, event_type || '/' || props AS member, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 0 WHEN ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS part FROM events),
f AS (SELECT user_id, member, min(part) AS part FROM e GROUP BY 1, 2), b AS (SELECT user_id, min(part) AS base FROM e GROUP BY 1)
SELECT user_id, member FROM f JOIN b USING (user_id) WHERE part > base"""


def committed_append(spark, d):
    """Three loads that overlap, one of them repeated: each event is in the table once."""
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    to = f"{shared_dir(spark)}/committed-{uuid.uuid4().hex}"
    loads = [e.filter("value > 70"), e.filter("value > 40 and value < 80").unionByName(e.filter("value > 60 and value < 80")), e.filter("event_type = 'purchase'")]
    for n, rows in enumerate([*loads, loads[0]]):
        commits.append_committed(rows, to, "event_id", stream="loads", batch_id=n)
    commits.compact(spark, to, 4)
    return commits.read_committed(spark, to).select("event_id", "user_id", "event_type")


COMMITTED = "SELECT event_id, user_id, event_type FROM events WHERE value > 40 OR event_type = 'purchase'"


def incremental_read(spark, d):
    """Events as the pages of an API, read as a stream in two goes with an overlap, into a table that takes each identifier once."""
    to = f"{shared_dir(spark)}/paged-{uuid.uuid4().hex}"
    if not to.startswith(("file:", "/")):
        raise ValueError("the folder that stands for the API has to be a mounted one")
    e = _t(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), F.unix_timestamp(instant(F.col("ts"))).alias("ts"), "event_type", "user_id")
    e.withColumn("slot", F.expr("ts div 86400")).repartition("slot").sortWithinPartitions("slot", "ts").write.partitionBy("slot").json(f"{to}/api")
    paged.register(spark)
    read = lambda until: spark.readStream.format("paged").option("transport", "heliograph.sources.paged.SortedFolderTransport").option("path", f"{to}/api").option("start", 0).option("until", until).option("capacity", 20_000).option("pageSize", 5_000).option("leastSeconds", 1).option("overlapMinutes", 600)
    for until in (1_705_000_000, 4_000_000_000):
        query = commits.committed_sink(read(until).load(), f"{to}/table", f"{to}/checkpoint").trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
    rows = commits.read_committed(spark, f"{to}/table")
    got = rows.select(F.col("id").cast("long").alias("event_id"), F.from_json("record", "event_type string, user_id long").alias("r"))
    return got.select("event_id", "r.event_type", "r.user_id")


INCREMENTAL = "SELECT event_id, event_type, user_id FROM events"

def collection_report(spark, d):
    """What a collection by type of event brought: rows, and values out of range as failures, counted while they are read."""
    e = _t(spark, d, "events").select(F.col("event_type").alias("target"), F.when(F.col("value") > 90, F.concat(F.lit("value "), F.floor("value").cast("string"))).alias("error"), F.when(F.col("value") < 5, "low").alias("warning"))
    return diagnostics.run_report(e, warning="warning").withColumn("messages", F.array_join("messages", ","))


REPORT = """
SELECT event_type AS target, count(*) FILTER (value IS NULL OR NOT value > 90) AS rows, count(*) FILTER (value > 90) AS errors, count(*) FILTER (value < 5) AS warnings,
  CASE WHEN count(*) FILTER (value > 90) > 0 THEN 'failed' WHEN count(*) FILTER (value < 5) > 0 THEN 'warned' ELSE 'done' END AS status,
  coalesce(array_to_string(list_sort(list(DISTINCT 'value ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) FILTER (value > 90))[1:5], ','), '') AS messages
FROM events GROUP BY event_type"""

ALL = {
    "collection_report": (collection_report, REPORT), "status_transitions_stream": (status_transitions_stream, TRANSITIONS_STREAM), "snapshot_changes_stream": (snapshot_changes_stream, SNAPSHOT_STREAM), "seen_members_stream": (seen_members_stream, SEEN_STREAM),
    "committed_append": (committed_append, COMMITTED), "incremental_read": (incremental_read, INCREMENTAL),
}
