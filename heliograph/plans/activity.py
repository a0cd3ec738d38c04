"""Registered queries over events: activity, momentum, growth, changes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.functions.numbers import numeric_int, round_floor
from heliograph.functions.times import activity_date, half_open, instant, report_window, spine
from heliograph.operators import changes, ingest, trends
from heliograph.storage import shared_dir, written
from heliograph.streaming import loads

END = "2024-01-31 00:00:00"
LAST_DAY = "2024-01-31"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _activity(spark: SparkSession, d: str) -> DataFrame:
    ts = instant(F.col("ts"))
    return _t(spark, d, "events").select(
        ts.alias("ts"), activity_date(ts).alias("day"), F.col("user_id").alias("identity"), F.col("event_id").alias("item"), F.col("event_type").alias("kind"),
        F.array(F.get_json_object("props", "$.k")).alias("topics"), "value",
    )


_DAY = "CAST(date_trunc('day', ts + INTERVAL 1 HOUR) AS DATE) + 1"  # +9 h of Tokyo, -8 h of the boundary


def _momentum(days: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return trends.momentum(_activity(spark, d), F.lit(END).cast("timestamp"), days, None, 1.0, 2, 15)

    sql = f"""
WITH e AS (SELECT user_id, ts, json_extract_string(props, '$.k') AS topic, ts >= TIMESTAMP '{END}' - INTERVAL {days} DAY AS now
  FROM events WHERE ts >= TIMESTAMP '{END}' - INTERVAL {2 * days} DAY AND ts < TIMESTAMP '{END}'),
t AS (SELECT count(DISTINCT CASE WHEN now THEN user_id END) AS a, count(DISTINCT CASE WHEN NOT now THEN user_id END) AS b FROM e),
n AS (SELECT count(DISTINCT json_extract_string(props, '$.k')) AS n FROM events),
c AS (SELECT topic, count(DISTINCT CASE WHEN now THEN user_id END) AS current, count(DISTINCT CASE WHEN NOT now THEN user_id END) AS previous FROM e GROUP BY topic),
m AS (SELECT topic, current, previous, floor(log2(((current + 1) / (a + 1.0::DOUBLE * n)) / ((previous + 1) / (b + 1.0::DOUBLE * n))) * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS momentum
  FROM c, t, n WHERE current >= 2)
SELECT topic, current, previous, momentum FROM m ORDER BY momentum DESC, current DESC, topic LIMIT 15"""
    return run, sql


def daily_activity(spark, d):
    return trends.daily_activity(_activity(spark, d), spine(spark, LAST_DAY, 30))


DAILY_ACTIVITY = f"""
WITH s AS (SELECT CAST(DATE '{LAST_DAY}' - CAST(i AS INTEGER) AS DATE) AS day FROM range(30) r(i)),
a AS (SELECT {_DAY} AS day, count(*) AS items, count(DISTINCT user_id) AS entities FROM events GROUP BY 1)
SELECT s.day, coalesce(items, 0) AS items, coalesce(entities, 0) AS entities FROM s LEFT JOIN a ON s.day = a.day"""


def daily_kind_counts(spark, d):
    out = trends.daily_counts(_activity(spark, d), "kind")
    return out.select("day", F.array_join(F.transform(F.map_entries("by_kind"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("kinds"))


DAILY_KINDS = f"""
SELECT day, string_agg(event_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY event_type) AS kinds
FROM (SELECT {_DAY} AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY day"""


def topic_daily_entities(spark, d):
    return trends.daily_topics(_activity(spark, d))


TOPIC_DAILY = f"SELECT {_DAY} AS day, json_extract_string(props, '$.k') AS topic, count(DISTINCT user_id) AS entities FROM events GROUP BY 1, 2"


def new_entity_growth(spark, d):
    return trends.new_entity_growth(trends.first_seen(_activity(spark, d), ["kind", "identity"]), F.lit("2024-01-15 00:00:00").cast("timestamp"), 7, "kind")


GROWTH = """
WITH f AS (SELECT event_type AS kind, user_id, min(ts) AS t FROM events GROUP BY 1, 2),
c AS (SELECT kind, count(*) FILTER (t >= TIMESTAMP '2024-01-08' AND t < TIMESTAMP '2024-01-15') AS current, count(*) FILTER (t >= TIMESTAMP '2024-01-01' AND t < TIMESTAMP '2024-01-08') AS previous FROM f GROUP BY kind)
SELECT kind, current, previous, current - previous AS delta,
  CASE WHEN previous = 0 THEN CASE WHEN current = 0 THEN 0.0::DOUBLE END ELSE floor((current - previous) * 100.0::DOUBLE / previous * 100::DOUBLE + 0.5::DOUBLE) / 100::DOUBLE END AS percent FROM c"""


def first_seen_daily(spark, d):
    first = trends.first_seen(_activity(spark, d), ["kind", "identity"])
    return first.groupBy(activity_date(F.col("first_ts")).alias("day"), "kind").agg(F.count("*").alias("new_entities"))


FIRST_SEEN = f"SELECT {_DAY} AS day, kind, count(*) AS new_entities FROM (SELECT event_type AS kind, user_id, min(ts) AS ts FROM events GROUP BY 1, 2) GROUP BY 1, 2"


def recurring_entities(spark, d):
    a = _activity(spark, d).withColumn("title", F.concat(F.col("kind"), F.lit("#"), F.col("item").cast("string")))
    prio = F.when(F.col("kind") == "purchase", 0).when(F.col("kind") == "view", 1).otherwise(99)
    return trends.recurring(a, 3, 2, 20, prio).drop("last_ts")


RECURRING = f"""
WITH e AS (SELECT *, {_DAY} AS day, CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 99 END AS prio FROM events)
SELECT user_id AS identity, count(*) AS items, count(DISTINCT day) AS active_days, arg_min(event_type || '#' || CAST(event_id AS VARCHAR), prio * 1000000000000 + event_id) AS title,
  array_to_string(list_sort(list_distinct(list(event_type))), ',') AS kinds
FROM e GROUP BY user_id HAVING count(*) >= 3 AND count(DISTINCT day) >= 2 ORDER BY active_days DESC, items DESC, identity LIMIT 20"""


def report_window_filter(spark, d):
    start, end = report_window(F.lit("2024-01-10").cast("date"))
    ts = instant(F.col("ts"))
    return _t(spark, d, "events").filter(half_open(ts, start, end)).select("event_id", "user_id", "event_type")


REPORT_WINDOW = "SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-08 23:00:00' AND ts < TIMESTAMP '2024-01-09 23:00:00'"


def idempotent_append(spark, d):
    """What a second load adds to a first one: overlapping types, and rows that the load itself repeats."""
    e = _t(spark, d, "events")
    known, batch = e.filter("event_type in ('view', 'click')"), e.filter("value > 20").unionByName(e.filter("value > 60"))
    return ingest.new_rows(batch, known, "event_id", [F.asc("ts")]).select("event_id", "user_id", "event_type")


APPEND = "SELECT event_id, user_id, event_type FROM events WHERE value > 20 AND event_type NOT IN ('view', 'click')"


def snapshot_changes(spark, d):
    out = changes.with_previous(_t(spark, d, "events"), ["user_id"], [F.asc("ts"), F.asc("event_id")], ["event_type", "value"])
    moved = round_floor(changes.delta(F.col("value"), F.col("previous_value")), 4)
    fields = changes.changed_fields(["event_type"])
    what = F.array_join(F.transform(F.map_entries(fields), lambda e: F.concat(e["key"], F.lit(":"), F.coalesce(e["value"]["old"], F.lit("")), F.lit(">"), e["value"]["new"])), ",")
    return out.select("event_id", "user_id", "version", moved.alias("value_delta"), what.alias("changed"))


SNAPSHOT = """
WITH p AS (SELECT *, lag(event_type) OVER w AS pt, lag(value) OVER w AS pv, row_number() OVER w AS version FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, CAST(version AS INTEGER) AS version, floor((value - coalesce(pv, value)) * 10000::DOUBLE + 0.5::DOUBLE) / 10000::DOUBLE AS value_delta,
  CASE WHEN pt IS DISTINCT FROM event_type THEN 'event_type:' || coalesce(pt, '') || '>' || event_type ELSE '' END AS changed FROM p"""


def json_props(spark, d):
    return _t(spark, d, "events").groupBy(numeric_int(F.col("props"), "$.k").alias("k")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


JSON_PROPS = "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1"


def tumbling_window_counts(spark, d):
    out = loads.daily_counts(_t(spark, d, "events").withColumn("ts", instant(F.col("ts"))), "ts", "event_type")
    return out.select(F.to_date(F.from_utc_timestamp("window.end", "Asia/Tokyo")).alias("day"), "event_type", "n")


TUMBLING = f"SELECT {_DAY} AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"


def watermark_dedupe(spark, d):
    """A stream over the table's files in which rows come twice, deduplicated within a watermark and written out."""
    whole = spark.readStream.schema(_t(spark, d, "events").schema).option("pathGlobFilter", "events.parquet").parquet(d)
    again = whole.unionByName(whole.filter("value > 50")).withColumn("ts", instant(F.col("ts")))
    to = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    stream = loads.once_by_id(again, "event_id", "ts", "60 days").select("event_id", "event_type")
    stream.writeStream.format("parquet").option("path", f"{to}/rows").option("checkpointLocation", f"{to}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("event_id long, event_type string").parquet(f"{to}/rows").groupBy("event_type").agg(F.count("*").alias("n"))


DEDUPE = "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1"


def status_transitions(spark, d):
    return changes.transitions(_t(spark, d, "conversations"), ["conv_id"], [F.asc("turn")], "role").select("conv_id", "turn", F.col("previous_role").alias("old_role"), "role")


TRANSITIONS = "SELECT conv_id, turn, old_role, role FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS old_role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS v FROM conversations) WHERE v > 1 AND old_role IS DISTINCT FROM role"

def rolling_topic_entities(spark, d):
    """Distinct users of each topic in the 7 and 30 days up to each of the last ten days, from one table of daily bitmaps."""
    a = _activity(spark, d)
    return trends.rolling_entities(written(trends.daily_bitmaps(a, trends.numbered(a))), spine(spark, LAST_DAY, 10))


ROLLING = f"""
WITH s AS (SELECT CAST(DATE '{LAST_DAY}' - CAST(i AS INTEGER) AS DATE) AS day FROM range(10) r(i)),
e AS (SELECT DISTINCT {_DAY} AS d, json_extract_string(props, '$.k') AS topic, user_id FROM events)
SELECT s.day, topic, count(DISTINCT CASE WHEN d > s.day - 7 THEN user_id END) AS entities_7, count(DISTINCT user_id) AS entities_30
FROM s JOIN e ON d <= s.day AND d > s.day - 30 GROUP BY 1, 2"""

_M7, _M14 = _momentum(7), _momentum(14)
ALL = {
    "topic_momentum_7d": _M7, "topic_momentum_14d": _M14, "daily_activity": (daily_activity, DAILY_ACTIVITY), "daily_kind_counts": (daily_kind_counts, DAILY_KINDS),
    "topic_daily_entities": (topic_daily_entities, TOPIC_DAILY), "new_entity_growth": (new_entity_growth, GROWTH), "first_seen_daily": (first_seen_daily, FIRST_SEEN),
    "recurring_entities": (recurring_entities, RECURRING), "report_window_filter": (report_window_filter, REPORT_WINDOW), "idempotent_append": (idempotent_append, APPEND),
    "snapshot_changes": (snapshot_changes, SNAPSHOT), "json_props": (json_props, JSON_PROPS), "tumbling_window_counts": (tumbling_window_counts, TUMBLING),
    "rolling_topic_entities": (rolling_topic_entities, ROLLING), "watermark_dedupe": (watermark_dedupe, DEDUPE), "status_transitions": (status_transitions, TRANSITIONS),
}
