"""The item record and tables made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, MapType, StringType, StructField, StructType

from heliograph.functions.times import parse_iso

_S = StringType()
_REQUIRED = ("id", "source", "source_id", "kind", "title", "url", "discovered_at")
#: Metadata stays text; keys that queries read are taken from it with from_json or variants.
ITEM_SCHEMA = StructType(
    [StructField(n, _S, False) for n in _REQUIRED]
    + [StructField(n, _S) for n in ("published_at", "updated_at", "summary", "organization", "venue")]
    + [StructField(n, ArrayType(_S)) for n in ("authors", "topics", "matched_terms", "related_items")]
    + [StructField(n, MapType(_S, DoubleType())) for n in ("priority", "scores")]
    + [StructField("metadata", _S)]
)
#: Metadata keys that queries read.
METADATA_SCHEMA = "reportable boolean, action string, status string, discovery_modes array<string>, stars bigint, stars_delta bigint, fork boolean, archived boolean, homepage string, comment string, doi string, pdf_url string, code_urls array<string>, project_urls array<string>, external_urls array<string>, links array<string>, venue_year int"


def with_metadata(items: DataFrame) -> DataFrame:
    """Items with a typed struct ``m`` and parsed times."""
    out = items.withColumn("m", F.from_json("metadata", METADATA_SCHEMA))
    for name in ("discovered_at", "published_at", "updated_at"):
        out = out.withColumn(name.replace("_at", "_ts"), parse_iso(F.col(name)))
    return out


def event_time(items: DataFrame) -> DataFrame:
    """Items with ``ts``: when what they report happened; a change's update time, else publication, else discovery."""
    changed = F.col("m.action").isin("metadata_updated", "status_changed", "updated", "default_branch_advanced")
    return items.withColumn("ts", F.when(changed, F.coalesce("updated_ts", "discovered_ts")).otherwise(F.coalesce("published_ts", "updated_ts", "discovered_ts")))
