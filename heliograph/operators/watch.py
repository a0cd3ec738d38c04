"""Watched repositories: snapshots, what changed, and the items that report it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliograph.functions.times import parse_iso
from heliograph.functions.urls import short_hash

#: Fields whose change is reported.
MEANINGFUL = ("full_name", "description", "homepage", "topics", "archived", "disabled", "fork", "visibility", "default_branch")
#: The part of a repository's record that is read.
REPOSITORY = (
    "id bigint, name string, full_name string, html_url string, owner struct<login: string>, description string, homepage string, topics array<string>, archived boolean, disabled boolean, fork boolean, "
    "visibility string, default_branch string, created_at string, updated_at string, pushed_at string, stargazers_count bigint, forks_count bigint, language string"
)
RELEASE = "id bigint, tag_name string, name string, html_url string, body string, draft boolean, prerelease boolean, created_at string, published_at string, updated_at string"
TAG = "name string, zipball_url string, commit struct<sha: string>"
COMMIT = "sha string, html_url string, commit struct<message: string, committer: struct<date: string>, author: struct<date: string>>"


def owner_login(r: Column) -> Column:
    """The owner's login, else what stands before the slash of the full name."""
    full = r["full_name"]
    return F.coalesce(r["owner"]["login"], F.when(F.contains(full, F.lit("/")), F.substring_index(full, "/", 1)))


def snapshot(r: Column) -> Column:
    """What is remembered of a repository; flags and counts are never null, topics are in order."""
    flag = lambda name: F.coalesce(r[name], F.lit(False)).alias(name)
    count = lambda name, to: F.coalesce(r[name], F.lit(0).cast("long")).alias(to)
    plain = ("id", "name", "full_name", "html_url")
    return F.struct(
        *[r[c].alias(c) for c in plain], owner_login(r).alias("owner_login"), r["description"].alias("description"), r["homepage"].alias("homepage"),
        F.array_sort(F.coalesce(r["topics"], F.array().cast("array<string>"))).alias("topics"), flag("archived"), flag("disabled"), flag("fork"),
        *[r[c].alias(c) for c in ("visibility", "default_branch", "created_at", "updated_at", "pushed_at")], count("stargazers_count", "stars"), count("forks_count", "forks"),
    )


def popularity(r: Column, before: Column) -> Column:
    """stars, forks, and stars since the snapshot before; none at first sight."""
    stars = F.coalesce(r["stargazers_count"], F.lit(0).cast("long"))
    return F.struct(stars.alias("stars"), F.coalesce(r["forks_count"], F.lit(0).cast("long")).alias("forks"), F.when(before.isNull(), F.lit(0).cast("long")).otherwise(stars - F.coalesce(before["stars"], F.lit(0).cast("long"))).alias("stars_delta"))


def changes(before: Column, now: Column) -> Column:
    """Of two snapshots the meaningful fields that differ, as a map to old and new, as JSON values."""
    one = lambda s, f: F.to_json(F.struct(s[f].alias("v")))
    entries = [F.when(~before[f].eqNullSafe(now[f]), F.struct(F.lit(f).alias("key"), F.struct(F.get_json_object(one(before, f), "$.v").alias("old"), F.get_json_object(one(now, f), "$.v").alias("new")).alias("value"))) for f in MEANINGFUL]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def source_priority(level: Column) -> Column:
    return F.when(level == "high", 1.0).otherwise(0.5)


def release_time(r: Column) -> Column:
    return parse_iso(F.coalesce(F.when(r["published_at"] != "", r["published_at"]), r["created_at"]))


def commit_time(c: Column) -> Column:
    return F.coalesce(c["commit"]["committer"]["date"], c["commit"]["author"]["date"])


def _item(kind: str, source_id: Column, title: Column, url: Column, summary: Column, published: Column, updated: Column, said: list[Column], id_kind: str | None = None) -> Column:
    """An item of a watched repository; rows have r (record), p (popularity), topics, priority and run_at."""
    numbers = [F.col("p")[c].alias(c) for c in ("stars", "forks", "stars_delta")]
    return F.struct(
        F.concat_ws(":", F.lit("github"), F.lit(id_kind or kind), source_id).alias("id"), F.lit("github").alias("source"), source_id.alias("source_id"), F.lit(kind).alias("kind"), title.alias("title"), url.alias("url"),
        F.col("run_at").alias("discovered_at"), published.alias("published_at"), updated.alias("updated_at"), summary.alias("summary"), owner_login(F.col("r")).alias("organization"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"), F.create_map(F.lit("source"), source_priority(F.col("priority"))).alias("priority"), F.to_json(F.struct(*said, *numbers)).alias("metadata"),
    )


def created_items(rows: DataFrame) -> DataFrame:
    r = F.col("r")
    said = [F.lit("created").alias("action"), r["homepage"].alias("homepage"), F.coalesce(r["fork"], F.lit(False)).alias("fork"), F.coalesce(r["archived"], F.lit(False)).alias("archived")]
    return rows.select(_item("repository", r["id"].cast("string"), r["full_name"], r["html_url"], r["description"], r["created_at"], r["updated_at"], said).alias("i")).select("i.*")


def updated_items(rows: DataFrame) -> DataFrame:
    """``rows`` also have changes, of which there is at least one; the identifier holds their fingerprint."""
    r = F.col("r")
    mark = short_hash(F.to_json(F.map_from_entries(F.array_sort(F.map_entries("changes")))), 16)
    source_id = F.concat_ws(":", r["id"].cast("string"), F.lit("metadata"), F.coalesce(r["updated_at"], F.lit("None")), mark)
    said = [F.lit("metadata_updated").alias("action"), F.col("changes")]
    return rows.filter(F.size("changes") > 0).select(_item("event", source_id, F.concat(r["full_name"], F.lit(" repository metadata updated")), r["html_url"], r["description"], r["updated_at"], r["updated_at"], said).alias("i")).select("i.*")


def release_items(rows: DataFrame) -> DataFrame:
    """``rows`` also have release."""
    r, x = F.col("r"), F.col("release")
    tag = F.coalesce(F.when(x["tag_name"] != "", x["tag_name"]), F.lit("release"))
    said = [F.lit("released").alias("action"), tag.alias("tag_name"), F.coalesce(x["prerelease"], F.lit(False)).alias("prerelease"), F.coalesce(x["draft"], F.lit(False)).alias("draft")]
    source_id = F.concat_ws(":", r["id"].cast("string"), F.lit("release"), x["id"].cast("string"))
    title = F.concat_ws(" ", r["full_name"], F.coalesce(F.when(x["name"] != "", x["name"]), tag))
    return rows.select(_item("release", source_id, title, F.coalesce(x["html_url"], r["html_url"]), x["body"], F.coalesce(x["published_at"], x["created_at"]), x["updated_at"], said).alias("i")).select("i.*")


def tag_items(rows: DataFrame) -> DataFrame:
    """``rows`` also have tag."""
    r, x, none = F.col("r"), F.col("tag"), F.lit(None).cast("string")
    said = [F.lit("tagged").alias("action"), x["name"].alias("tag_name"), x["commit"]["sha"].alias("commit_sha")]
    source_id = F.concat_ws(":", r["id"].cast("string"), F.lit("tag"), x["name"])
    return rows.select(_item("tag", source_id, F.concat_ws(" tagged ", r["full_name"], x["name"]), F.coalesce(x["zipball_url"], r["html_url"]), none, none, none, said).alias("i")).select("i.*")


def commit_items(rows: DataFrame) -> DataFrame:
    """``rows`` also have commit and previous_head; a head that hasn't moved, or that is the first one seen, gives none."""
    r, x = F.col("r"), F.col("commit")
    message = F.coalesce(F.when(x["commit"]["message"] != "", x["commit"]["message"]), F.substring(x["sha"], 1, 12))
    said = [F.lit("default_branch_advanced").alias("action"), x["sha"].alias("sha"), F.col("previous_head"), r["default_branch"].alias("default_branch")]
    source_id = F.concat_ws(":", r["id"].cast("string"), F.lit("commit"), x["sha"])
    moved = rows.filter(F.col("previous_head").isNotNull() & (F.col("previous_head") != x["sha"]))
    return moved.select(_item("commit", source_id, F.concat(r["full_name"], F.lit(" default branch advanced")), F.coalesce(x["html_url"], r["html_url"]), F.element_at(F.split(message, r"\R"), 1), commit_time(x), F.lit(None).cast("string"), said).alias("i")).select("i.*")


def revisions(listed: DataFrame, known: DataFrame, key: str = "id", version: str = "last_modified") -> DataFrame:
    """``listed`` with action: discovered or updated; records whose version is the known one are left out."""
    before = known.select(F.col(key), F.struct(F.col(version).alias("v")).alias("__known"))
    out = listed.join(before, key, "left").withColumn("action", F.when(F.col("__known").isNull(), "discovered").otherwise("updated"))
    return out.filter(F.col("__known").isNull() | ~F.col("__known")["v"].eqNullSafe(F.col(version))).drop("__known")


def created_since(listed: DataFrame, checked: DataFrame, account: str = "account", created: str = "created_at") -> DataFrame:
    """Repositories of each account that are newer than its last check; an account without one is a baseline and gives none."""
    last = checked.select(account, F.col("last_checked").alias("__last"))
    return listed.join(last, account).filter(F.col("__last").isNotNull() & (parse_iso(F.col(created)) > parse_iso(F.col("__last")))).drop("__last")


def kept_targets(state: DataFrame, targets: DataFrame, name: str = "full_name") -> DataFrame:
    """State of repositories that are still watched; names are compared without case."""
    wanted = targets.select(F.lower("repo").alias("__n")).distinct()
    return state.join(wanted, F.lower(F.col(name)) == F.col("__n"), "left_semi")
