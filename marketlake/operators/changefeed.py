"""Change feeds of keyed tables: produce, read, apply."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.moments import Moment, moment

# The change types of a feed.
INSERT = "insert"
BEFORE_UPDATE = "update_preimage"
AFTER_UPDATE = "update_postimage"
DELETE = "delete"
CURRENT_ROWS = (INSERT, AFTER_UPDATE)
# Fixed value: days a feed is read back when no start is given.
FEED_DAYS = 7


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes that lead from one snapshot of a keyed table to the next.

    Keys are unique in each snapshot. An update gives two rows, before and after.
    """
    values = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*values).alias("_old"))
    after = new.select(*keys, F.struct(*values).alias("_new"))
    pairs = before.join(after, list(keys), "full_outer")
    old_row, new_row = F.col("_old"), F.col("_new")

    def change(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), row.alias("row"))

    changes = (
        F.when(old_row.isNull(), F.array(change(INSERT, new_row)))
        .when(new_row.isNull(), F.array(change(DELETE, old_row)))
        .otherwise(F.array(change(BEFORE_UPDATE, old_row), change(AFTER_UPDATE, new_row)))
    )
    return (
        pairs.filter(~old_row.eqNullSafe(new_row))
        .select(*keys, F.explode(changes).alias("_change"))
        .select(*keys, *[F.col("_change.row")[c].alias(c) for c in values],
                F.col("_change.kind").alias("_change_type"))
    )


def committed(changes: DataFrame, version: int, at: Moment) -> DataFrame:
    """Changes stamped with the commit that made them."""
    return changes.withColumns({
        "_commit_version": F.lit(version).cast("long"),
        "_commit_timestamp": moment(at),
    })


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after one commit: touched keys leave, current images enter."""
    kept = old.join(changes.select(*keys), list(keys), "left_anti")
    current = changes.filter(F.col("_change_type").isin(*CURRENT_ROWS))
    return kept.unionByName(current.select(old.columns))


def read_changes(feed: DataFrame, since: Moment | None = None, as_of: datetime | None = None) -> DataFrame:
    """Feed rows committed at `since` or later, or in the week before `as_of`."""
    if since is None:
        if as_of is None:
            raise ValueError("give a start, or the time the look-back ends")
        since = as_of - timedelta(days=FEED_DAYS)
    return feed.filter(F.col("_commit_timestamp") >= moment(since))


def commits_path(path: str) -> str:
    """Folder of a stored feed's commits; readers of the feed itself pass it by."""
    return f"{path}/_commits"


def write_feed(feed: DataFrame, path: str, event_time: str) -> None:
    """Append a feed, partitioned by commit and by event date.

    A reader from a commit on, and a reader of given dates, each skip all other folders.
    Rebalancing splits the files of a very large commit and merges small ones. The versions
    and times of the commits, and of their newest events, are noted beside the feed, before its rows: a reader may find a
    commit without rows, never rows without their commit.
    """
    dated = feed.withColumn("event_date", F.to_date(event_time))
    commits = dated.groupBy("_commit_version").agg(
        F.max("_commit_timestamp").alias("committed_at"), F.max(event_time).alias("newest_event")
    )
    commits.coalesce(1).write.mode("append").parquet(commits_path(path))
    dated.hint("rebalance", "_commit_version", "event_date").write.mode("append").partitionBy(
        "_commit_version", "event_date"
    ).parquet(path)


def first_version(spark: SparkSession, path: str, since: Moment) -> int | None:
    """The first commit of a stored feed at `since` or later, found without reading the feed."""
    commits = spark.read.schema("_commit_version long, committed_at timestamp").parquet(commits_path(path))
    return commits.filter(F.col("committed_at") >= moment(since)).agg(F.min("_commit_version")).first()[0]


def read_stored_changes(feed: DataFrame, path: str, since: Moment) -> DataFrame:
    """`read_changes` over a stored feed: only folders of commits from `since` on are listed."""
    version = first_version(feed.sparkSession, path, since)
    if version is None:
        return feed.limit(0)
    return read_changes(feed.filter(F.col("_commit_version") >= version), since)
