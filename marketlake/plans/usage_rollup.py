"""The usage job: new feed commits to rewritten rollup partitions.

Feeds are written by `changefeed.write_feed`. A run finds the event dates touched by commits
it has not seen and recomputes those dates from the feed, so late events land in their old
dates and a repeated run changes nothing. What has been seen is a commit version per feed,
noted when all rollups are written: a feed that lags behind the other loses nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.moments import Moment
from marketlake.operators import usage
from marketlake.operators.changefeed import read_stored_changes
from marketlake.schemas import AGENT_TOOL_CALLS, DAILY_USAGE_STATS, WATCHLIST_MUTATIONS, feed_of
from marketlake.sources.tables import overwrite_partitions

_EVENT_DATE = T.StructField("event_date", T.DateType())


def stored_feed_schema(table: T.StructType) -> T.StructType:
    return T.StructType([*feed_of(table).fields, _EVENT_DATE])


@dataclass(frozen=True)
class UsagePaths:
    """Folders of the two feeds and of the rollups."""

    calls: str
    mutations: str
    rollups: str

    def rollup(self, name: str) -> str:
        return f"{self.rollups}/{name}"


def read_feeds(spark: SparkSession, paths: UsagePaths) -> tuple[DataFrame, DataFrame]:
    calls = spark.read.schema(stored_feed_schema(AGENT_TOOL_CALLS)).parquet(paths.calls)
    mutations = spark.read.schema(stored_feed_schema(WATCHLIST_MUTATIONS)).parquet(paths.mutations)
    return calls, mutations


def read_daily_stats(spark: SparkSession, paths: UsagePaths) -> DataFrame:
    """The daily rollup, created without rows if it does not exist."""
    path = paths.rollup("daily_usage_stats")
    spark.createDataFrame([], DAILY_USAGE_STATS).write.mode("ignore").partitionBy("date").parquet(path)
    return spark.read.schema(DAILY_USAGE_STATS).parquet(path).select(*DAILY_USAGE_STATS.names)


def refresh_dates(spark: SparkSession, paths: UsagePaths, dates: Sequence[date]) -> dict[str, int | str]:
    """Recompute all rollups for the given event dates.

    Returns rows written, or the error, per rollup. One failing rollup does not stop the
    other; the daily statistics are only written when both succeeded.
    """
    if not dates:
        return {}
    calls, mutations = (f.filter(F.col("event_date").isin(list(dates))) for f in read_feeds(spark, paths))
    rollups = {
        "hourly_tool_stats": usage.tool_calls_hourly(calls).withColumn("date", F.to_date("hour")),
        "daily_watchlist_stats": usage.watchlist_daily(mutations),
    }
    report: dict[str, int | str] = {}
    for name, rows in rollups.items():
        try:
            report[name] = overwrite_partitions(rows, paths.rollup(name), ["date"])
        except Exception as error:  # noqa: BLE001 - reported, and retried by the next run
            report[name] = str(error)
    if all(isinstance(outcome, int) for outcome in report.values()):
        daily = usage.daily_usage_stats(calls, mutations)
        report["daily_usage_stats"] = overwrite_partitions(daily, paths.rollup("daily_usage_stats"), ["date"])
    return report


def touched_dates(*changes: DataFrame) -> list[date]:
    """Event dates in the given feed rows: at most one per calendar day."""
    days = changes[0].select("event_date")
    for change in changes[1:]:
        days = days.unionByName(change.select("event_date"))
    return [row["event_date"] for row in days.distinct().collect()]


_MARKS = T.StructType([T.StructField("feed", T.StringType()), T.StructField("version", T.LongType())])


def _seen(spark: SparkSession, paths: UsagePaths) -> dict[str, int]:
    """The last commit version taken up, per feed."""
    path = paths.rollup("_marks")
    spark.createDataFrame([], _MARKS).write.mode("ignore").parquet(path)
    rows = spark.read.schema(_MARKS).parquet(path).groupBy("feed").agg(F.max("version").alias("version"))
    return {row["feed"]: row["version"] for row in rows.collect()}


def unseen_commits(feed: DataFrame, version: int | None) -> DataFrame:
    """Feed rows of later commits; folders of earlier ones are not listed."""
    return feed if version is None else feed.filter(F.col("_commit_version") > version)


def run_usage_rollup(spark: SparkSession, paths: UsagePaths, since: Moment | None = None) -> dict[str, int | str]:
    """One scheduled run over all commits that earlier runs have not taken up.

    A first run starts at the beginning of the feeds, or at the commits of `since` if that is
    given. Raises when a rollup failed; the next run tries its dates again.
    """
    seen = _seen(spark, paths)
    new = {}
    for name, path, feed in zip(("calls", "mutations"), (paths.calls, paths.mutations), read_feeds(spark, paths)):
        if name not in seen and since is not None:
            new[name] = read_stored_changes(feed, path, since)
        else:
            new[name] = unseen_commits(feed, seen.get(name))
    # The newest version is taken before the dates: a commit that arrives meanwhile is new again.
    newest = {name: feed.agg(F.max("_commit_version")).first()[0] for name, feed in new.items()}
    upto = [new[name].filter(F.col("_commit_version") <= version) for name, version in newest.items() if version is not None]
    report = refresh_dates(spark, paths, touched_dates(*upto)) if upto else {}
    failed = {name: outcome for name, outcome in report.items() if isinstance(outcome, str)}
    if failed:
        raise RuntimeError(f"rollups failed: {failed}")
    marks = [(name, version) for name, version in newest.items() if version is not None]
    if marks:
        spark.createDataFrame(marks, _MARKS).coalesce(1).write.mode("append").parquet(paths.rollup("_marks"))
    return report
