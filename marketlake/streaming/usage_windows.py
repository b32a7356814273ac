"""Hourly usage as a stream with state: windows, a watermark, and a way for rows behind it.

State holds the counts of the hours that may still change; each micro-batch writes the counts of
the hours it changed, and the newest ones of an hour count. An hour is closed once the events
go on from its end by the allowed delay, and its state is dropped.

What is behind the watermark would be dropped by the stream. Whether a row is behind is therefore
decided before, from the commits alone: its hour ended by the delay before the newest event of
all earlier commits. As files are taken in the order of their commits, the stream's own watermark is
never ahead of that, so it drops nothing. Rows behind go to a table of their own, and their
counts are added when the hours are read; counts are sums, so nothing is read again for them.

Batches are written under their number, so one that is delivered twice replaces itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators import usage
from marketlake.operators.changefeed import CURRENT_ROWS, commits_path
from marketlake.plans.usage_rollup import UsagePaths, stored_feed_schema
from marketlake.schemas import AGENT_TOOL_CALLS

DELAY = "1 day"
_COUNTS = "call_count long, success_count long, error_count long, successful_calls long"
_HOURS = f"hour timestamp, tool_name string, user_id string, {_COUNTS}, batch long"
_COMMITS = "_commit_version long, newest_event timestamp"


def closed_hours(spark: SparkSession, path: str, delay: str = DELAY) -> DataFrame:
    """Per commit of a stored feed, up to when hours are closed for it; null for the first."""
    commits = spark.read.schema(_COMMITS).parquet(commits_path(path))
    newest = commits.groupBy("_commit_version").agg(F.max("newest_event").alias("newest_event"))
    # One row per commit.
    earlier = Window.orderBy("_commit_version").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("newest_event").over(earlier)
    return newest.select("_commit_version", (before - F.expr(f"interval {delay}")).alias("closed_until"))


def _hour_end(time: str) -> Column:
    return F.date_trunc("hour", time) + F.expr("interval 1 hour")


def start_window_stream(
    spark: SparkSession, paths: UsagePaths, checkpoint: str, delay: str = DELAY, files_per_batch: int | None = None
) -> list[StreamingQuery]:
    """Take up all call files that arrived since the last run, then stop: one query for the hours,
    one for the rows behind the watermark."""
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": str(files_per_batch)}

    def arriving(behind: bool) -> DataFrame:
        stream = spark.readStream.schema(stored_feed_schema(AGENT_TOOL_CALLS)).options(**options).parquet(paths.calls)
        rows = stream.filter(F.col("_change_type").isin(*CURRENT_ROWS))
        rows = rows.join(closed_hours(spark, paths.calls, delay), "_commit_version", "left")
        late = F.coalesce(_hour_end("timestamp") <= F.col("closed_until"), F.lit(False))
        return rows.filter(late if behind else ~late).drop("closed_until")

    def into(name: str):
        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{paths.rollup(name)}/batch={number}")

        return write

    error = F.col("error_message").isNotNull()
    hours = arriving(behind=False).withWatermark("timestamp", delay).groupBy(F.window("timestamp", "1 hour"), "tool_name", "user_id").agg(
        F.count("*").alias("call_count"),
        F.sum(F.col("success").cast("long")).alias("success_count"),
        F.count_if(error).alias("error_count"),
        F.count_if(~error).alias("successful_calls"),
    )
    hours = hours.select(F.col("window.start").alias("hour"), "tool_name", "user_id", "call_count", "success_count", "error_count", "successful_calls")
    late = usage.hourly_columns(arriving(behind=True))
    return [
        frame.writeStream.foreachBatch(into(name)).outputMode(mode).trigger(availableNow=True)
        .option("checkpointLocation", f"{checkpoint}/{name}").start()
        for name, frame, mode in (("windowed_hours", hours, "update"), ("late_calls", late, "append"))
    ]


def _read(spark: SparkSession, paths: UsagePaths, name: str, schema: str) -> DataFrame:
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("batch").parquet(paths.rollup(name))
    return spark.read.schema(schema).parquet(paths.rollup(name))


def hourly_stats(spark: SparkSession, paths: UsagePaths) -> DataFrame:
    """Calls per hour, tool and user: the newest counts of every hour, and what came behind."""
    hours = _read(spark, paths, "windowed_hours", _HOURS)
    counts = [c.split(" ")[0] for c in _COUNTS.split(", ")]
    newest = hours.groupBy("hour", "tool_name", "user_id").agg(F.max(F.struct("batch", *counts)).alias("_newest"))
    newest = newest.select("hour", "tool_name", "user_id", *[F.col("_newest")[c].alias(c) for c in counts])
    behind = _read(spark, paths, "late_calls", _HOURS).drop("batch")
    return usage.hourly_of_parts(newest.unionByName(behind))
