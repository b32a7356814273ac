"""The usage job by deltas: new commits become signed parts, which are summed on read.

A run reads the commits above the version it has noted per feed, nothing else. It writes their
partial counts (calls per hour, mutations per ticker, facts per day and user, distinct sketches)
as parts of its own, then the daily statistics of the dates touched, from parts, and notes
the run last. Parts of runs that are not noted are not read; the next run writes them anew. Since
counts are sums, any split of the commits over runs gives the same tables, and late events need
no recomputation of their date from the feed. `compact` sums all parts into one.

Statistics count what was written, as the other usage jobs do; `net=True` lets images before an
update and deletions take back what they gave. A folder keeps to one of both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import usage
from marketlake.plans.usage_rollup import UsagePaths, read_feeds, touched_dates, unseen_commits
from marketlake.sources.tables import overwrite_partitions

_RUNS = "run long, base long, calls long, mutations long"
HOURLY, MUTATIONS, FACTS, DISTINCT = "hourly", "mutations", "facts", "distinct"
_SCHEMAS = {
    HOURLY: "hour timestamp, tool_name string, user_id string, call_count long, success_count long, error_count long, successful_calls long",
    MUTATIONS: "operation string, user_id string, ticker string, rows long",
    FACTS: "user_id string, kind string, value string, rows long, successes long, committed timestamp",
    DISTINCT: "users binary, tickers binary, pairs binary",
}


@dataclass(frozen=True)
class Run:
    """The last noted run, the run its parts begin with, and the versions taken up."""

    run: int = 0
    base: int = 0
    calls: int | None = None
    mutations: int | None = None


def last_run(spark: SparkSession, paths: UsagePaths) -> Run:
    path = paths.rollup("_delta_runs")
    spark.createDataFrame([], _RUNS).write.mode("ignore").parquet(path)
    row = spark.read.schema(_RUNS).parquet(path).orderBy(F.desc("run")).first()
    return Run() if row is None else Run(**row.asDict())


def _note(spark: SparkSession, paths: UsagePaths, run: Run) -> None:
    row = [(run.run, run.base, run.calls, run.mutations)]
    spark.createDataFrame(row, _RUNS).coalesce(1).write.mode("append").parquet(paths.rollup("_delta_runs"))


def _folder(paths: UsagePaths, name: str) -> str:
    return paths.rollup(f"_delta_{name}")


def _write_parts(parts: DataFrame, paths: UsagePaths, name: str, run: int) -> None:
    folder = f"{_folder(paths, name)}/run={run}"
    parts.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(folder)


def read_parts(spark: SparkSession, paths: UsagePaths, name: str, run: Run) -> DataFrame:
    """Parts of all runs up to one; folders of others are not listed."""
    schema = f"{_SCHEMAS[name]}, run long, date date"
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("run", "date").parquet(_folder(paths, name))
    parts = spark.read.schema(schema).parquet(_folder(paths, name))
    return parts.filter(F.col("run").between(run.base, run.run)).drop("run")


def _parts_of(calls: DataFrame, mutations: DataFrame, net: bool) -> dict[str, DataFrame]:
    call_weights = usage.NET if net else usage.WRITTEN_CALLS
    mutation_weights = usage.NET if net else usage.WRITTEN_MUTATIONS
    return {
        HOURLY: usage.hourly_parts(calls, call_weights).withColumn("date", F.to_date("hour")),
        MUTATIONS: usage.watchlist_parts(mutations, mutation_weights),
        FACTS: usage.usage_parts(calls, mutations, call_weights, mutation_weights),
        DISTINCT: usage.distinct_parts(calls),
    }


def run_usage_deltas(spark: SparkSession, paths: UsagePaths, net: bool = False) -> Run:
    """Take up all commits that earlier runs have not; the same run again if there are none."""
    last = last_run(spark, paths)
    calls, mutations = read_feeds(spark, paths)
    new = {"calls": unseen_commits(calls, last.calls), "mutations": unseen_commits(mutations, last.mutations)}
    newest = {name: feed.agg(F.max("_commit_version")).first()[0] for name, feed in new.items()}
    if not any(version is not None for version in newest.values()):
        return last
    # A commit that arrives meanwhile is left to the next run.
    upto = {
        name: feed.limit(0) if newest[name] is None else feed.filter(F.col("_commit_version") <= newest[name])
        for name, feed in new.items()
    }
    run = Run(
        last.run + 1, last.base,
        newest["calls"] if newest["calls"] is not None else last.calls,
        newest["mutations"] if newest["mutations"] is not None else last.mutations,
    )
    for name, parts in _parts_of(upto["calls"], upto["mutations"], net).items():
        _write_parts(parts, paths, name, run.run)
    written = spark.read.schema(f"{_SCHEMAS[FACTS]}, date date").parquet(f"{_folder(paths, FACTS)}/run={run.run}")
    dates = touched_dates(written.select(F.col("date").alias("event_date")))
    if dates:
        touched = read_parts(spark, paths, FACTS, run).filter(F.col("date").isin(dates))
        overwrite_partitions(usage.stats_of_parts(touched), paths.rollup("daily_usage_stats"), ["date"])
    _note(spark, paths, run)
    return run


def compact(spark: SparkSession, paths: UsagePaths) -> Run:
    """Sum all parts into one run of their own. What was taken up stays the same."""
    last = last_run(spark, paths)
    run = Run(last.run + 1, last.run + 1, last.calls, last.mutations)

    def summed(name: str, *keys: str) -> DataFrame:
        parts = read_parts(spark, paths, name, last)
        counts = [c for c in parts.columns if c not in (*keys, "date", "committed")]
        more = [F.max("committed").alias("committed")] if "committed" in parts.columns else []
        return parts.groupBy("date", *keys).agg(*[F.sum(c).alias(c) for c in counts], *more)

    parts = read_parts(spark, paths, DISTINCT, last)
    united = parts.groupBy("date").agg(*[F.hll_union_agg(c).alias(c) for c in ("users", "tickers", "pairs")])
    for name, rows in {
        HOURLY: summed(HOURLY, "hour", "tool_name", "user_id"),
        MUTATIONS: summed(MUTATIONS, "operation", "user_id", "ticker"),
        FACTS: summed(FACTS, "user_id", "kind", "value"),
        DISTINCT: united,
    }.items():
        _write_parts(rows, paths, name, run.run)
    _note(spark, paths, run)
    return run


# Tables on read ----------------------------------------------------------------------------


def hourly_stats(spark: SparkSession, paths: UsagePaths) -> DataFrame:
    return usage.hourly_of_parts(read_parts(spark, paths, HOURLY, last_run(spark, paths)))


def watchlist_stats(spark: SparkSession, paths: UsagePaths) -> DataFrame:
    return usage.watchlist_of_parts(read_parts(spark, paths, MUTATIONS, last_run(spark, paths)))


def daily_stats(spark: SparkSession, paths: UsagePaths) -> DataFrame:
    return usage.stats_of_parts(read_parts(spark, paths, FACTS, last_run(spark, paths)))


def distinct_counts(spark: SparkSession, paths: UsagePaths, *keys: str | Column) -> DataFrame:
    """Estimated distinct users, tickers and pairs, for days or anything made of days."""
    return usage.distinct_of_parts(read_parts(spark, paths, DISTINCT, last_run(spark, paths)), *keys)
