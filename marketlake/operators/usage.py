"""Usage statistics over the tool-call and watchlist feeds."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.moments import Moment, moment
from marketlake.operators.changefeed import AFTER_UPDATE, BEFORE_UPDATE, CURRENT_ROWS, DELETE, INSERT
from marketlake.schemas import DAILY_USAGE_STATS

# Fixed value: look-back of the dashboard, in days.
DASHBOARD_DAYS = 7


def tool_calls_hourly(feed: DataFrame) -> DataFrame:
    """Calls per hour, tool and user, over inserts and rows after an update.

    `success_count` sums the flag, `successful_calls` counts rows without an error message;
    they differ when a failure has no message.
    """
    current = feed.filter(F.col("_change_type").isin(*CURRENT_ROWS))
    return current.groupBy(
        F.date_trunc("hour", "timestamp").alias("hour"), "tool_name", "user_id"
    ).agg(
        F.count("*").alias("call_count"),
        F.sum(F.col("success").cast("int")).alias("success_count"),
        F.count("error_message").alias("error_count"),
        (F.count("*") - F.count("error_message")).alias("successful_calls"),
    )


# What a feed row of a type counts for. Statistics count what was written; taken net, a row
# before an update and a deleted row take back what their earlier images gave.
WRITTEN_CALLS = {INSERT: 1, AFTER_UPDATE: 1}
WRITTEN_MUTATIONS = {INSERT: 1}
NET = {INSERT: 1, AFTER_UPDATE: 1, BEFORE_UPDATE: -1, DELETE: -1}


def _weighed(feed: DataFrame, weights: dict[str, int]) -> DataFrame:
    """Feed rows that count, with their weight."""
    weight = F.lit(0)
    for change, value in weights.items():
        weight = F.when(F.col("_change_type") == change, value).otherwise(weight)
    return feed.filter(F.col("_change_type").isin(list(weights))).withColumn("_weight", weight)


def hourly_parts(feed: DataFrame, weights: dict[str, int] = WRITTEN_CALLS) -> DataFrame:
    """Calls per hour, tool and user of some commits; parts of several commits are summed."""
    error = F.col("error_message").isNotNull()
    return _weighed(feed, weights).groupBy(F.date_trunc("hour", "timestamp").alias("hour"), "tool_name", "user_id").agg(
        F.sum("_weight").alias("call_count"),
        F.sum(F.when(F.col("success"), F.col("_weight")).otherwise(0)).alias("success_count"),
        F.sum(F.when(error, F.col("_weight")).otherwise(0)).alias("error_count"),
        F.sum(F.when(error, 0).otherwise(F.col("_weight"))).alias("successful_calls"),
    )


def hourly_columns(calls: DataFrame) -> DataFrame:
    """Every call as a part of its own."""
    error = F.col("error_message").isNotNull().cast("long")
    return calls.select(
        F.date_trunc("hour", "timestamp").alias("hour"), "tool_name", "user_id", F.lit(1).cast("long").alias("call_count"),
        F.col("success").cast("long").alias("success_count"), error.alias("error_count"), (1 - error).alias("successful_calls"),
    )


def hourly_of_parts(parts: DataFrame) -> DataFrame:
    counts = ("call_count", "success_count", "error_count", "successful_calls")
    summed = parts.groupBy("hour", "tool_name", "user_id").agg(*[F.sum(c).alias(c) for c in counts])
    return summed.filter(F.col("call_count") != 0)


def watchlist_parts(feed: DataFrame, weights: dict[str, int] = WRITTEN_MUTATIONS) -> DataFrame:
    """Mutations per day, operation, user and ticker: a very busy user is spread over the tickers."""
    return _weighed(feed, weights).groupBy(F.to_date("timestamp").alias("date"), "operation", "user_id", "ticker").agg(
        F.sum("_weight").alias("rows")
    )


def watchlist_of_parts(parts: DataFrame) -> DataFrame:
    per_ticker = parts.groupBy("date", "operation", "user_id", "ticker").agg(F.sum("rows").alias("rows")).filter("rows != 0")
    return per_ticker.groupBy("date", "operation", "user_id").agg(
        F.sum("rows").alias("mutation_count"), F.count("ticker").alias("unique_tickers")
    )


def watchlist_daily(feed: DataFrame) -> DataFrame:
    """Mutations and distinct tickers per day, operation and user, over inserts."""
    return watchlist_of_parts(watchlist_parts(feed))


def usage_parts(
    calls: DataFrame,
    mutations: DataFrame,
    call_weights: dict[str, int] = WRITTEN_CALLS,
    mutation_weights: dict[str, int] = WRITTEN_MUTATIONS,
) -> DataFrame:
    """Both feeds as (date, user, kind, value) facts, summed; parts of several commits are summed.

    A call is one `tool` and one `ticker` fact, a mutation one fact of its operation. Calls
    are read once; a busy user or day is spread over tools and tickers.
    """

    def fact(kind: str, value: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(value).alias("value"))

    call_facts = _weighed(calls, call_weights).select(
        F.to_date("timestamp").alias("date"),
        "user_id",
        F.when(F.col("success"), F.col("_weight")).otherwise(0).alias("success"),
        "_weight",
        "_commit_timestamp",
        F.explode(F.array(fact("tool", "tool_name"), fact("ticker", "ticker"))).alias("fact"),
    )
    mutation_facts = _weighed(mutations, mutation_weights).select(
        F.to_date("timestamp").alias("date"),
        "user_id",
        F.lit(0).alias("success"),
        "_weight",
        "_commit_timestamp",
        fact("operation", "operation").alias("fact"),
    )
    return (
        call_facts.unionByName(mutation_facts)
        .groupBy("date", "user_id", "fact.kind", "fact.value")
        .agg(
            F.sum("_weight").alias("rows"),
            F.sum("success").alias("successes"),
            F.max("_commit_timestamp").alias("committed"),
        )
    )


def stats_of_parts(parts: DataFrame) -> DataFrame:
    """One row per day and user with calls, outcomes, mutations and the favourite tool."""
    facts = parts.groupBy("date", "user_id", "kind", "value").agg(
        F.sum("rows").alias("rows"), F.sum("successes").alias("successes"), F.max("committed").alias("committed")
    ).filter("rows != 0")
    kind, value, rows = F.col("kind"), F.col("value"), F.col("rows")
    tool = kind == "tool"

    def total(keep: Column, what: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, what)), F.lit(0))

    def operation(name: str) -> Column:
        return (kind == "operation") & (value == name)

    calls_made, calls_good = total(tool, rows), total(tool, F.col("successes"))
    stats = facts.groupBy("date", "user_id").agg(
        calls_made.alias("total_tool_calls"),
        calls_good.alias("successful_calls"),
        (calls_made - calls_good).alias("failed_calls"),
        total(operation("add"), rows).alias("watchlist_additions"),
        total(operation("remove"), rows).alias("watchlist_removals"),
        F.count(F.when(kind == "ticker", value)).alias("unique_tickers_viewed"),
        F.min_by(F.when(tool, value), F.when(tool, F.struct(-rows, value))).alias("most_used_tool"),
        F.max("committed").alias("last_updated"),
    )
    return stats.select(*[F.col(f.name).cast(f.dataType) for f in DAILY_USAGE_STATS])


def daily_usage_stats(calls: DataFrame, mutations: DataFrame) -> DataFrame:
    """One row per day and user, from whole feeds."""
    return stats_of_parts(usage_parts(calls, mutations))


# Distinct counts that can be united ---------------------------------------------------------

# Binary logarithm of the registers of a sketch; the relative error is about 1.04 / sqrt(2^n).
SKETCH_REGISTERS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_REGISTERS / 2)


def distinct_parts(calls: DataFrame) -> DataFrame:
    """Sketches of the users, of the tickers, and of the pairs of both, per day of some commits.

    A sketch has a fixed size whatever it counts, and sketches of days, users or commits unite to
    that of all of them. Counted over what was written; a sketch cannot take back.
    """
    seen = _weighed(calls, WRITTEN_CALLS)
    pair = F.when(F.col("ticker").isNotNull(), F.concat_ws("\x01", "user_id", "ticker"))
    sketch = [
        F.hll_sketch_agg(value, F.lit(SKETCH_REGISTERS)).alias(name)
        for name, value in (("users", F.col("user_id")), ("tickers", F.col("ticker")), ("pairs", pair))
    ]
    return seen.groupBy(F.to_date("timestamp").alias("date")).agg(*sketch)


def distinct_of_parts(parts: DataFrame, *keys: str | Column) -> DataFrame:
    """Estimated distinct users, tickers and pairs per key, from united sketches."""
    names = ("users", "tickers", "pairs")
    united = parts.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in names])
    kept = [c for c in united.columns if c not in names]
    return united.select(*kept, *[F.hll_sketch_estimate(c).alias(c) for c in names])


def usage_last_days(stats: DataFrame, as_of: date, days: int = DASHBOARD_DAYS) -> DataFrame:
    """Totals per day for the last days, newest first."""
    return (
        stats.filter(F.col("date") >= F.date_sub(F.lit(as_of), days))
        .groupBy("date")
        .agg(
            F.sum("total_tool_calls").alias("total_calls"),
            F.sum("successful_calls").alias("successful"),
            F.sum("failed_calls").alias("failed"),
        )
        .orderBy(F.desc("date"))
    )


def high_water_mark(stats: DataFrame, start: Moment | None = None) -> str | None:
    """Commit time up to which the rollup is filled, or `start` while it is empty.

    Given as text in the session's time zone. It says how fresh the rollup is; which commits
    a run takes is decided by the versions noted per feed.
    """
    fallback = F.lit(None) if start is None else moment(start)
    return stats.agg(F.coalesce(F.max("last_updated"), fallback).cast("string").alias("mark")).first()["mark"]
