"""Price summaries over any range of days, from month blocks and the days at both ends.

A block holds what a month of one ticker gives to a summary; blocks put together give the
summary of any run of months. A request over years reads its whole months from blocks and at
most two months of bars. Requests, however many, meet blocks and bars by joins on ticker and month;
neither side is broadcast, as Spark takes requests for as small as before their months are listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.prices import percent

# What a block holds, and how blocks are put together.
_FACTS = ("first_day", "first_close", "last_day", "last_close", "highest", "lowest", "volume", "bars")


def _together(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min("first_day").alias("first_day"),
        F.min_by("first_close", "first_day").alias("first_close"),
        F.max("last_day").alias("last_day"),
        F.max_by("last_close", "last_day").alias("last_close"),
        F.max("highest").alias("highest"),
        F.min("lowest").alias("lowest"),
        F.sum("volume").alias("volume"),
        F.sum("bars").alias("bars"),
    )


def _as_blocks(bars: DataFrame, *keys: Column | str) -> DataFrame:
    """Every bar as a block of one day."""
    day, close = F.col("snapshot_date"), F.col("close_price")
    return bars.select(
        *keys, day.alias("first_day"), close.alias("first_close"), day.alias("last_day"), close.alias("last_close"),
        F.col("high_price").alias("highest"), F.col("low_price").alias("lowest"), "volume", F.lit(1).cast("long").alias("bars"),
    )


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def month_blocks(bars: DataFrame) -> DataFrame:
    """One block per ticker and month of bars that are unique per ticker and day."""
    return _together(_as_blocks(bars, "ticker", month_of(F.col("snapshot_date")).alias("month")), "ticker", "month")


def refreshed_blocks(blocks: DataFrame, bars: DataFrame, changed: DataFrame) -> DataFrame:
    """Blocks after bars of some (ticker, month) changed: those are made anew, others stay."""
    months = changed.select("ticker", "month").distinct()
    keyed = bars.withColumn("month", month_of(F.col("snapshot_date")))
    anew = month_blocks(keyed.join(months, ["ticker", "month"], "left_semi").drop("month"))
    return blocks.join(months, ["ticker", "month"], "left_anti").unionByName(anew.select(blocks.columns))


def summaries(requests: DataFrame, blocks: DataFrame, bars: DataFrame) -> DataFrame:
    """One row per request (request_id, ticker, since, until) with bars in its range.

    `since` belongs to the range, `until` does not, as in a price history. Requests with empty
    ranges, null ends or unknown tickers give no row.
    """
    since, until = F.col("since"), F.col("until")
    asked = requests.select("request_id", F.upper("ticker").alias("ticker"), "since", "until").filter(since < until)
    # Whole months from the first that starts in the range to the last that ends in it.
    first = F.when(month_of(since) == since, since).otherwise(F.add_months(month_of(since), 1))
    end = month_of(until)
    asked = asked.withColumns({"_first": first, "_end": end})
    whole = asked.filter("_first < _end").withColumn(
        "month", F.explode(F.sequence(F.col("_first"), F.add_months("_end", -1), F.expr("interval 1 month")))
    )
    from_blocks = whole.select("request_id", "ticker", "month").hint("merge").join(blocks, ["ticker", "month"]).select("request_id", "ticker", *_FACTS)
    # Days before the first whole month and from the last one on; without one, the whole range.
    edges = F.array(
        F.struct(since.alias("a"), F.least("_first", until).alias("b")),
        F.struct(F.greatest(since, F.greatest("_first", "_end")).alias("a"), until.alias("b")),
    )
    parts = asked.withColumn("edge", F.explode(edges)).filter("edge.a < edge.b").distinct()
    parts = parts.select("request_id", "ticker", F.col("edge.a").alias("_a"), F.col("edge.b").alias("_b"))
    parts = parts.withColumn("month", F.explode(F.sequence(month_of(F.col("_a")), month_of(F.date_sub("_b", 1)), F.expr("interval 1 month"))))
    days = bars.withColumn("month", month_of(F.col("snapshot_date")))
    in_edges = days.join(parts.hint("merge"), ["ticker", "month"]).filter((F.col("snapshot_date") >= F.col("_a")) & (F.col("snapshot_date") < F.col("_b")))
    found = _together(from_blocks.unionByName(_as_blocks(in_edges, "request_id", "ticker")), "request_id", "ticker")
    start, end_price = F.col("first_close").cast("double"), F.col("last_close").cast("double")
    return found.select(
        "request_id",
        "ticker",
        F.col("first_day").alias("from_date"),
        F.col("last_day").alias("to_date"),
        "bars",
        start.alias("start_price"),
        end_price.alias("end_price"),
        F.col("highest").cast("double").alias("high"),
        F.col("lowest").cast("double").alias("low"),
        F.round(F.col("volume") / F.col("bars"), 4).alias("avg_volume"),
        percent(end_price - start, start).alias("change_pct"),
    )
