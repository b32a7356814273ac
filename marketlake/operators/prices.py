"""Price analytics per ticker: quotes, ranges, summaries, comparison, fundamentals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.text import clip, ticker_of
from marketlake.operators.keys import first_per_key, global_position, listed

# Look-back months for a number of days, and shown lengths and texts.
SHORT_DAYS, SHORT_MONTHS = 30, 1
MIDDLE_DAYS, MIDDLE_MONTHS = 90, 3
LONG_MONTHS = 6
DESCRIPTION_LENGTH = 500
NOT_AVAILABLE = "N/A"
NO_DESCRIPTION = "No description available"


def summary_months(days: int) -> int:
    if days <= SHORT_DAYS:
        return SHORT_MONTHS
    return MIDDLE_MONTHS if days <= MIDDLE_DAYS else LONG_MONTHS


def comparison_months(days: int) -> int:
    return SHORT_MONTHS if days <= SHORT_DAYS else MIDDLE_MONTHS


def back_to(as_of: date, months: int) -> Column:
    return F.add_months(F.lit(as_of), -months)


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def percent(change: Column, base: Column) -> Column:
    return F.round(F.try_divide(change * 100, base), 4)


def bars_between(bars: DataFrame, start: date | Column, end: date | Column) -> DataFrame:
    """Bars from `start` up to, but not including, `end`."""
    day = F.col("snapshot_date")
    return bars.filter((day >= start) & (day < end))


def price_history(bars: DataFrame, start: date, end: date, ticker: str | None = None) -> DataFrame:
    """Daily bars of a date range in date order, for one ticker or all."""
    chosen = bars if ticker is None else bars.filter(F.col("ticker") == ticker_of(F.lit(ticker)))
    return (
        bars_between(chosen, start, end)
        .select(
            "ticker",
            F.col("snapshot_date").alias("date"),
            *[_double(f"{f}_price").alias(f) for f in ("open", "high", "low", "close")],
            "volume",
        )
        .orderBy("ticker", "date")
    )


def _newest_two(bars: DataFrame) -> DataFrame:
    """Newest bar per ticker with the close of the bar before it."""
    newest = first_per_key(bars, ["ticker"], [F.desc("snapshot_date")], limit=2)
    return newest.groupBy("ticker").agg(
        F.max("snapshot_date").alias("price_date"),
        *[F.max_by(c, "snapshot_date").alias(c) for c in ("close_price", "high_price", "low_price", "volume")],
        F.when(F.count("*") == 2, F.min_by("close_price", "snapshot_date")).alias("previous_close"),
    )


def _with_change(quotes: DataFrame) -> DataFrame:
    """Change against the previous close; 0 where it cannot be computed."""
    price, previous = F.col("price"), F.col("previous_close")
    known = price.isNotNull() & previous.isNotNull() & (previous != 0)
    return quotes.withColumn(
        "change", F.when(known, F.round(price - previous, 4)).otherwise(F.lit(0.0))
    ).withColumn("change_pct", F.when(known, percent(price - previous, previous)).otherwise(F.lit(0.0)))


def price_quote(bars: DataFrame, companies: DataFrame) -> DataFrame:
    """Current price, change and volume per ticker, with name and market value."""
    facts = companies.select("ticker", "company_name", "market_cap")
    quotes = _newest_two(bars).select(
        "ticker",
        "price_date",
        _double("close_price").alias("price"),
        _double("previous_close").alias("previous_close"),
        F.coalesce("volume", F.lit(0)).alias("volume"),
    )
    return (
        _with_change(quotes)
        .join(facts, "ticker", "left")
        .select(
            "ticker",
            F.coalesce("company_name", "ticker").alias("name"),
            "price_date",
            "price",
            "previous_close",
            "change",
            "change_pct",
            "volume",
            F.coalesce("market_cap", F.lit(0)).alias("market_cap"),
        )
    )


def dashboard_quote(bars: DataFrame, companies: DataFrame) -> DataFrame:
    """Quote panel per ticker; every missing figure is 0."""
    facts = companies.select("ticker", "market_cap")
    quotes = _newest_two(bars).select(
        "ticker",
        _double("close_price").alias("price"),
        _double("previous_close").alias("previous_close"),
        "volume",
        _double("high_price").alias("day_high"),
        _double("low_price").alias("day_low"),
    )
    figures = ("price", "change", "change_pct", "volume", "day_high", "day_low", "market_cap")
    return (
        _with_change(quotes)
        .join(facts, "ticker", "left")
        .select("ticker", *[F.coalesce(c, F.lit(0)).alias(c) for c in figures])
    )


def quote_from_snapshot(snapshot: DataFrame) -> DataFrame:
    """Quote from a landed provider snapshot; provider changes win over computed ones."""
    quotes = snapshot.select(
        "ticker",
        F.coalesce("longName", "ticker").alias("name"),
        F.coalesce("currentPrice", "regularMarketPrice").alias("price"),
        F.col("previousClose").alias("previous_close"),
        "regularMarketChange",
        "regularMarketChangePercent",
        F.coalesce("volume", F.lit(0)).alias("volume"),
        F.coalesce("dayHigh", F.lit(0.0)).alias("day_high"),
        F.coalesce("dayLow", F.lit(0.0)).alias("day_low"),
        F.coalesce("marketCap", F.lit(0)).alias("market_cap"),
    )
    return (
        _with_change(quotes)
        .withColumn("change", F.coalesce("regularMarketChange", "change"))
        .withColumn("change_pct", F.coalesce("regularMarketChangePercent", "change_pct"))
        .drop("regularMarketChange", "regularMarketChangePercent")
    )


def price_period_summary(bars: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """First and last close, change, extremes and mean volume over the look-back months."""
    day = F.col("snapshot_date")
    window = bars.filter((day >= back_to(as_of, summary_months(days))) & (day <= F.lit(as_of)))
    summary = window.groupBy("ticker").agg(
        F.min("snapshot_date").alias("from_date"),
        F.max("snapshot_date").alias("to_date"),
        F.count("*").alias("bars"),
        F.min_by("close_price", "snapshot_date").cast("double").alias("start_price"),
        F.max_by("close_price", "snapshot_date").cast("double").alias("end_price"),
        F.max("high_price").cast("double").alias("high"),
        F.min("low_price").cast("double").alias("low"),
        F.round(F.avg("volume"), 4).alias("avg_volume"),
    )
    start, end = F.col("start_price"), F.col("end_price")
    return summary.withColumn("change_pct", percent(end - start, start))


def compare_tickers(
    bars: DataFrame,
    companies: DataFrame,
    as_of: date,
    days: int = 30,
    tickers: Sequence[str] | None = None,
) -> DataFrame:
    """Tickers by change over the look-back months, best first.

    Equal changes keep the order of the request (by ticker when all are compared); tickers
    without bars are left out. The request is a table, whatever its length.
    """
    day = F.col("snapshot_date")
    window = bars.filter((day >= back_to(as_of, comparison_months(days))) & (day <= F.lit(as_of)))
    wanted = None
    if tickers is not None:
        wanted = listed(bars.sparkSession, tickers)
        if len(set(t.upper() for t in tickers)) < 2:
            raise ValueError("compare at least 2 tickers")
        window = window.join(wanted, "ticker", "left_semi")
    changes = window.groupBy("ticker").agg(
        F.min_by("close_price", "snapshot_date").cast("double").alias("_first"),
        F.max_by("close_price", "snapshot_date").cast("double").alias("price"),
    )
    facts = companies.select("ticker", "market_cap")
    compared = changes.join(facts, "ticker", "left").select(
        "ticker",
        "price",
        percent(F.col("price") - F.col("_first"), F.col("_first")).alias("change_pct"),
        F.coalesce("market_cap", F.lit(0)).alias("market_cap"),
    )
    asked = compared.withColumn("asked", F.lit(0)) if wanted is None else compared.join(wanted, "ticker")
    ranked = global_position(asked, [F.desc_nulls_last("change_pct"), F.col("asked"), F.col("ticker")], "rank")
    return ranked.select("rank", "ticker", "price", "change_pct", "market_cap").orderBy("rank")


def company_fundamentals(profiles: DataFrame, bars: DataFrame, as_of: date) -> DataFrame:
    """Profile and market figures per ticker, with the extremes of the last 52 weeks.

    `profiles` holds one landed profile per ticker. Ratios that were not landed are null.
    """
    day = F.col("snapshot_date")
    year = bars.filter((day >= F.date_sub(F.lit(as_of), 364)) & (day <= F.lit(as_of)))
    extremes = year.groupBy("ticker").agg(
        F.max("high_price").cast("double").alias("high_52_weeks"),
        F.min("low_price").cast("double").alias("low_52_weeks"),
    )

    def ratio(name: str) -> Column:
        return F.col(name) if name in profiles.columns else F.lit(None).cast("double")

    return profiles.join(extremes, "ticker", "left").select(
        "ticker",
        F.coalesce("name", "ticker").alias("name"),
        F.coalesce("sector", F.lit(NOT_AVAILABLE)).alias("sector"),
        F.coalesce("industry", F.lit(NOT_AVAILABLE)).alias("industry"),
        "employees",
        F.coalesce("marketCap", F.lit(0)).alias("market_cap"),
        ratio("trailingPE").alias("trailing_pe"),
        ratio("forwardPE").alias("forward_pe"),
        F.round(F.coalesce(ratio("dividendYield"), F.lit(0.0)) * 100, 4).alias("dividend_yield_pct"),
        "high_52_weeks",
        "low_52_weeks",
        clip(F.coalesce("description", F.lit(NO_DESCRIPTION)), DESCRIPTION_LENGTH).alias("description"),
    )
