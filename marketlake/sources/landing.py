"""Landed provider records: reading, defaults, limits, and a report per ticker."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.keys import first_per_key, listed

# Look-back, article count and defaults of missing fields.
PRICE_DAYS = 365
ARTICLES = 50
UNKNOWN = "Unknown"
CURRENCY = "USD"
NEWS_SOURCE = "Yahoo Finance"

CORRUPT = "_corrupt_record"


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", **options) -> DataFrame:
    """Landed files with a declared schema.

    Records that do not parse are kept, with their raw form, in the corrupt-record column
    of text formats, so one bad record never stops a load.
    """
    if fmt in ("json", "csv"):
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def _whole(landed: DataFrame) -> Column:
    """True, from all fields: a text format judges a record by the fields it is asked for."""
    fields = [c for c in landed.columns if c != CORRUPT]
    return F.xxhash64(*fields) >= F.lit(-(2**63))


def parsed(landed: DataFrame) -> DataFrame:
    if CORRUPT not in landed.columns:
        return landed
    return landed.filter(F.col(CORRUPT).isNull() & _whole(landed)).drop(CORRUPT)


def quarantined(landed: DataFrame, source: str) -> DataFrame:
    """Records that did not parse, in their raw form."""
    if CORRUPT not in landed.columns:
        return landed.limit(0).select(F.lit(source).alias("source"), F.lit(None).cast("string").alias("record"))
    broken = landed.filter(F.col(CORRUPT).isNotNull() & _whole(landed))
    return broken.select(F.lit(source).alias("source"), F.col(CORRUPT).alias("record"))


def _wanted(df: DataFrame, tickers: Sequence[str] | None) -> DataFrame:
    """Rows of the listed tickers, however either is spelled."""
    if tickers is None:
        return df
    wanted = listed(df.sparkSession, tickers).select(F.col("ticker").alias("_wanted"))
    return df.join(wanted, F.upper("ticker") == F.col("_wanted"), "left_semi")


def bronze_prices(
    landed: DataFrame, as_of: date, days_back: int | None = PRICE_DAYS, tickers: Sequence[str] | None = None
) -> DataFrame:
    """Daily bars of the days before `as_of`; without `days_back`, all of them.

    Dates are ISO strings, so the bounds are compared as text and reach the file scan.
    """
    bars = parsed(landed).filter(F.col("date") < F.lit(as_of.isoformat()))
    if days_back is not None:
        start = F.date_format(F.date_sub(F.lit(as_of), days_back), "yyyy-MM-dd")
        bars = bars.filter(F.col("date") >= start)
    return _wanted(bars, tickers)


def _default(name: str, value) -> Column:
    return F.coalesce(name, F.lit(value)).alias(name)


def bronze_companies(landed: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    """Profiles with defaults for missing fields; further landed columns pass through."""
    rows = _wanted(parsed(landed), tickers)
    filled = [
        "ticker",
        F.coalesce("name", "ticker").alias("name"),
        _default("sector", UNKNOWN),
        _default("industry", UNKNOWN),
        _default("marketCap", 0),
        _default("description", ""),
        _default("website", ""),
        _default("employees", 0),
        _default("country", ""),
        _default("currency", CURRENCY),
    ]
    named = {"ticker", "name", "sector", "industry", "marketCap", "description", "website",
             "employees", "country", "currency"}
    return rows.select(*filled, *[c for c in rows.columns if c not in named])


def bronze_news(landed: DataFrame, limit: int | None = ARTICLES, tickers: Sequence[str] | None = None) -> DataFrame:
    """Articles with defaults for missing fields; a missing text repeats the title.

    With a `limit` only the newest articles per ticker are kept.
    """
    filled = _wanted(parsed(landed), tickers).select(
        "ticker",
        _default("title", ""),
        _default("source", NEWS_SOURCE),
        _default("publishedAt", 0),
        _default("url", ""),
        F.coalesce("summary", "title", F.lit("")).alias("summary"),
        F.coalesce("content", "title", F.lit("")).alias("content"),
    )
    if limit is None:
        return filled
    newest = [F.desc("publishedAt"), F.asc("url"), F.asc("title")]
    return first_per_key(filled, ["ticker"], newest, limit)


def ingest_report(requested: DataFrame, landed: DataFrame, source: str) -> DataFrame:
    """Rows landed per requested ticker; a ticker without rows is reported as missing."""
    rows = landed.groupBy("ticker").agg(F.count("*").alias("rows"))
    return requested.select("ticker").join(rows, "ticker", "left").select(
        F.lit(source).alias("source"),
        "ticker",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.when(F.col("rows").isNull(), "missing").otherwise("ok").alias("status"),
    )
