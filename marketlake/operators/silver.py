"""Bronze to silver: typed, renamed, deduplicated tables."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.moments import Moment, moment
from marketlake.operators.keys import first_per_key
from marketlake.schemas import PRICE


# First value that no longer fits the price type.
_PRICE_LIMIT = 10 ** (PRICE.precision - PRICE.scale)


def clean_prices(bronze: DataFrame, latest: Sequence[str] = ()) -> DataFrame:
    """One typed bar per ticker and day.

    Of several bars for a day the one with the greatest `latest` columns is kept; a usable
    close and then the bar's own values break what is still a tie, so the result never
    depends on row order. Values that do not parse or fit become null, bars without a date
    are dropped. Prices are cast after the choice, so only for bars that stay.
    """
    dated = bronze.select(
        "ticker",
        F.col("date").try_cast("date").alias("snapshot_date"),
        *("open", "close", "high", "low", "volume"),
        *latest,
    ).filter(F.col("snapshot_date").isNotNull())
    usable = F.coalesce(F.abs("close") < _PRICE_LIMIT, F.lit(False))
    values = ["close", "volume", "open", "high", "low"]
    order = [*map(F.desc_nulls_last, latest), F.desc(usable), *map(F.desc_nulls_last, values)]
    # Date first: it sorts by its binary prefix, while tickers may share theirs.
    return first_per_key(dated, ["snapshot_date", "ticker"], order).select(
        "ticker",
        "snapshot_date",
        *[F.col(f).try_cast(PRICE).alias(f"{f}_price") for f in ("open", "close", "high", "low")],
        F.col("volume").try_cast("bigint").alias("volume"),
    )


def newest_days(bronze: DataFrame, days: int) -> DataFrame:
    """Bars of each ticker's last days, repeats included: what a quote needs to see.

    Ranks are cut down inside the map tasks, so a long history is not moved.
    """
    day = F.col("date").try_cast("date")
    place = F.dense_rank().over(Window.partitionBy("ticker").orderBy(F.desc("_day")))
    dated = bronze.withColumn("_day", day).filter(F.col("_day").isNotNull())
    return dated.withColumn("_place", place).filter(F.col("_place") <= days).drop("_day", "_place")


def clean_companies(bronze: DataFrame, loaded_at: Moment, latest: Sequence[str] = ()) -> DataFrame:
    """One profile per ticker, the latest landed one."""
    typed = bronze.select(
        "ticker",
        F.col("name").alias("company_name"),
        "sector",
        "industry",
        F.col("marketCap").try_cast("bigint").alias("market_cap"),
        F.col("description").alias("company_description"),
        moment(loaded_at).alias("updated_at"),
        *latest,
    )
    values = ["market_cap", "company_name", "sector", "industry", "company_description"]
    order = [F.desc_nulls_last(c) for c in [*latest, *values]]
    return first_per_key(typed, ["ticker"], order).drop(*latest)


def clean_news(bronze: DataFrame, loaded_at: Moment) -> DataFrame:
    """Typed news; articles without a title are dropped, repeats are kept."""
    return bronze.filter(F.col("title").isNotNull()).select(
        "ticker",
        "title",
        "source",
        F.timestamp_seconds("publishedAt").alias("published_at"),
        "url",
        "summary",
        F.col("content").alias("full_text"),
        moment(loaded_at).alias("ingested_at"),
    )
