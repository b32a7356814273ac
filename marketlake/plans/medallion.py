"""The ETL job: landed records to bronze, silver and embedded corpus tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.vectors import Encoder
from marketlake.operators import corpus as documents
from marketlake.operators import embed, silver, stored_index
from marketlake.operators.keys import listed
from marketlake.schemas import FAILURES, FEED_COLUMNS, INDEX, SILVER_COMPANIES, SILVER_NEWS
from marketlake.session import materialize
from marketlake.sources import landing, tables


@dataclass(frozen=True)
class Landed:
    prices: DataFrame
    companies: DataFrame
    news: DataFrame


def run_medallion(
    spark: SparkSession,
    database: str,
    landed: Landed,
    as_of: datetime,
    tickers: Sequence[str] | None = None,
    price_order: Sequence[str] = (),
    company_order: Sequence[str] = (),
    price_days: int | None = None,
    articles: int | None = None,
) -> dict[str, int]:
    """Write bronze and silver tables, a report and the records that did not parse; returns
    the rows written to each.

    All landed rows are taken, unless `price_days` or `articles` per ticker limit them.
    """
    tables.create_database(spark, database)
    bronze = {
        "bronze_prices": landing.bronze_prices(landed.prices, as_of.date(), price_days, tickers),
        "bronze_companies": landing.bronze_companies(landed.companies, tickers),
        "bronze_news": landing.bronze_news(landed.news, articles, tickers),
    }
    written = _report(spark, database, landed, tickers)
    for table, rows in bronze.items():
        if rows.take(1):  # whole row: text formats cannot be asked for the corrupt column alone
            written[table] = tables.overwrite(rows, f"{database}.{table}")
    transforms = {
        "silver_prices": ("bronze_prices", lambda df: silver.clean_prices(df, price_order)),
        "silver_companies": ("bronze_companies", lambda df: silver.clean_companies(df, as_of, company_order)),
        "silver_news": ("bronze_news", lambda df: silver.clean_news(df, as_of)),
    }
    for table, (source, transform) in transforms.items():
        if spark.catalog.tableExists(f"{database}.{source}"):
            written[table] = tables.overwrite(transform(spark.table(f"{database}.{source}")), f"{database}.{table}")
    return written


def _report(
    spark: SparkSession, database: str, landed: Landed, tickers: Sequence[str] | None
) -> dict[str, int]:
    """Table `quarantine` with raw records, and `ingest_report` with rows per source and ticker;
    there, broken records count under no ticker."""
    sources = {"prices": landed.prices, "companies": landed.companies, "news": landed.news}
    quarantine = _union([landing.quarantined(rows, source) for source, rows in sources.items()])
    written = {"quarantine": tables.overwrite(quarantine, f"{database}.quarantine")}
    reports = []
    for source, rows in sources.items():
        good = landing.parsed(rows).withColumn("ticker", F.upper("ticker"))
        asked = listed(spark, tickers) if tickers is not None else good.select("ticker").distinct()
        reports.append(landing.ingest_report(asked, good, source))
    broken = spark.table(f"{database}.quarantine").groupBy("source").agg(F.count("*").alias("rows"))
    reports.append(broken.select("source", F.lit(None).cast("string").alias("ticker"), "rows", F.lit("corrupt").alias("status")))
    written["ingest_report"] = tables.overwrite(_union(reports), f"{database}.ingest_report")
    return written


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_embedding(
    spark: SparkSession,
    database: str,
    path: str,
    encoder: Encoder = embed.DEFAULT_ENCODER,
    dim: int = embed.DEFAULT_ENCODER.dim,
    max_chars: int | None = None,
) -> int:
    """Bring the index below `path` up to date with the silver tables; returns its rows.

    Only documents that are new, changed, or failed before are embedded. The index becomes a
    new version of its table, which readers see when it is complete.
    """
    corpus = documents.text_corpus(
        tables.read_or_empty(spark, f"{database}.silver_news", SILVER_NEWS),
        tables.read_or_empty(spark, f"{database}.silver_companies", SILVER_COMPANIES),
    )
    return refresh_index(corpus, path, encoder, dim, max_chars)


def refresh_index(
    corpus: DataFrame,
    path: str,
    encoder: Encoder = embed.DEFAULT_ENCODER,
    dim: int = embed.DEFAULT_ENCODER.dim,
    max_chars: int | None = None,
) -> int:
    """The index below `path` brought up to a corpus; returns its rows.

    Texts on which the encoder failed are noted beside it, and tried again by `MOST_TRIES` runs.
    """
    spark = corpus.sparkSession
    index, failures = tables.read_version(spark, path, INDEX), read_failures(spark, path)
    fresh = embed.embed_incremental(corpus, index, encoder, dim, max_chars, embed.given_up(failures))
    fresh = materialize(fresh, "fresh-documents")
    written = tables.write_version(embed.laid_out(embed.merge_index(index, fresh, corpus)), path)
    noted = materialize(embed.merge_failures(failures, fresh).select(FAILURES.names), "failures")
    if not noted.isEmpty() or not failures.isEmpty():
        tables.write_version(noted, _failures(path))
    return written


def _failures(path: str) -> str:
    return f"{path}/_failures"


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """Texts of the index below `path` on which the encoder failed, with error and tries."""
    return tables.read_version(spark, _failures(path), FAILURES)


def feed_index(
    spark: SparkSession,
    path: str,
    feed: DataFrame,
    encoder: Encoder = embed.DEFAULT_ENCODER,
    dim: int = embed.DEFAULT_ENCODER.dim,
    clusters: int | None = None,
    max_chars: int | None = None,
) -> stored_index.StoredIndex:
    """The stored index below `path` after the commits of a corpus feed that it has not taken up.

    Without an index, one is built from the feed. What is read are new commits, what is written
    their documents; centres and everything else stay.
    """

    def encode(documents: DataFrame) -> DataFrame:
        return embed.embedded(documents, encoder, dim, max_chars)

    if stored_index.exists(spark, path):
        return stored_index.apply_feed(spark, stored_index.open_index(spark, path), feed, encode)
    newest = feed.agg(F.max("_commit_version")).first()[0] or 0
    changes = stored_index.net_changes(feed.filter(F.col("_commit_version") <= newest), -1)
    present = changes.filter("_current").drop("_current", *FEED_COLUMNS.names)
    return stored_index.build(materialize(encode(present), "embedded"), path, dim, clusters, newest)
