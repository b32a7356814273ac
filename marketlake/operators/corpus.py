"""Documents for search, built from silver news and company profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.keys import first_per_key
from marketlake.session import materialize

# Document types, labels and templates of the corpus.
NEWS = "news"
NEWS_ARTICLE = "news_article"
COMPANY_PROFILE = "company_profile"
PROFILE_SOURCE = "Company Profile"
ID_SEPARATOR = " | "
PART_SEPARATOR = "\n\n"
SECTOR_LABEL = "Sector: "
INDUSTRY_LABEL = "Industry: "
PROFILE_DATE = "2024-01-01"


def news_documents(news: DataFrame) -> DataFrame:
    return news.select(
        F.concat_ws(ID_SEPARATOR, "ticker", "title").alias("doc_id"),
        F.lit(NEWS).alias("doc_type"),
        "ticker",
        "title",
        F.concat_ws(PART_SEPARATOR, "title", "summary", "full_text").alias("text"),
        F.col("published_at").cast("string").alias("metadata_date"),
        F.col("source").alias("metadata_source"),
    )


def company_documents(companies: DataFrame) -> DataFrame:
    return companies.select(
        F.col("ticker").alias("doc_id"),
        F.lit(COMPANY_PROFILE).alias("doc_type"),
        "ticker",
        F.col("company_name").alias("title"),
        F.concat_ws(
            PART_SEPARATOR,
            F.col("company_name"),
            F.concat(F.lit(SECTOR_LABEL), "sector"),
            F.concat(F.lit(INDUSTRY_LABEL), "industry"),
            F.col("company_description"),
        ).alias("text"),
        F.col("updated_at").cast("string").alias("metadata_date"),
        F.lit(PROFILE_SOURCE).alias("metadata_source"),
    )


def text_corpus(news: DataFrame, companies: DataFrame) -> DataFrame:
    """All documents, one per article and one per company; nothing moves between tasks."""
    return news_documents(news).unionByName(company_documents(companies))


def _sentence(*parts: Column) -> Column:
    return F.concat_ws(" ", *parts)


def sentence_corpus(news: DataFrame, companies: DataFrame) -> DataFrame:
    """The corpus in running sentences, with a plain date; missing parts drop out."""
    stop = F.lit(".")
    profiles = companies.select(
        "ticker",
        F.col("company_name").alias("title"),
        _sentence(
            F.concat("company_name", stop),
            F.concat(F.lit(SECTOR_LABEL), "sector", stop),
            F.concat(F.lit(INDUSTRY_LABEL), "industry", stop),
            F.col("company_description"),
        ).alias("text"),
        F.lit(PROFILE_DATE).alias("date"),
        F.lit(COMPANY_PROFILE).alias("doc_type"),
    )
    articles = news.select(
        "ticker",
        "title",
        _sentence(F.concat("title", stop), F.col("summary"), F.col("full_text")).alias("text"),
        F.coalesce(F.date_format("published_at", "yyyy-MM-dd"), F.lit(PROFILE_DATE)).alias("date"),
        F.lit(NEWS_ARTICLE).alias("doc_type"),
    )
    return profiles.unionByName(articles)


def with_text(corpus: DataFrame) -> DataFrame:
    """Documents that an encoder can say something about."""
    return corpus.filter(F.col("text").isNotNull() & (F.col("text") != ""))


def with_text_hash(corpus: DataFrame) -> DataFrame:
    return corpus.withColumn("text_hash", F.md5("text"))


def unique_documents(corpus: DataFrame) -> DataFrame:
    """One document per id, the newest; ties go to the greatest text hash.

    `corpus` carries `text_hash`, so versions are compared without their texts. Hashes of ids that
    occur more than once are found first and written down: eight bytes each, however long the ids,
    so they are broadcast and only rows with such a hash move. Rows without an id stay apart.
    """
    newest = [F.desc_nulls_last(c) for c in ("metadata_date", "text_hash", "metadata_source")]
    place = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).alias("_place")
    repeated = corpus.select(place).groupBy("_place").agg(F.count("*").alias("n")).filter("n > 1 and _place is not null")
    repeated = materialize(repeated.select("_place"), "repeated-ids")
    if repeated.isEmpty():
        return corpus
    placed = corpus.select("*", place)
    alone = placed.join(repeated, "_place", "left_anti").drop("_place")
    several = placed.join(repeated, "_place", "left_semi").drop("_place")
    return alone.unionByName(first_per_key(several, ["doc_id"], newest))
