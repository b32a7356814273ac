"""From raw documents to packed training sequences, in five stages.

Every stage works on all documents its predecessor kept, and its result is written and read
again before the next one starts. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import exact_dedup, langid, mixing, ngram_join, packing
from marketlake.llm.catalog import tokenizer_file
from marketlake.session import materialize, prepare

# Near-duplicates share this percentage of their shingles of so many words; op9 has its own.
SHINGLE_WORDS = 5
NEAR_THRESHOLD = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language prevails; those without letters or language go."""
    prepare(spark)
    return langid.accepted(docs, langid.fit(langid.sample(docs, F.lit(True))))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    prepare(spark)
    return exact_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    prepare(spark)
    return ngram_join.representatives(docs, n=SHINGLE_WORDS, threshold=NEAR_THRESHOLD)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in training order."""
    prepare(spark)
    return mixing.mixture(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    prepare(spark)
    found = packing.packed(docs, tokenizer_file("word_bpe_49k.json"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact duplicates", exact_duplicates),
    ("near duplicates", near_duplicates),
    ("mixture", mixture),
    ("sequences", sequences),
]

# Language spans, near-duplicate components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *filters, (last, pack) = STAGES
    for name, stage in filters:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return pack(spark, docs, sf_dir)
