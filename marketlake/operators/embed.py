"""Embedding of the corpus, whole or incremental."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.text import clip
from marketlake.functions.vectors import NOT_TRIED, Encoder, HashingEncoder, encode_column
from marketlake.operators.corpus import unique_documents, with_text_hash
from marketlake.operators.keys import marked_rows
from marketlake.session import materialize

# Fixed value: input limit of the hosted model, in characters. The hashing encoder has no
# limit and reads whole texts; pass `max_chars=MODEL_INPUT_LENGTH` for a model that has.
MODEL_INPUT_LENGTH = 8000

DEFAULT_ENCODER = HashingEncoder()


def embed(
    df: DataFrame,
    encoder: Encoder = DEFAULT_ENCODER,
    dim: int = DEFAULT_ENCODER.dim,
    *,
    text: str = "text",
    output: str = "embedding",
    max_chars: int | None = None,
) -> DataFrame:
    """Add a vector per row. Only the text column travels to the Python workers."""
    return _encoded(df, encoder, dim, text, max_chars).withColumn(output, F.col("_encoded.embedding")).drop("_encoded")


def _encoded(df: DataFrame, encoder: Encoder, dim: int, text: str, max_chars: int | None) -> DataFrame:
    source = F.col(text) if max_chars is None else clip(F.col(text), max_chars)
    return df.withColumn("_encoded", encode_column(source, encoder, dim))


# A partition that holds so many times its share of the rows is one that others wait for.
UNEVEN = 2


def balanced(documents: DataFrame) -> DataFrame:
    """The documents, dealt anew if the layout of their files leaves most to a few tasks.

    Rows per partition are counted without reading a column. Where every core has its share,
    as with many splits, nothing moves.
    """
    cores = documents.sparkSession.sparkContext.defaultParallelism
    sizes = documents.select(F.spark_partition_id().alias("part")).groupBy("part").agg(F.count("*").alias("rows"))
    found = sizes.agg(F.max("rows").alias("most"), F.sum("rows").alias("rows"), F.count("*").alias("parts")).first()
    if not found["rows"] or found["most"] <= UNEVEN * found["rows"] / max(cores, found["parts"]) or found["rows"] < cores:
        return documents
    return documents.repartition(max(2 * cores, found["parts"]))


def embedded(
    documents: DataFrame, encoder: Encoder, dim: int, max_chars: int | None = None
) -> DataFrame:
    """Documents with a vector; `embed_ok` is false where it is zero, `embed_error` says why if the
    encoder failed on the text."""
    vectors = _encoded(balanced(documents), encoder, dim, "text", max_chars)
    vectors = vectors.select("*", "_encoded.embedding", F.col("_encoded.error").alias("embed_error")).drop("_encoded")
    return vectors.withColumn("embed_ok", F.exists("embedding", lambda x: x != 0))


# Runs in which a text may fail before it is left alone until it changes.
MOST_TRIES = 3


def given_up(failures: DataFrame) -> DataFrame:
    """Texts (doc_id, text_hash) that have failed too often."""
    return failures.filter(F.col("tries") >= MOST_TRIES).select("doc_id", "text_hash")


def merge_failures(failures: DataFrame, fresh: DataFrame) -> DataFrame:
    """Failures (doc_id, text_hash, error, tries) after a run: those of texts that were tried
    again are replaced. A text that was not tried has not failed once more."""
    tried = fresh.select("doc_id", "text_hash", "embed_error")
    before = failures.select("doc_id", "text_hash", F.col("tries").alias("_before"))
    counted = F.coalesce("_before", F.lit(0)) + F.when(F.col("embed_error") == NOT_TRIED, 0).otherwise(1)
    again = tried.filter("embed_error is not null").join(before, ["doc_id", "text_hash"], "left").select(
        "doc_id", "text_hash", F.col("embed_error").alias("error"), counted.cast("int").alias("tries")
    )
    return failures.join(tried.select("doc_id"), "doc_id", "left_anti").unionByName(again)


def embed_corpus(
    corpus: DataFrame,
    encoder: Encoder = DEFAULT_ENCODER,
    dim: int = DEFAULT_ENCODER.dim,
    max_chars: int | None = None,
) -> DataFrame:
    """One embedded document per id."""
    return embedded(unique_documents(with_text_hash(corpus)), encoder, dim, max_chars)


def laid_out(index: DataFrame) -> DataFrame:
    """Rows of each file in filter order, so that a search by type or ticker skips row groups."""
    return index.sortWithinPartitions("doc_type", "ticker", "doc_id")


FACTS = ("doc_type", "ticker", "title", "metadata_date", "metadata_source")


def _newest(corpus: DataFrame) -> DataFrame:
    """Facts and text hash of the newest version of every document, without the texts."""
    return unique_documents(with_text_hash(corpus).drop("text"))


def _usable(index: DataFrame) -> DataFrame:
    """What need not be embedded again: the vector is there, or there is no text."""
    return index.filter(F.col("embed_ok") | F.coalesce(F.col("text") == "", F.lit(True)))


def documents_to_embed(corpus: DataFrame, index: DataFrame, left_alone: DataFrame | None = None) -> DataFrame:
    """Documents of a new corpus that the index lacks, holds with another text, or failed to
    embed, but for texts (doc_id, text_hash) to be left alone.

    They are found without the texts; where changed or unchanged documents are few, only texts of
    repeated ids ever move (`marked_rows`).
    """
    known = _usable(index).select("doc_id", "text_hash")
    if left_alone is not None:
        known = known.unionByName(left_alone.select("doc_id", "text_hash"))
    newest = _newest(corpus).select("doc_id", F.coalesce("text_hash", F.lit("")).alias("text_hash"))
    known = known.withColumns({"text_hash": F.coalesce("text_hash", F.lit("")), "_known": F.lit(True)}).distinct()
    marks = newest.join(known, ["doc_id", "text_hash"], "left")
    marks = marks.select("doc_id", (F.col("_known").isNull() & F.col("doc_id").isNotNull()).alias("marked"))
    return unique_documents(with_text_hash(marked_rows(corpus, marks, "doc_id")))


def embed_incremental(
    corpus: DataFrame,
    index: DataFrame,
    encoder: Encoder = DEFAULT_ENCODER,
    dim: int = DEFAULT_ENCODER.dim,
    max_chars: int | None = None,
    left_alone: DataFrame | None = None,
) -> DataFrame:
    """Embed only what changed since the index was written, or failed then."""
    return embedded(documents_to_embed(corpus, index, left_alone), encoder, dim, max_chars)


def merge_index(index: DataFrame, fresh: DataFrame, corpus: DataFrame) -> DataFrame:
    """The index after a refresh: fresh documents in, vanished ones gone, all facts current.

    Rows that change are found without texts and vectors; the others stay where they are. `fresh`
    is read several times.
    """
    facts = _newest(corpus).select("doc_id", F.struct(*FACTS).alias("_facts"))
    held = index.select("doc_id", F.struct(*FACTS).alias("_held"))
    moved = held.join(facts, "doc_id", "left").filter(~F.col("_held").eqNullSafe(F.col("_facts")))
    moved = moved.select("doc_id", "_facts").join(fresh.select("doc_id"), "doc_id", "left_anti")
    moved = materialize(moved, "moved-documents")
    gone = moved.select("doc_id").unionByName(fresh.select("doc_id"))
    gone = gone.withColumn("_gone", F.lit(True)).distinct()
    marks = index.select("doc_id").join(gone, "doc_id", "left").select("doc_id", F.col("_gone").isNull().alias("marked"))
    kept = marked_rows(index, marks, "doc_id")
    told = index.drop(*FACTS).join(moved.filter("_facts is not null"), "doc_id").select("*", "_facts.*")
    return kept.unionByName(told.select(kept.columns)).unionByName(fresh.select(kept.columns))
