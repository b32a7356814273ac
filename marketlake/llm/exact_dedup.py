"""Exact duplicates, with the frequent digests taken out by a broadcast of their winners.

A Misra-Gries summary of the digests (Spark's `freqItems`) names at most 1/support
candidates. Their groups are counted exactly; those that do hold `support` of all rows are
settled by a broadcast of at most 1/support winners, where the rows lie. No other digest can
hold more than that share, so the rest goes through an ordinary shuffle. Only ids and digests
move; texts stay in place.

Equal means identical text; null counts as empty. The row with the largest doc_id stays, a
null id being the smallest. Rows that repeat both id and text stay once. An empty table gives
an empty result. Columns other than `doc_id` and `text` may have any name.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.keys import attach
from marketlake.session import materialize

# A digest is frequent when it holds this share of all rows.
SUPPORT = 0.001
GROUP_BYTES = 128


class Groups(NamedTuple):
    """Groups of two rows or more: digest, keep_id, keep_row, group_size, same (rows with keep_id)."""

    frequent: DataFrame
    rest: DataFrame


def digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def digest_table(docs: DataFrame) -> DataFrame:
    """doc_id, digest and a row number, written once: later steps see the same numbers."""
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


def duplicate_groups(digests: DataFrame, support: float = SUPPORT) -> Groups:
    spark = digests.sparkSession
    # The summary compares values: a binary column would count every row as a value of its own.
    candidates = sorted(set(digests.stat.freqItems(["digest"], support).first()[0] or []))
    named = spark.createDataFrame([(d,) for d in candidates], "digest string")
    share = digests.count() * support
    verified = _winners(digests.join(F.broadcast(named), "digest")).filter(F.col("group_size") >= share)
    frequent = materialize(verified, "frequent-digests")
    rest = _winners(digests.join(F.broadcast(frequent), "digest", "left_anti"))
    return Groups(frequent, materialize(rest, "digest-groups"))


def _winners(digests: DataFrame) -> DataFrame:
    """The row that stays in each group of several rows, found with partial aggregates."""
    per_id = digests.groupBy("digest", "doc_id").agg(F.max("row").alias("row"), F.count("*").alias("same"))
    best = F.max(F.struct("doc_id", "row", "same")).alias("best")
    groups = per_id.groupBy("digest").agg(best, F.sum("same").alias("group_size"))
    return groups.filter(F.col("group_size") > 1).select(
        "digest",
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.row").alias("keep_row"),
        "group_size",
        F.col("best.same").alias("same"),
    )


def decisions(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest."""
    digests = digest_table(docs)
    groups = duplicate_groups(digests, support)
    settled = digests.join(F.broadcast(groups.frequent), "digest")
    others = digests.join(F.broadcast(groups.frequent), "digest", "left_anti")
    alone = F.col("group_size").isNull()
    return settled.unionByName(others.join(groups.rest, "digest", "left")).select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "digest",
    )


def deduplicated(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The documents that stay, with all their columns."""
    groups = duplicate_groups(digest_table(docs), support)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), digest(docs["text"]).alias("digest")
    )

    def column(name: str) -> Column:
        return F.col("_doc").getField(name)

    named = rows.join(F.broadcast(groups.frequent.withColumn("_frequent", F.lit(True))), "digest", "left")
    settled = named.filter("_frequent").drop("_frequent")
    others = attach(
        named.filter("_frequent is null").select("digest", "_doc"),
        groups.rest,
        ["digest"],
        spread=["_doc.doc_id"],
        row_bytes=GROUP_BYTES,
        how="left",
    )
    both = settled.unionByName(others)
    winner = F.col("group_size").isNull() | column("doc_id").eqNullSafe(F.col("keep_id"))
    stay = both.filter(winner)
    # Rows that repeat id and text are as many as their table says; one of them stays.
    repeated = F.coalesce(F.col("same") > 1, F.lit(False))
    once = stay.filter(repeated).withColumn("_id", column("doc_id")).dropDuplicates(["digest", "_id"])
    kept = stay.filter(~repeated).select("_doc").unionByName(once.select("_doc"))
    return kept.select(*[column(c).alias(c) for c in docs.columns])
