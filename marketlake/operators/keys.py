"""Keyed building blocks: latest row per key, new ids, global positions, attached lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.session import materialize

BROADCAST_BYTES = 64 << 20
SALTS = 32
# What a name of a key takes in a broadcast table.
NAME_BYTES = 64


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int = 1) -> DataFrame:
    """The first `limit` rows of each key.

    The rank filter is cut down inside each map task before the shuffle, so a key that
    holds a large share of all rows sends at most `limit` rows per task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")


def listed(spark: SparkSession, tickers: Sequence[str]) -> DataFrame:
    """A list of tickers as a table: ticker in upper case, asked (its first place)."""
    places = {ticker: place for place, ticker in reversed(list(enumerate(t.upper() for t in tickers)))}
    return spark.createDataFrame(list(places.items()), "ticker string, asked long")


def attach(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    *,
    spread: Sequence[str],
    row_bytes: int,
    how: str = "inner",
) -> DataFrame:
    """Join a large table with a lookup that is unique on `on`.

    The lookup is counted first. When it fits `BROADCAST_BYTES` it is broadcast and the
    large side does not move. Beyond that the large side is salted by its `spread` columns
    and the lookup repeated once per salt, so that a hot key is shared by many tasks.
    """
    if small.count() * row_bytes <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), list(on), how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def named(key: Column | str) -> list[Column]:
    """A key as 128 bits of hashes, null included; long keys are told apart by them without being moved."""
    return [F.xxhash64(F.lit(salt), key).alias(f"_name{salt}") for salt in (1, 2)]


def marked_rows(rows: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Rows whose key is marked true in `marks` (key, marked), which knows every key.

    The marks are written as short names and counted. Of the marked and the others the fewer are
    broadcast, so that the rows stay in place unless both are many.
    """
    names = ["_name1", "_name2"]
    told = materialize(marks.select(*named(key), "marked"), "marks")
    counted = told.agg(F.count_if("marked").alias("marked"), F.count_if(~F.col("marked")).alias("others")).first()
    within = counted["marked"] <= counted["others"]
    side = told.filter(F.col("marked") if within else ~F.col("marked")).select(*names)
    if min(counted) * NAME_BYTES <= BROADCAST_BYTES:
        side = F.broadcast(side)
    return rows.select("*", *named(key)).join(side, names, "left_semi" if within else "left_anti").drop(*names)


def assign_ids(new: DataFrame, order: Sequence[str], taken: DataFrame, id_column: str) -> DataFrame:
    """Number new rows from the highest taken id upwards, without gaps, in the given order.

    `order` must be unique in `new`; time first gives later requests larger ids. The rows are
    range-partitioned, so no task sees more than its share of them.
    """
    highest = taken.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")).first()[0]
    placed = global_position(new, [F.col(c) for c in order], id_column)
    return placed.withColumn(id_column, F.col(id_column) + highest)


def global_position(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number all rows of a table by `order`, which must be a total order.

    The rows are range-partitioned and written once with the number of their partition, so
    counting and numbering see the same partitions; the only unpartitioned window runs over
    one count per partition.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + inside)
        .drop("_range", "_start")
    )
