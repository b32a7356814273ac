"""Managed parquet tables: creation, writes that count, inspection."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schemas import DECLARED_TABLES, PARTITION_COLUMNS


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database unless it exists, in the warehouse or at a location of its own."""
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty parquet table unless it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitions}")


def create_declared_tables(spark: SparkSession, database: str) -> None:
    """Every declared table, empty where it does not exist."""
    create_database(spark, database)
    for name, schema in DECLARED_TABLES.items():
        create_table(spark, f"{database}.{name}", schema, PARTITION_COLUMNS.get(name, ()))


_VERSIONS = "number long, folder string"


def read_version(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest complete version of a table below `path`; no rows if there is none."""
    spark.createDataFrame([], _VERSIONS).write.mode("ignore").parquet(f"{path}/_versions")
    newest = spark.read.schema(_VERSIONS).parquet(f"{path}/_versions").orderBy(F.desc("number")).first()
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{newest['folder']}")


def write_version(df: DataFrame, path: str) -> int:
    """Write a new version of a table below `path`, then name it as the newest.

    The table may be computed from its own earlier version. One writer at a time.
    """
    spark = df.sparkSession
    folder = f"version-{uuid.uuid4().hex}"
    rows = _counted(df, lambda d: d.write.parquet(f"{path}/{folder}"))
    spark.createDataFrame([], _VERSIONS).write.mode("ignore").parquet(f"{path}/_versions")
    last = spark.read.schema(_VERSIONS).parquet(f"{path}/_versions").agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    spark.createDataFrame([(last + 1, folder)], _VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/_versions")
    return rows


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Rows written, counted by the write itself instead of by a second run."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def overwrite(df: DataFrame, name: str) -> int:
    """Replace a table; its columns become those of `df`."""
    return _counted(df, lambda d: d.write.mode("overwrite").format("parquet").saveAsTable(name))


def append(df: DataFrame, name: str) -> int:
    return _counted(df, lambda d: d.write.mode("append").format("parquet").saveAsTable(name))


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace only the partitions present in `df`; running it again changes nothing."""
    placed = df.hint("rebalance", *partition_by)
    return _counted(
        placed,
        lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path),
    )


def overwrite_table_partitions(df: DataFrame, name: str) -> int:
    """The same for a managed partitioned table; columns are matched by name."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        return _counted(df.select(*spark.table(name).columns), lambda d: d.write.insertInto(name, overwrite=True))
    finally:
        spark.conf.set(setting, before)


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A table, or no rows with its schema where it does not exist yet."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def profile(df: DataFrame, name: str) -> DataFrame:
    """Schema and row count of a table, one row per column, in one pass."""
    columns = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("data_type"))
        for i, f in enumerate(df.schema, 1)
    ])
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(name).alias("table_name"), "row_count", F.inline(columns))
