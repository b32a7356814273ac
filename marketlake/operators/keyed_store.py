"""Keyed tables that batches change without rewriting them.

A keyed table is a log of rows added and rows taken away, bucketed by a column of its key and
appended to. The last row of a key says whether the key is there and with what values; since all
rows of a key lie in one bucket, they are put together when the table is read, without a
shuffle, and a batch joins the table without one as well: only the batch moves. A batch that
names few keys reads the buckets of those alone. A change is one append; `compact` writes the
live rows into a new table.

Batches are numbered by their writer, one at a time. Adding what is there and taking away what is
not changes nothing, so a batch that was lost half way can simply be run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.functions.text import ticker_of
from marketlake.operators.watchlists import DEFAULT_LIST

BUCKETS = 64
# Keys of a batch up to which the buckets to read are listed.
LISTED_KEYS = 256

_BATCH, _HERE = "_batch", "_here"


@dataclass(frozen=True)
class KeyedTable:
    """A table `name` with unique `key`, bucketed by `bucket`, a column of the key."""

    name: str
    key: tuple[str, ...]
    bucket: str
    buckets: int = BUCKETS

    def append(self, rows: DataFrame, batch: int, here: bool = True) -> None:
        """Rows with the columns of the table, added or taken away."""
        logged = rows.withColumn(_BATCH, F.lit(batch).cast("long")).withColumn(_HERE, F.lit(here))
        dealt = logged.repartition(self.buckets, self.bucket)
        dealt.write.mode("append").format("parquet").bucketBy(self.buckets, self.bucket).sortBy(*self.key).saveAsTable(self.name)

    def log(self, spark: SparkSession, only: list | None = None) -> DataFrame:
        """All logged rows, or those whose bucket column has one of some values."""
        rows = spark.table(self.name)
        return rows if only is None else rows.filter(F.col(self.bucket).isin(only))

    def live(self, spark: SparkSession, only: list | None = None) -> DataFrame:
        """One row per key that is there."""
        rows = self.log(spark, only)
        values = [c for c in rows.columns if c not in (*self.key, _BATCH, _HERE)]
        # Of one batch, what is added counts after what is taken away.
        last = F.max(F.struct(_BATCH, _HERE, *values)).alias("_last")
        state = rows.groupBy(*self.key).agg(last).filter(F.col("_last")[_HERE])
        kept = [c for c in rows.columns if c not in (_BATCH, _HERE)]
        return state.select(*[F.col(c) if c in self.key else F.col("_last")[c].alias(c) for c in kept])

    def met(self, rows: DataFrame) -> DataFrame:
        """Live rows of the buckets that a batch (with the bucket column) may touch."""
        spark = rows.sparkSession
        few = rows.select(self.bucket).distinct().limit(LISTED_KEYS + 1).collect()
        return self.live(spark, [r[0] for r in few] if len(few) <= LISTED_KEYS else None)

    def add_absent(self, rows: DataFrame, batch: int) -> None:
        """Append the rows, unique by key, whose key is not there."""
        self.append(rows.join(self.met(rows).select(*self.key), list(self.key), "left_anti"), batch)

    def take_away(self, keys: DataFrame, batch: int) -> None:
        """Log rows whose key is there as gone."""
        gone = self.met(keys).join(keys.select(*self.key).distinct(), list(self.key), "left_semi")
        self.append(gone.select(*[c for c in self.log(keys.sparkSession).columns if c not in (_BATCH, _HERE)]), batch, here=False)

    def compact(self, spark: SparkSession, name: str) -> KeyedTable:
        """The live rows as a new table."""
        after = KeyedTable(name, self.key, self.bucket, self.buckets)
        after.append(self.live(spark), 0)
        return after


def numbered(rows: DataFrame, table: KeyedTable, id_column: str, order: list[str]) -> DataFrame:
    """New rows with ids that no row of the table has.

    Beyond the highest one taken every bucket counts for itself, in steps of the number of
    buckets; only the new rows are put in order.
    """
    highest = table.log(rows.sparkSession).agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(table.bucket), F.lit(table.buckets)))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    number = F.lit(highest + 1) + (F.col("_place") - 1) * table.buckets + F.col("_bucket")
    return placed.withColumn("_place", place).withColumn(id_column, number.cast("long")).drop("_bucket", "_place")


@dataclass(frozen=True)
class WatchlistStore:
    """Users, lists and listed tickers as keyed tables of one database."""

    users: KeyedTable
    lists: KeyedTable
    tickers: KeyedTable

    @staticmethod
    def of(database: str, buckets: int = BUCKETS) -> WatchlistStore:
        return WatchlistStore(
            KeyedTable(f"{database}.users", ("email",), "email", buckets),
            KeyedTable(f"{database}.watchlists", ("user_id", "name", "watchlist_id"), "user_id", buckets),
            KeyedTable(f"{database}.watchlist_tickers", ("watchlist_id", "ticker"), "watchlist_id", buckets),
        )

    def load(self, users: DataFrame, lists: DataFrame, tickers: DataFrame) -> None:
        """First rows of all three tables."""
        for table, rows in ((self.users, users), (self.lists, lists), (self.tickers, tickers)):
            table.append(rows, 0)

    def add(self, requests: DataFrame, batch: int) -> None:
        """Add a batch of tickers, making users and lists that do not exist yet: three appends.

        `requests` (email, list_name, ticker, requested_at) is read for each of them.
        """
        name = F.coalesce("list_name", F.lit(DEFAULT_LIST)).alias("name")
        asked = requests.groupBy("email", name, ticker_of("ticker").alias("ticker")).agg(F.min("requested_at").alias("requested_at"))

        wanted = asked.groupBy("email").agg(F.min("requested_at").alias("created_at"))
        new = wanted.join(self.users.met(wanted).select("email"), "email", "left_anti")
        new = numbered(new.withColumn("display_name", _null("string")), self.users, "user_id", ["created_at", "email"])
        self.users.append(new.select("user_id", "email", "display_name", "created_at"), batch)

        owners = self.users.met(asked).select("email", "user_id")
        asked = asked.join(owners, "email")
        wanted = asked.groupBy("user_id", "name").agg(F.min("requested_at").alias("created_at"))
        new = wanted.join(self.lists.met(wanted).select("user_id", "name"), ["user_id", "name"], "left_anti")
        new = numbered(new.withColumn("description", _null("string")), self.lists, "watchlist_id", ["created_at", "user_id", "name"])
        self.lists.append(new.select("watchlist_id", "user_id", "name", "description", "created_at"), batch)

        oldest = self.lists.met(asked).groupBy("user_id", "name").agg(F.min("watchlist_id").alias("watchlist_id"))
        rows = asked.join(oldest, ["user_id", "name"]).select("watchlist_id", "ticker", F.col("requested_at").alias("added_at"))
        self.tickers.add_absent(rows, batch)

    def remove(self, requests: DataFrame, batch: int) -> None:
        """Take a batch of tickers off all lists of the given name: one append."""
        name = F.coalesce("list_name", F.lit(DEFAULT_LIST)).alias("name")
        asked = requests.select("email", name, ticker_of("ticker").alias("ticker")).distinct()
        known = asked.join(self.users.met(asked).select("email", "user_id"), "email")
        lists = self.lists.met(known).select("watchlist_id", "user_id", "name")
        self.tickers.take_away(lists.join(known, ["user_id", "name"]).select("watchlist_id", "ticker"), batch)

    def listed(self, spark: SparkSession) -> DataFrame:
        """email, list_name, watchlist_id, ticker, added_at of all lists."""
        lists = self.lists.live(spark).select("watchlist_id", "user_id", F.col("name").alias("list_name"))
        owned = lists.join(self.users.live(spark).select("user_id", "email"), "user_id")
        return self.tickers.live(spark).join(owned, "watchlist_id").select("email", "list_name", "watchlist_id", "ticker", "added_at")


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)
