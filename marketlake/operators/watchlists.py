"""Watchlists as keyed tables: batches of requests become merges.

Requests have (email, list_name, ticker, requested_at). Every function returns new tables
and leaves its inputs alone; new rows carry the time of the request that made them.

A batch is small beside the tables it changes, but how small is known only once it is
there. It is therefore written to the work folder first; from then on Spark knows its size,
broadcasts it while it fits and leaves the large tables where they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.text import ticker_of
from marketlake.operators.keys import assign_ids
from marketlake.session import materialize

# Name of a list nobody named, and the operations of the mutation log.
DEFAULT_LIST = "default"
ADD, REMOVE = "add", "remove"


def insert_if_absent(base: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key the base lacks; `rows` has one row per key.

    The base is only filtered by the incoming keys, which is a broadcast while the batch is
    small; what it holds of them is then taken off the batch.
    """
    taken = base.select(*key).join(rows.select(*key), list(key), "left_semi")
    return rows.join(taken, list(key), "left_anti")


class Accounts(NamedTuple):
    users: DataFrame
    requested: DataFrame  # email, user_id


def ensure_users(users: DataFrame, requests: DataFrame) -> Accounts:
    """All users after the requests, and the user of every requested address."""
    asked = requests.groupBy("email").agg(F.min("requested_at").alias("created_at"))
    asked = materialize(asked, "asked-users")
    known = users.select("email", "user_id").join(asked.select("email"), "email", "left_semi")
    known = materialize(known, "known-users")
    new = assign_ids(asked.join(known, "email", "left_anti"), ["created_at", "email"], users, "user_id")
    new = new.withColumn("display_name", F.lit(None).cast("string")).select(users.columns)
    return Accounts(users.unionByName(new), known.unionByName(new.select("email", "user_id")))


class Lists(NamedTuple):
    watchlists: DataFrame
    requested: DataFrame  # user_id, name, watchlist_id, created


def get_or_create_lists(watchlists: DataFrame, requests: DataFrame) -> Lists:
    """One list per requested (user_id, name).

    Names may repeat for a user, since the table has no such key; the oldest list, the
    one with the smallest id, is taken. Missing lists are created.
    """
    key = ["user_id", "name"]
    asked = requests.groupBy(*key).agg(F.min("requested_at").alias("created_at"))
    asked = materialize(asked, "asked-lists")
    known = (
        watchlists.select(*key, "watchlist_id")
        .join(asked.select(*key), key, "left_semi")
        .groupBy(*key)
        .agg(F.min("watchlist_id").alias("watchlist_id"))
    )
    known = materialize(known, "known-lists")
    new = assign_ids(asked.join(known, key, "left_anti"), ["created_at", *key], watchlists, "watchlist_id")
    requested = known.withColumn("created", F.lit(False)).unionByName(
        new.select(*key, "watchlist_id", F.lit(True).alias("created"))
    )
    new = new.withColumn("description", F.lit(None).cast("string")).select(watchlists.columns)
    return Lists(watchlists.unionByName(new), requested)


class Added(NamedTuple):
    users: DataFrame
    watchlists: DataFrame
    tickers: DataFrame
    new: DataFrame  # watchlist_id, ticker, added_at, email, list_name


def add_to_watchlists(users: DataFrame, watchlists: DataFrame, tickers: DataFrame, requests: DataFrame) -> Added:
    """Add a batch of tickers, making users and lists that do not exist yet."""
    asked = (
        requests.withColumn("ticker", ticker_of("ticker"))
        .groupBy("email", F.coalesce("list_name", F.lit(DEFAULT_LIST)).alias("name"), "ticker")
        .agg(F.min("requested_at").alias("requested_at"))
    )
    asked = materialize(asked, "asked-tickers")
    accounts = ensure_users(users, asked)
    asked = asked.join(accounts.requested, "email")
    lists = get_or_create_lists(watchlists, asked)
    rows = materialize(
        asked.join(lists.requested, ["user_id", "name"]).select(
            "watchlist_id", "ticker", F.col("requested_at").alias("added_at"), "email",
            F.col("name").alias("list_name"),
        ),
        "asked-rows",
    )
    new = materialize(insert_if_absent(tickers, rows, ["watchlist_id", "ticker"]), "new-rows")
    return Added(accounts.users, lists.watchlists, tickers.unionByName(new.select(tickers.columns)), new)


class Removed(NamedTuple):
    tickers: DataFrame
    gone: DataFrame  # watchlist_id, ticker, added_at, email, list_name, requested_at
    outcomes: DataFrame  # email, list_name, ticker, rows_removed


def remove_from_watchlists(users: DataFrame, watchlists: DataFrame, tickers: DataFrame, requests: DataFrame) -> Removed:
    """Remove a batch of tickers from all lists of the given name, and say what went."""
    request = ["email", "list_name", "ticker"]
    asked = (
        requests.withColumn("ticker", ticker_of("ticker"))
        .withColumn("list_name", F.coalesce("list_name", F.lit(DEFAULT_LIST)))
        .groupBy(*request)
        .agg(F.min("requested_at").alias("requested_at"))
    )
    asked = materialize(asked, "asked-removals")
    owners = users.select("email", "user_id").join(asked.select("email").distinct(), "email", "left_semi")
    known = asked.join(owners, "email").withColumnRenamed("list_name", "name")
    lists = watchlists.select("watchlist_id", "user_id", "name")
    doomed = lists.join(known, ["user_id", "name"]).select(
        "watchlist_id", "ticker", "email", F.col("name").alias("list_name"), "requested_at"
    )
    doomed = materialize(doomed, "doomed")
    pair = ["watchlist_id", "ticker"]
    gone = tickers.join(doomed, pair)
    removed = gone.groupBy(*request).agg(F.count("*").alias("rows_removed"))
    outcomes = asked.drop("requested_at").join(removed, request, "left").withColumn(
        "rows_removed", F.coalesce("rows_removed", F.lit(0))
    )
    return Removed(tickers.join(doomed.select(*pair), pair, "left_anti"), gone, outcomes)


def get_watchlists(
    users: DataFrame,
    watchlists: DataFrame,
    tickers: DataFrame,
    email: str | None = None,
    list_name: str | None = None,
) -> DataFrame:
    """Listed tickers, newest first, for one user and list or for all of them."""
    if email is not None:
        users = users.filter(F.col("email") == email)
    if list_name is not None:
        watchlists = watchlists.filter(F.col("name") == list_name)
    lists = watchlists.select("watchlist_id", "user_id", F.col("name").alias("list_name")).join(
        users.select("user_id", "email"), "user_id"
    )
    return (
        tickers.join(lists, "watchlist_id")
        .select("email", "list_name", "watchlist_id", "ticker", "added_at")
        .orderBy("email", "list_name", F.desc("added_at"), "ticker", "watchlist_id")
    )


def replay(log: DataFrame, order: Sequence[str]) -> DataFrame:
    """The lists an ordered log of operations leaves behind.

    The last operation on a (user, list, ticker) decides; it is found by a plain maximum,
    so a long history of one key is combined before the shuffle.
    """
    last = F.max(F.struct(*order, "operation")).alias("_last")
    state = log.groupBy("email", "list_name", ticker_of("ticker").alias("ticker")).agg(last)
    return state.filter(F.col("_last.operation") == ADD).select(
        "email", "list_name", "ticker", F.col("_last")[order[0]].alias("added_at")
    )


def mutation_log(changed: DataFrame, operation: str, at: str, source: str) -> DataFrame:
    """Rows for the mutation log, from the rows an add or a removal really changed."""
    moment = F.unix_micros(at).cast("string")
    identity = F.concat_ws("-", F.lit(operation), F.col("watchlist_id").cast("string"), F.col("ticker"), moment)
    return changed.select(
        F.md5(identity).alias("mutation_id"),
        F.col(at).alias("timestamp"),
        F.col("email").alias("user_id"),
        "ticker",
        F.lit(operation).alias("operation"),
        F.lit(source).alias("source"),
    )
