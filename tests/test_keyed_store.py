import contextlib
import io
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.operators import watchlists
from marketlake.operators.keyed_store import KeyedTable, WatchlistStore
from marketlake.schemas import USERS, WATCHLIST_TICKERS, WATCHLISTS
from marketlake.sources import tables

NOW = datetime(2024, 1, 1)


@pytest.fixture
def database(spark):
    name = f"keyed_{uuid.uuid4().hex}"
    tables.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_the_last_row_of_a_key_counts(spark, database, rows):
    table = KeyedTable(f"{database}.t", ("a", "b"), "a", 4)
    frame = lambda *r: spark.createDataFrame(list(r), "a int, b string, c int")
    table.append(frame((1, "x", 1), (1, "y", 2), (2, "x", 3)), 0)
    table.add_absent(frame((1, "x", 9), (3, "z", 4)), 1)
    assert rows(table.live(spark)) == [(1, "x", 1), (1, "y", 2), (2, "x", 3), (3, "z", 4)]
    table.take_away(frame((1, "x", 0), (7, "q", 0), (1, "x", 5)), 2)
    assert rows(table.live(spark)) == [(1, "y", 2), (2, "x", 3), (3, "z", 4)]
    table.add_absent(frame((1, "x", 7)), 3)
    table.add_absent(frame((1, "x", 8)), 3)
    expected = [(1, "x", 7), (1, "y", 2), (2, "x", 3), (3, "z", 4)]
    assert rows(table.live(spark)) == expected
    assert rows(table.compact(spark, f"{database}.u").live(spark)) == expected


def test_the_table_is_not_shuffled(spark, database):
    table = KeyedTable(f"{database}.t", ("a", "b"), "a", 8)
    base = spark.range(20_000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1).alias("c"))
    table.append(base, 0)
    assert "Exchange" not in plan_of(table.live(spark))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = base.filter("a % 3 = 0").withColumn("a", F.col("a") + 10_000)
        plan = plan_of(many.join(table.met(many).select("a", "b"), ["a", "b"], "left_anti"))
        # The batch moves, the table does not.
        assert plan.split("== Physical Plan ==")[1].count("- Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    few = spark.createDataFrame([(5, "x", 1)], "a long, b string, c int")
    assert "SelectedBucketsCount: 1 out of 8" in plan_of(table.met(few))


@pytest.fixture
def relations(spark):
    at = lambda n: NOW + timedelta(minutes=n)
    users = [(i, f"u{i}@x", None, NOW) for i in range(1, 6)]
    lists = [(1, 1, "default", None, NOW), (2, 1, "tech", None, NOW), (3, 2, "default", None, NOW), (4, 1, "tech", None, NOW)]
    rows = [(1, "AA", at(0)), (2, "BB", at(1)), (4, "BB", at(2)), (3, "CC", at(3))]
    return (
        spark.createDataFrame(users, USERS), spark.createDataFrame(lists, WATCHLISTS), spark.createDataFrame(rows, WATCHLIST_TICKERS)
    )


REQUESTS = "email string, list_name string, ticker string, requested_at timestamp"


def test_batches_as_the_plain_functions_make_them(spark, database, relations, rows):
    at = lambda n: NOW + timedelta(hours=n)
    adds = spark.createDataFrame(
        [("u1@x", None, "aa", at(1)), ("u1@x", "tech", "cc", at(2)), ("new@x", None, "dd", at(4)), ("new@x", None, "DD", at(3)), ("u3@x", "tech", "bb", at(5)), ("u2@x", "late", "zz", at(6))],
        REQUESTS,
    )
    removals = spark.createDataFrame([("u1@x", "tech", "bb", at(1)), ("u2@x", None, "cc", at(2)), ("nobody@x", None, "cc", at(2))], REQUESTS)
    columns = ["email", "list_name", "ticker", "added_at"]
    store = WatchlistStore.of(database, 4)
    store.load(*relations)
    before = spark.table(store.tickers.name).count()
    for _ in range(2):  # the second time changes nothing
        store.add(adds, 1)
    added = watchlists.add_to_watchlists(*relations, adds)
    expected = watchlists.get_watchlists(added.users, added.watchlists, added.tickers)
    assert rows(store.listed(spark), *columns) == rows(expected, *columns)
    assert spark.table(store.tickers.name).count() - before == added.new.count()
    for table, column in ((store.users, "user_id"), (store.lists, "watchlist_id")):
        ids = [r[0] for r in table.live(spark).select(column).collect()]
        assert len(ids) == len(set(ids))
    store.remove(removals, 2)
    left = watchlists.remove_from_watchlists(added.users, added.watchlists, added.tickers, removals)
    expected = watchlists.get_watchlists(added.users, added.watchlists, left.tickers)
    assert rows(store.listed(spark), *columns) == rows(expected, *columns)
