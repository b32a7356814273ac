from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.operators import keys, notes, watchlists
from marketlake.schemas import RESEARCH_NOTES, USERS, WATCHLIST_TICKERS, WATCHLISTS

T0 = datetime(2024, 1, 1)
REQUEST = "email string, list_name string, ticker string, requested_at timestamp"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture
def base(spark):
    users = spark.createDataFrame([(1, "a@x", "A", T0), (2, "b@x", "B", T0)], USERS)
    lists = spark.createDataFrame(
        [(10, 1, "default", None, T0), (11, 1, "default", None, T0), (12, 1, "tech", None, T0)], WATCHLISTS
    )
    tickers = spark.createDataFrame([(10, "AAPL", T0), (11, "AAPL", T0), (12, "TSLA", at(1))], WATCHLIST_TICKERS)
    return users, lists, tickers


def requests(spark, *rows):
    return spark.createDataFrame(rows, REQUEST)


def test_add_makes_users_and_lists_once(spark, base, rows):
    batch = requests(
        spark,
        ("a@x", None, "aapl", at(5)),  # already there
        ("a@x", "default", "nvda", at(6)), ("a@x", "default", "NVDA", at(5)),  # twice
        ("b@x", "tech", "msft", at(7)),  # new list
        ("c@x", "tech", "msft", at(8)), ("c@x", None, "msft", at(9)),  # new user, two lists
    )
    added = watchlists.add_to_watchlists(*base, batch)
    assert rows(added.users, "user_id", "email") == [(1, "a@x"), (2, "b@x"), (3, "c@x")]
    lists = added.watchlists.filter("watchlist_id > 12")
    assert sorted(r["watchlist_id"] for r in lists.collect()) == [13, 14, 15]
    named = added.new.join(added.watchlists, "watchlist_id")
    assert rows(named, "email", "name", "ticker", "added_at", "user_id") == [
        ("a@x", "default", "NVDA", at(5), 1), ("b@x", "tech", "MSFT", at(7), 2),
        ("c@x", "default", "MSFT", at(9), 3), ("c@x", "tech", "MSFT", at(8), 3),
    ]
    assert added.new.filter("ticker = 'NVDA'").first()["watchlist_id"] == 10  # the oldest of two

    again = watchlists.add_to_watchlists(added.users, added.watchlists, added.tickers, batch)
    assert again.new.count() == 0
    assert rows(again.users) == rows(added.users) and rows(again.watchlists) == rows(added.watchlists)


def test_remove_reports_and_undoes_an_add(spark, base, rows):
    batch = requests(spark, ("a@x", "tech", "nvda", at(5)), ("a@x", "tech", "msft", at(5)))
    added = watchlists.add_to_watchlists(*base, batch)
    removed = watchlists.remove_from_watchlists(added.users, added.watchlists, added.tickers, batch)
    assert rows(removed.tickers) == rows(base[2])
    assert rows(removed.gone, "watchlist_id", "ticker") == [(12, "MSFT"), (12, "NVDA")]


def test_remove_takes_all_lists_of_a_name(spark, base, rows):
    batch = requests(
        spark, ("a@x", None, "aapl", at(5)), ("a@x", "tech", "aapl", at(5)), ("z@x", None, "aapl", at(5)),
        ("a@x", None, "AAPL", at(9)),
    )
    removed = watchlists.remove_from_watchlists(*base, batch)
    assert rows(removed.outcomes) == [
        ("a@x", "default", "AAPL", 2), ("a@x", "tech", "AAPL", 0), ("z@x", "default", "AAPL", 0),
    ]
    assert rows(removed.tickers, "watchlist_id") == [(12,)]


def test_get_is_newest_first(spark, base):
    users, lists, tickers = base
    more = tickers.unionByName(spark.createDataFrame([(12, "AMZN", at(2)), (12, "NFLX", at(0))], WATCHLIST_TICKERS))
    found = watchlists.get_watchlists(users, lists, more, "a@x", "tech").collect()
    assert [r["ticker"] for r in found] == ["AMZN", "TSLA", "NFLX"]
    assert watchlists.get_watchlists(users, lists, more, "b@x", "tech").count() == 0
    assert watchlists.get_watchlists(users, lists, more).count() == 5


def test_replay_lets_the_last_operation_decide(spark, rows):
    log = spark.createDataFrame(
        [
            ("a@x", "l", "aapl", "add", at(1), 1), ("a@x", "l", "AAPL", "add", at(2), 2),
            ("a@x", "l", "tsla", "add", at(1), 3), ("a@x", "l", "tsla", "remove", at(2), 4),
            ("a@x", "l", "nvda", "add", at(1), 5), ("a@x", "l", "nvda", "remove", at(2), 6),
            ("a@x", "l", "nvda", "add", at(2), 7), ("a@x", "l", "gone", "remove", at(3), 8),
        ],
        "email string, list_name string, ticker string, operation string, ts timestamp, seq int",
    )
    assert rows(watchlists.replay(log, ["ts", "seq"]), "ticker", "added_at") == [("AAPL", at(2)), ("NVDA", at(2))]


def test_mutation_log_holds_real_inserts_only(spark, base, rows):
    batch = requests(spark, ("a@x", None, "aapl", at(5)), ("a@x", None, "nvda", at(5)))
    added = watchlists.add_to_watchlists(*base, batch)
    log = watchlists.mutation_log(added.new, watchlists.ADD, "added_at", "agent")
    assert rows(log, "user_id", "ticker", "operation", "source", "timestamp") == [
        ("a@x", "NVDA", "add", "agent", at(5))
    ]
    gone = watchlists.remove_from_watchlists(*base, batch).gone
    log = watchlists.mutation_log(gone, watchlists.REMOVE, "requested_at", "app")
    assert rows(log, "user_id", "ticker", "operation") == [("a@x", "AAPL", "remove")] * 2
    assert log.select("mutation_id").distinct().count() == 2


def test_ids_are_dense_over_many_rows(spark):
    taken = spark.createDataFrame([(41,)], "id bigint")
    new = spark.range(0, 5000, numPartitions=9).select(F.concat(F.lit("k"), "id").alias("key"))
    ids = [r["id"] for r in keys.assign_ids(new, ["key"], taken, "id").collect()]
    assert sorted(ids) == list(range(42, 5042))
    assert keys.assign_ids(new, ["key"], taken.limit(0), "id").agg(F.min("id")).first()[0] == 1


def test_notes(spark, base, rows):
    users = base[0]
    old = spark.createDataFrame(
        [(n, 1, "AAPL" if n % 2 else "TSLA", None, f"note {n}", at(n)) for n in range(1, 13)], RESEARCH_NOTES
    )
    saved = notes.save_notes(
        users, old,
        spark.createDataFrame(
            [("r1", "b@x", "nvda", "x" * 300, at(50)), ("r2", "n@x", "nvda", "short", at(60))],
            "request_id string, email string, ticker string, note string, requested_at timestamp",
        ),
    )
    assert sorted(r["note_id"] for r in saved.new.collect()) == [13, 14]
    assert rows(saved.users, "user_id", "email") == [(1, "a@x"), (2, "b@x"), (3, "n@x")]
    assert saved.notes.count() == 14

    mine = notes.get_notes(saved.users, saved.notes, "a@x").collect()
    assert [r["note_id"] for r in mine] == list(range(12, 2, -1))
    assert mine[0]["snippet"] == "note 12..."
    assert [r["note_id"] for r in notes.get_notes(saved.users, saved.notes, "a@x", "aapl", limit=2).collect()] == [11, 9]
    everybody = notes.get_notes(saved.users, saved.notes)
    assert rows(everybody.groupBy("email").count()) == [("a@x", 10), ("b@x", 1), ("n@x", 1)]
    assert everybody.filter("email = 'b@x'").first()["snippet"] == "x" * 200 + "..."
