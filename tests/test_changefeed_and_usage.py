from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from row_order import ordered
from marketlake.operators import changefeed, usage
from marketlake.plans import usage_rollup
from marketlake.plans.usage_rollup import UsagePaths, read_daily_stats, run_usage_rollup
from marketlake.schemas import AGENT_TOOL_CALLS, WATCHLIST_MUTATIONS, feed_of
from marketlake.streaming.usage_stream import start_usage_stream

AS_OF = datetime(2024, 1, 31)

snapshots = st.dictionaries(st.integers(0, 6), st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from("ab")))


def frame(spark, snapshot):
    return spark.createDataFrame([(k, v, s) for k, (v, s) in snapshot.items()], "key int, value int, name string")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=snapshots, new=snapshots)
def test_applying_a_diff_gives_the_new_snapshot(spark, rows, old, new):
    before, after = frame(spark, old), frame(spark, new)
    changes = changefeed.snapshot_diff(before, after, ["key"])
    assert rows(changefeed.apply_changes(before, changes, ["key"])) == rows(after)
    kinds = {r["_change_type"] for r in changes.collect()}
    assert bool(kinds) == (old != new)


def test_diff_of_every_kind(spark, rows):
    old = frame(spark, {1: (1, "a"), 2: (None, "a"), 3: (3, "a"), 4: (4, "a")})
    new = frame(spark, {2: (None, "a"), 3: (None, "a"), 4: (5, "a"), 9: (9, "b")})
    changes = changefeed.snapshot_diff(old, new, ["key"])
    assert rows(changes, "key", "value", "_change_type") == ordered(
        [
            (1, 1, "delete"), (3, 3, "update_preimage"), (3, None, "update_postimage"),
            (4, 4, "update_preimage"), (4, 5, "update_postimage"), (9, 9, "insert"),
        ]
    )
    stamped = changefeed.committed(changes, 7, AS_OF)
    assert {(r["_commit_version"], r["_commit_timestamp"]) for r in stamped.collect()} == {(7, AS_OF)}


def call(number, when, user="u1", tool="t1", ticker="AA", success=True, message=None, change="insert", version=1, commit=None):
    return (str(number), when, user, tool, ticker, success, message, 5, change, version, commit or when)


def calls_of(spark, *values):
    return spark.createDataFrame(list(values), feed_of(AGENT_TOOL_CALLS))


def mutations_of(spark, *values):
    full = [(str(n), w, u, t, op, "app", change, 1, w) for n, w, u, t, op, change in values]
    return spark.createDataFrame(full, feed_of(WATCHLIST_MUTATIONS))


def test_hourly_counts_current_rows(spark, rows):
    hour = datetime(2024, 1, 5, 10)
    feed = calls_of(
        spark,
        call(1, hour.replace(minute=1), tool="get_stock_price"),
        call(2, hour.replace(minute=59), tool="get_stock_price", success=False, message="E"),
        call(3, hour.replace(minute=30), tool="get_stock_price", success=False),
        call(4, hour.replace(minute=30), tool="get_stock_price", change="update_preimage"),
        call(5, hour.replace(minute=30), tool="get_stock_price", change="update_postimage"),
        call(6, hour.replace(minute=30), tool="get_stock_price", change="delete"),
        call(7, hour.replace(hour=11), tool="search_by_sector", ticker=None),
    )
    assert rows(usage.tool_calls_hourly(feed)) == [
        (hour, "get_stock_price", "u1", 4, 2, 1, 3),
        (hour.replace(hour=11), "search_by_sector", "u1", 1, 1, 0, 1),
    ]


def test_daily_mutations_count_inserts(spark, rows):
    day = datetime(2024, 1, 5, 10)
    feed = mutations_of(
        spark, (1, day, "u1", "AA", "add", "insert"), (2, day, "u1", "AA", "add", "insert"),
        (3, day, "u1", None, "add", "insert"), (4, day, "u1", "BB", "add", "update_postimage"),
        (5, day, "u1", "AA", "remove", "insert"),
    )
    assert rows(usage.watchlist_daily(feed)) == [
        (date(2024, 1, 5), "add", "u1", 3, 1), (date(2024, 1, 5), "remove", "u1", 1, 1),
    ]


def test_daily_statistics(spark, rows):
    day = datetime(2024, 1, 5, 10)
    calls = calls_of(
        spark, call(1, day, tool="b"), call(2, day, tool="a", success=False), call(3, day, tool="a", ticker="BB"),
        call(4, day, tool="b", ticker=None), call(5, day, user="u2", tool="z", change="delete"),
    )
    later = datetime(2024, 1, 5, 12)
    mutations = mutations_of(
        spark, (1, later, "u1", "AA", "add", "insert"), (2, later, "u3", "AA", "remove", "insert")
    )
    stats = usage.daily_usage_stats(calls, mutations)
    today = date(2024, 1, 5)
    assert rows(stats) == [
        (today, "u1", 4, 3, 1, 1, 0, 2, "a", later), (today, "u3", 0, 0, 0, 0, 1, 0, None, later),
    ]
    assert rows(usage.usage_last_days(stats, date(2024, 1, 12))) == [(today, 4, 3, 1)]
    assert usage.usage_last_days(stats, date(2024, 1, 13)).count() == 0


def test_mark_of_an_empty_rollup_is_the_given_start(spark):
    from marketlake.schemas import DAILY_USAGE_STATS

    empty = spark.createDataFrame([], DAILY_USAGE_STATS)
    assert usage.high_water_mark(empty, AS_OF) == "2024-01-31 00:00:00"
    assert usage.high_water_mark(empty) is None


@pytest.fixture
def paths(tmp_path):
    return UsagePaths(str(tmp_path / "calls"), str(tmp_path / "mutations"), str(tmp_path / "rollups"))


# Commits as (commit day, rows); the last carries a late event for an old day.
COMMITS = [
    (3, [(datetime(2024, 1, 3, 9), "u1"), (datetime(2024, 1, 3, 10), "u2")]),
    (4, [(datetime(2024, 1, 4, 9), "u1")]),
    (5, [(datetime(2024, 1, 5, 9), "u1"), (datetime(2024, 1, 2, 23), "u1"), (datetime(2024, 1, 3, 9), "u1")]),
]


def commit(spark, paths, day, events):
    when = datetime(2024, 1, day, 23, 30)
    rows = [call(day * 10 + i, w, user=u, version=day, commit=when) for i, (w, u) in enumerate(events)]
    changefeed.write_feed(calls_of(spark, *rows), paths.calls, "timestamp")
    changes = mutations_of(spark, (day, datetime(2024, 1, day, 8), "u1", "AA", "add", "insert"))
    changefeed.write_feed(changes, paths.mutations, "timestamp")


def whole(spark, paths):
    return usage.daily_usage_stats(*usage_rollup.read_feeds(spark, paths))


@pytest.mark.parametrize("runs", [{3}, {1, 3}, {1, 2, 3}, {2, 3}])
def test_any_split_of_commits_gives_the_whole_rollup(spark, paths, rows, runs):
    for number, (day, events) in enumerate(COMMITS, 1):
        commit(spark, paths, day, events)
        if number in runs:
            report = run_usage_rollup(spark, paths)
            assert all(isinstance(v, int) for v in report.values())
    assert rows(read_daily_stats(spark, paths)) == rows(whole(spark, paths))
    run_usage_rollup(spark, paths)
    assert rows(read_daily_stats(spark, paths)) == rows(whole(spark, paths))
    hourly = spark.read.parquet(paths.rollup("hourly_tool_stats"))
    assert hourly.agg({"call_count": "sum"}).first()[0] == 6


def test_one_failing_rollup_leaves_the_other_and_is_retried(spark, paths, rows, monkeypatch):
    commit(spark, paths, *COMMITS[0])
    with monkeypatch.context() as broken:
        broken.setattr(usage, "watchlist_daily", lambda feed: feed.selectExpr("raise_error('no') AS date"))
        with pytest.raises(RuntimeError, match="daily_watchlist_stats"):
            run_usage_rollup(spark, paths)
    assert spark.read.parquet(paths.rollup("hourly_tool_stats")).count() > 0
    assert read_daily_stats(spark, paths).count() == 0
    run_usage_rollup(spark, paths)
    assert rows(read_daily_stats(spark, paths)) == rows(whole(spark, paths))


def test_stream_takes_up_late_events_once(spark, paths, rows):
    for day, events in COMMITS:
        commit(spark, paths, day, events)
        query = start_usage_stream(spark, paths, paths.rollups + "/_progress")
        query.awaitTermination()
        assert query.exception() is None
    assert rows(read_daily_stats(spark, paths)) == rows(whole(spark, paths))
    query = start_usage_stream(spark, paths, paths.rollups + "/_progress")
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 0


def test_reading_dates_prunes_folders(spark, paths, capsys):
    for day, events in COMMITS:
        commit(spark, paths, day, events)
    calls, _ = usage_rollup.read_feeds(spark, paths)
    calls.filter(calls.event_date.isin([date(2024, 1, 2)])).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def commit_feed(spark, paths, feed, day, number):
    when = datetime(2024, 1, day, 23, 30)
    if feed == "calls":
        rows = calls_of(spark, call(number, datetime(2024, 1, day, 9), version=day, commit=when))
        changefeed.write_feed(rows, paths.calls, "timestamp")
    else:
        full = [(str(number), datetime(2024, 1, day, 8), "u1", "AA", "add", "app", "insert", day, when)]
        changefeed.write_feed(spark.createDataFrame(full, feed_of(WATCHLIST_MUTATIONS)), paths.mutations, "timestamp")


def test_a_feed_that_lags_loses_nothing(spark, paths, rows):
    commit_feed(spark, paths, "mutations", 1, 0)
    commit_feed(spark, paths, "calls", 10, 1)
    run_usage_rollup(spark, paths)
    commit_feed(spark, paths, "mutations", 8, 2)
    run_usage_rollup(spark, paths)
    assert rows(read_daily_stats(spark, paths)) == rows(whole(spark, paths))
    assert {r["date"] for r in read_daily_stats(spark, paths).collect()} == {date(2024, 1, d) for d in (1, 8, 10)}
    assert run_usage_rollup(spark, paths) == {}


def test_old_commits_are_taken_unless_a_start_is_given(spark, paths, tmp_path):
    for day in (5, 20):
        commit_feed(spark, paths, "calls", day, day)
        commit_feed(spark, paths, "mutations", day, day)
    later = UsagePaths(paths.calls, paths.mutations, str(tmp_path / "later"))
    run_usage_rollup(spark, paths)
    run_usage_rollup(spark, later, since=datetime(2024, 1, 10))
    assert {r["date"].day for r in read_daily_stats(spark, paths).collect()} == {5, 20}
    assert {r["date"].day for r in read_daily_stats(spark, later).collect()} == {20}


def test_reading_commits_prunes_folders(spark, paths, capsys):
    for day, events in COMMITS:
        commit(spark, paths, day, events)
    calls, _ = usage_rollup.read_feeds(spark, paths)
    for part in (
        usage_rollup.unseen_commits(calls, 3),
        changefeed.read_stored_changes(calls, paths.calls, datetime(2024, 1, 4)),
    ):
        assert {r["_commit_version"] for r in part.collect()} == {4, 5}
        part.explain("formatted")
        filters = capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]
        assert "_commit_version" in filters
    assert changefeed.read_stored_changes(calls, paths.calls, datetime(2024, 2, 1)).count() == 0
    with pytest.raises(ValueError):
        changefeed.read_changes(calls)
