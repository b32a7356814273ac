from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketlake.operators import changefeed, usage
from marketlake.plans import usage_deltas
from marketlake.plans.usage_rollup import UsagePaths, read_daily_stats, read_feeds
from marketlake.schemas import AGENT_TOOL_CALLS, WATCHLIST_MUTATIONS, feed_of
from marketlake.sources import sample_tables

FOLDER = "/root/testdata/sf0.001"
VERSIONS = range(1, 32)


@pytest.fixture(scope="module")
def feeds(spark):
    return sample_tables.tool_call_feed(spark, FOLDER).cache(), sample_tables.watchlist_feed(spark, FOLDER).cache()


@pytest.fixture
def paths(tmp_path):
    return UsagePaths(str(tmp_path / "calls"), str(tmp_path / "mutations"), str(tmp_path / "rollups"))


def write(feeds, paths, first, last, which=("calls", "mutations")):
    for name, feed, path in zip(("calls", "mutations"), feeds, (paths.calls, paths.mutations)):
        chosen = feed.filter(F.col("_commit_version").between(first, last) if name in which else F.lit(False))
        changefeed.write_feed(chosen, path, "timestamp")


@pytest.mark.parametrize("cuts", [[31], [10, 31], [1, 2, 20, 31]])
def test_any_split_gives_the_whole_tables(spark, paths, feeds, rows, cuts):
    first = 1
    for last in cuts:
        write(feeds, paths, first, last)
        usage_deltas.run_usage_deltas(spark, paths)
        first = last + 1
    calls, mutations = feeds
    expected = rows(usage.daily_usage_stats(calls, mutations))
    for _ in range(2):
        assert rows(usage_deltas.daily_stats(spark, paths)) == expected == rows(read_daily_stats(spark, paths))
        assert rows(usage_deltas.hourly_stats(spark, paths)) == rows(usage.tool_calls_hourly(calls))
        assert rows(usage_deltas.watchlist_stats(spark, paths)) == rows(usage.watchlist_daily(mutations))
        usage_deltas.compact(spark, paths)
    last = usage_deltas.last_run(spark, paths)
    assert last.base == last.run and usage_deltas.run_usage_deltas(spark, paths) == last


def test_only_new_commits_are_read(spark, paths, feeds, capsys):
    write(feeds, paths, 1, 9)
    usage_deltas.run_usage_deltas(spark, paths)
    write(feeds, paths, 10, 12)
    seen = []
    original = usage_deltas._parts_of

    def spying(calls, mutations, net):
        seen.extend({r["_commit_version"] for r in calls.select("_commit_version").distinct().collect()})
        calls.explain("formatted")
        return original(calls, mutations, net)

    usage_deltas._parts_of = spying
    try:
        usage_deltas.run_usage_deltas(spark, paths)
    finally:
        usage_deltas._parts_of = original
    assert sorted(seen) == [10, 11, 12]
    assert "_commit_version" in capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]


def test_a_run_that_is_not_noted_does_not_count(spark, paths, feeds, rows, monkeypatch):
    write(feeds, paths, 1, 15)
    with monkeypatch.context() as broken:
        broken.setattr(usage_deltas, "_note", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            usage_deltas.run_usage_deltas(spark, paths)
    assert usage_deltas.daily_stats(spark, paths).count() == 0
    write(feeds, paths, 16, 31)
    usage_deltas.run_usage_deltas(spark, paths)
    assert rows(usage_deltas.daily_stats(spark, paths)) == rows(usage.daily_usage_stats(*feeds))


def test_a_lagging_feed(spark, paths, feeds, rows):
    write(feeds, paths, 1, 31, which=("calls",))
    usage_deltas.run_usage_deltas(spark, paths)
    write(feeds, paths, 1, 31, which=("mutations",))
    usage_deltas.run_usage_deltas(spark, paths)
    assert rows(read_daily_stats(spark, paths)) == rows(usage.daily_usage_stats(*feeds))


def test_net_counts_take_back(spark, paths, rows):
    at = datetime(2024, 1, 3, 9)
    table = lambda *r: spark.createDataFrame(list(r), AGENT_TOOL_CALLS)
    call = lambda i, tool, ticker, ok=True: (str(i), at, "u", tool, ticker, ok, None, 5)
    states = [
        table(call(1, "a", "X"), call(2, "a", "Y"), call(3, "b", "Y", False)),
        table(call(1, "b", "X"), call(3, "b", "Y", False), call(4, "b", None)),
        table(call(4, "b", None)),
    ]
    changefeed.write_feed(spark.createDataFrame([], feed_of(WATCHLIST_MUTATIONS)), paths.mutations, "timestamp")
    before = spark.createDataFrame([], AGENT_TOOL_CALLS)
    for version, state in enumerate(states, 1):
        changes = changefeed.committed(changefeed.snapshot_diff(before, state, ["call_id"]), version, at)
        changefeed.write_feed(changes.select(feed_of(AGENT_TOOL_CALLS).names), paths.calls, "timestamp")
        usage_deltas.run_usage_deltas(spark, paths, net=True)
        before = state
        inserted = changefeed.committed(state.withColumn("_change_type", F.lit("insert")), version, at)
        none = spark.createDataFrame([], feed_of(WATCHLIST_MUTATIONS))
        assert rows(usage_deltas.hourly_stats(spark, paths)) == rows(usage.tool_calls_hourly(inserted))
        wanted = usage.daily_usage_stats(inserted, none).drop("last_updated")
        assert rows(usage_deltas.daily_stats(spark, paths).drop("last_updated")) == rows(wanted)


def test_sketches_stay_within_their_error(spark, paths, rows):
    """Many users, most of them on two days: united sketches count them once."""
    users = spark.range(30_000).select(
        F.col("id").cast("string").alias("call_id"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 2) * 86400).alias("timestamp"),
        F.concat(F.lit("u"), F.floor(F.col("id") / 3)).alias("user_id"),
        F.lit("tool").alias("tool_name"), F.concat(F.lit("T"), F.col("id") % 50).alias("ticker"), F.lit(True).alias("success"),
        F.lit(None).cast("string").alias("error_message"), F.lit(1).cast("long").alias("execution_time_ms"),
    )
    for version in (1, 2):
        some = users.filter(F.pmod(F.xxhash64("call_id"), F.lit(2)) == version - 1)
        feed = changefeed.committed(some.withColumn("_change_type", F.lit("insert")), version, "2024-01-03 00:00:00")
        changefeed.write_feed(feed, paths.calls, "timestamp")
        changefeed.write_feed(spark.createDataFrame([], feed_of(WATCHLIST_MUTATIONS)), paths.mutations, "timestamp")
        usage_deltas.run_usage_deltas(spark, paths)
    estimated = usage_deltas.distinct_counts(spark, paths, F.lit("all").alias("period")).first()
    assert abs(estimated["users"] - 10_000) <= 4 * usage.SKETCH_ERROR * 10_000
    assert estimated["tickers"] == 50
    daily = {str(r["date"]): r["users"] for r in usage_deltas.distinct_counts(spark, paths, "date").collect()}
    assert all(abs(n - 10_000) <= 4 * usage.SKETCH_ERROR * 10_000 for n in daily.values()) and len(daily) == 2
