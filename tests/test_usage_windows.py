from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlake.operators import changefeed, usage
from marketlake.plans.usage_rollup import UsagePaths, stored_feed_schema
from marketlake.schemas import AGENT_TOOL_CALLS, feed_of
from marketlake.streaming import usage_windows

START = datetime(2024, 3, 1)


def commit(spark, paths, version, hours):
    """One call per given hour after the start; failed ones with and without a message."""
    rows = [
        (f"{version}-{i}", START + timedelta(hours=h), f"u{i % 2}", f"tool{i % 3}", None, i % 2 == 0, "E" if i % 4 == 1 else None, 5,
         "delete" if i % 7 == 6 else "insert", version, START + timedelta(days=version))
        for i, h in enumerate(hours)
    ]
    feed = spark.createDataFrame(rows, feed_of(AGENT_TOOL_CALLS))
    changefeed.write_feed(feed, paths.calls, "timestamp")




@pytest.fixture
def paths(tmp_path):
    return UsagePaths(str(tmp_path / "calls"), str(tmp_path / "mutations"), str(tmp_path / "rollups"))


def run(spark, paths, **options):
    """Rows that the state operator dropped, and rows of state at the end."""
    dropped, held = 0, 0
    for query in usage_windows.start_window_stream(spark, paths, paths.rollup("_progress"), **options):
        query.awaitTermination()
        assert query.exception() is None
        for progress in query.recentProgress:
            for state in progress["stateOperators"]:
                dropped += state["numRowsDroppedByWatermark"]
                held = state["numRowsTotal"]
    return dropped, held


@pytest.mark.parametrize("files", [None, 1])
def test_late_rows_are_counted_and_state_is_dropped(spark, paths, rows, files):
    commits = [(1, [0, 1, 1, 2, 30]), (2, [29, 31, 32, 0, 0, 60]), (3, [61, 90, 5, 59, 1, 1, 1]), (4, [91, 200, 30, 0])]
    for version, hours in commits:
        commit(spark, paths, version, hours)
        dropped, held = run(spark, paths, files_per_batch=files)
        assert dropped == 0
        whole = spark.read.schema(stored_feed_schema(AGENT_TOOL_CALLS)).parquet(paths.calls)
        assert rows(usage_windows.hourly_stats(spark, paths)) == rows(usage.tool_calls_hourly(whole))
    behind = spark.read.parquet(paths.rollup("late_calls"))
    assert behind.count() > 5
    # Hours a day before the newest event are not kept in state.
    assert held <= 2
    run(spark, paths)
    assert rows(usage_windows.hourly_stats(spark, paths)) == rows(usage.tool_calls_hourly(whole))


def test_all_commits_in_one_run(spark, paths, rows):
    for version, hours in [(1, [0, 50]), (2, [1, 51]), (3, [2, 100])]:
        commit(spark, paths, version, hours)
    assert run(spark, paths)[0] == 0
    whole = spark.read.schema(stored_feed_schema(AGENT_TOOL_CALLS)).parquet(paths.calls)
    assert rows(usage_windows.hourly_stats(spark, paths)) == rows(usage.tool_calls_hourly(whole))
    assert spark.read.parquet(paths.rollup("late_calls")).agg(F.sum("call_count")).first()[0] == 2
