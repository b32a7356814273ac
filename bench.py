"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of the tables), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query, after one warm-up), BENCH_QUERIES (comma-separated names instead of
the headline set, or `all`).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from marketlake.plans.catalog import registered
from marketlake.session import build_session

HEADLINE = (
    "silver_prices",
    "silver_companies",
    "silver_news",
    "price_history",
    "price_quote",
    "price_period_summary",
    "compare_tickers",
    "company_fundamentals",
    "price_range_summary",
    "text_corpus",
    "embed_corpus",
    "embed_incremental",
    "index_refresh",
    "knn_topk",
    "knn_batch",
    "knn_by_ticker",
    "knn_indexed",
    "knn_many_queries",
    "knn_lsh",
    "index_reopened",
    "semantic_search",
    "semantic_search_indexed",
    "chat_search",
    "news_for_ticker",
    "watchlist_get",
    "watchlist_add",
    "watchlist_remove",
    "watchlist_replay",
    "watchlist_store_add",
    "notes_save",
    "notes_get",
    "snapshot_diff",
    "tool_calls_hourly",
    "watchlist_daily",
    "daily_usage_stats",
    "usage_last_7_days",
    "usage_incremental",
    "usage_lagging_feed",
    "usage_by_deltas",
    "usage_stream",
    "chat_route",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    queries = registered()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = build_session("bench", f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 4)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
