from datetime import date
from decimal import Decimal

import pytest

from marketlake.operators import keys, prices
from marketlake.schemas import QUOTE_SNAPSHOT, SILVER_COMPANIES, SILVER_PRICES

TODAY = date(2024, 3, 31)


def bars(spark, *values):
    full = []
    for ticker, day, close, volume in values:
        price = None if close is None else Decimal(str(close))
        high = None if price is None else price + 1
        low = None if price is None else price - 1
        full.append((ticker, day, price, price, high, low, volume))
    return spark.createDataFrame(full, SILVER_PRICES)


def companies(spark, *values):
    return spark.createDataFrame([(t, n, None, None, m, None, None) for t, n, m in values], SILVER_COMPANIES)


def test_look_back_months():
    assert [prices.summary_months(d) for d in (1, 30, 31, 90, 91, 400)] == [1, 1, 3, 3, 6, 6]
    assert [prices.comparison_months(d) for d in (30, 31, 400)] == [1, 3, 3]


def test_quote_uses_the_two_newest_bars(spark, rows):
    frame = bars(
        spark,
        ("AA", date(2024, 3, 28), 10, 5), ("AA", date(2024, 3, 29), 12, 6), ("AA", date(2024, 1, 1), 99, 1),
        ("BB", date(2024, 3, 29), 5, None),
        ("CC", date(2024, 3, 28), 0, 1), ("CC", date(2024, 3, 29), 7, 1),
        ("DD", date(2024, 3, 28), 4, 1), ("DD", date(2024, 3, 29), None, 1),
    )
    quote = prices.price_quote(frame, companies(spark, ("AA", "Alpha", 100)))
    assert rows(quote, "ticker", "name", "price", "previous_close", "change", "change_pct", "volume", "market_cap") == [
        ("AA", "Alpha", 12.0, 10.0, 2.0, 20.0, 6, 100),
        ("BB", "BB", 5.0, None, 0.0, 0.0, 0, 0),
        ("CC", "CC", 7.0, 0.0, 0.0, 0.0, 1, 0),
        ("DD", "DD", None, 4.0, 0.0, 0.0, 1, 0),
    ]
    panel = prices.dashboard_quote(frame, companies(spark, ("AA", "Alpha", 100)))
    assert rows(panel, "ticker", "price", "day_high", "day_low") == [
        ("AA", 12.0, 13.0, 11.0), ("BB", 5.0, 6.0, 4.0), ("CC", 7.0, 8.0, 6.0), ("DD", 0.0, 0.0, 0.0),
    ]


def test_quote_from_a_snapshot(spark, rows):
    frame = spark.createDataFrame(
        [
            ("AA", "Alpha", 12.0, 11.0, 10.0, None, None, 13.0, 9.0, 5, 100),
            ("BB", None, None, 11.0, None, 1.5, 3.0, None, None, None, None),
        ],
        QUOTE_SNAPSHOT,
    )
    quote = prices.quote_from_snapshot(frame)
    assert rows(quote, "ticker", "name", "price", "change", "change_pct", "volume", "day_high") == [
        ("AA", "Alpha", 12.0, 2.0, 20.0, 5, 13.0), ("BB", "BB", 11.0, 1.5, 3.0, 0, 0.0),
    ]


def test_history_is_half_open_and_ordered(spark):
    frame = bars(
        spark, ("AA", date(2024, 1, 2), 2, 1), ("AA", date(2024, 1, 1), 1, 1), ("AA", date(2024, 1, 3), 3, 1),
        ("BB", date(2024, 1, 1), 4, 1),
    )
    found = prices.price_history(frame, date(2024, 1, 1), date(2024, 1, 3), "aa")
    assert [(r["date"], r["close"]) for r in found.collect()] == [(date(2024, 1, 1), 1.0), (date(2024, 1, 2), 2.0)]
    assert prices.price_history(frame, date(2024, 1, 1), date(2024, 1, 3)).count() == 3


def test_period_summary(spark, rows):
    frame = bars(
        spark,
        ("AA", date(2024, 2, 28), 50, 1),  # before the month
        ("AA", date(2024, 3, 1), 10, 4), ("AA", date(2024, 3, 15), 30, 5), ("AA", date(2024, 3, 28), 15, 6),
        ("BB", date(2024, 3, 2), 0, 1), ("BB", date(2024, 3, 3), 5, 1),
        ("CC", date(2023, 3, 2), 1, 1),
    )
    summary = prices.price_period_summary(frame, TODAY, days=30)
    columns = ["ticker", "from_date", "to_date", "bars", "start_price", "end_price", "high", "low",
               "avg_volume", "change_pct"]
    assert rows(summary, *columns) == [
        ("AA", date(2024, 3, 1), date(2024, 3, 28), 3, 10.0, 15.0, 31.0, 9.0, 5.0, 50.0),
        ("BB", date(2024, 3, 2), date(2024, 3, 3), 2, 0.0, 5.0, 6.0, -1.0, 1.0, None),
    ]


def test_comparison_keeps_request_order_on_ties(spark):
    day = [date(2024, 3, 20), date(2024, 3, 28)]
    frame = bars(
        spark,
        ("AA", day[0], 10, 1), ("AA", day[1], 20, 1), ("BB", day[0], 10, 1), ("BB", day[1], 30, 1),
        ("CC", day[0], 5, 1), ("CC", day[1], 10, 1), ("DD", date(2020, 1, 1), 1, 1), ("EE", day[0], 1, 1),
    )
    ranked = prices.compare_tickers(
        frame, companies(spark, ("CC", "C", 7)), TODAY, tickers=["cc", "dd", "aa", "bb"]
    )
    assert [tuple(r) for r in ranked.collect()] == [
        (1, "BB", 30.0, 200.0, 0), (2, "CC", 10.0, 100.0, 7), (3, "AA", 20.0, 100.0, 0),
    ]


def test_comparison_of_one_ticker_is_refused(spark):
    with pytest.raises(ValueError):
        prices.compare_tickers(bars(spark), companies(spark), TODAY, tickers=["AA", "aa"])


def test_fundamentals(spark, rows):
    profiles = spark.createDataFrame(
        [("AA", "Alpha", None, "i", 5, "x" * 600, 3, 12.5, 0.0123), ("BB", None, "s", None, None, None, None, None, None)],
        "ticker string, name string, sector string, industry string, marketCap bigint, description string, "
        "employees bigint, trailingPE double, dividendYield double",
    )
    frame = bars(spark, ("AA", date(2024, 1, 1), 10, 1), ("AA", date(2022, 1, 1), 99, 1))
    result = prices.company_fundamentals(profiles, frame, TODAY)
    columns = ["ticker", "name", "sector", "industry", "market_cap", "trailing_pe", "forward_pe",
               "dividend_yield_pct", "high_52_weeks", "low_52_weeks", "description"]
    assert rows(result, *columns) == [
        ("AA", "Alpha", "N/A", "i", 5, 12.5, None, 1.23, 11.0, 9.0, "x" * 500),
        ("BB", "BB", "s", "N/A", 0, None, None, 0.0, None, None, "No description available"),
    ]


def test_global_position_counts_through(spark):
    frame = spark.range(0, 1000, numPartitions=7).selectExpr("id", "id % 3 AS third")
    import pyspark.sql.functions as F

    placed = keys.global_position(frame, [F.desc("third"), F.asc("id")], "place").collect()
    expected = sorted(range(1000), key=lambda i: (-(i % 3), i))
    assert [r["id"] for r in sorted(placed, key=lambda r: r["place"])] == expected
    assert sorted(r["place"] for r in placed) == list(range(1, 1001))
