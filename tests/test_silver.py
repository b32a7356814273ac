from datetime import date, datetime
from decimal import Decimal

from marketlake.operators import silver
from marketlake.schemas import BRONZE_COMPANIES, BRONZE_NEWS, BRONZE_PRICES

NOW = datetime(2024, 1, 31)


def bars(spark, *values):
    full = [(t, d, c, c, c, c, v) for t, d, c, v in values]
    return spark.createDataFrame(full, BRONZE_PRICES)


def test_prices_are_typed_and_bad_values_become_null(spark, rows):
    frame = bars(
        spark,
        ("AA", "2024-01-02", 10.25, 5),
        ("AA", "not a date", 11.0, 5),
        ("AA", None, 11.0, 5),
        ("AA", "2024-01-03", float("nan"), 5),
        ("BB", "2024-01-03", 1e12, None),
    )
    result = rows(silver.clean_prices(frame), "ticker", "snapshot_date", "close_price", "volume")
    assert result == [
        ("AA", date(2024, 1, 2), Decimal("10.2500"), 5),
        ("AA", date(2024, 1, 3), None, 5),
        ("BB", date(2024, 1, 3), None, None),
    ]


def test_one_bar_per_day_prefers_a_usable_close(spark, rows):
    frame = bars(
        spark,
        ("AA", "2024-01-02", float("nan"), 1),
        ("AA", "2024-01-02", 1e12, 2),
        ("AA", "2024-01-02", 9.0, 3),
        ("AA", "2024-01-02", 8.0, 4),
    )
    assert rows(silver.clean_prices(frame), "close_price", "volume") == [(Decimal("9.0000"), 3)]


def test_last_landed_bar_wins(spark, rows):
    frame = bars(spark, ("AA", "2024-01-02", 9.0, 1), ("AA", "2024-01-02", 8.0, 2))
    numbered = frame.selectExpr("*", "volume AS landing")
    assert rows(silver.clean_prices(numbered, ["landing"]), "close_price") == [(Decimal("8.0000"),)]


def test_companies_keep_the_latest_landing(spark, rows):
    frame = spark.createDataFrame(
        [
            ("AA", "Old", None, "x", 1, "d", "", 1, "", "USD"),
            ("AA", "New", "s", "x", 2, None, "", 1, "", "USD"),
            ("BB", "Only", None, None, None, None, None, None, None, None),
        ],
        BRONZE_COMPANIES,
    ).selectExpr("*", "CASE name WHEN 'New' THEN 2 ELSE 1 END AS landing")
    result = silver.clean_companies(frame, NOW, ["landing"])
    assert rows(result, "ticker", "company_name", "market_cap", "updated_at") == [
        ("AA", "New", 2, NOW), ("BB", "Only", None, NOW),
    ]


def test_news_keeps_blank_titles_and_repeats(spark, rows):
    frame = spark.createDataFrame(
        [
            ("AA", "", "s", 0, "u", "m", "c"),
            ("AA", None, "s", 5, "u", "m", "c"),
            ("AA", "t", "s", 1704067200, "u", "m", "c"),
            ("AA", "t", "s", 1704067200, "u", "m", "c"),
        ],
        BRONZE_NEWS,
    )
    result = silver.clean_news(frame, NOW)
    assert rows(result, "title", "published_at") == [
        ("", datetime(1970, 1, 1)), ("t", datetime(2024, 1, 1)), ("t", datetime(2024, 1, 1)),
    ]


def test_empty_input_gives_empty_tables(spark):
    assert silver.clean_prices(bars(spark)).count() == 0
    assert silver.clean_news(spark.createDataFrame([], BRONZE_NEWS), NOW).count() == 0
