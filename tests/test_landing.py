import json
from datetime import date

from marketlake.schemas import BRONZE_COMPANIES, BRONZE_NEWS, BRONZE_PRICES
from marketlake.sources import landing


def write_lines(path, lines):
    path.mkdir()
    (path / "part-0.json").write_text("\n".join(lines))
    return str(path)


def test_json_with_a_broken_record(spark, tmp_path, rows):
    good = {"ticker": "AA", "date": "2024-01-02", "open": 1, "high": 2, "low": 1, "close": 1.5, "volume": 7}
    path = write_lines(tmp_path / "prices", [json.dumps(good), "{broken", json.dumps({**good, "ticker": "BB"})])
    landed = landing.read_landed(spark, path, BRONZE_PRICES)
    broken = landed.filter("_corrupt_record IS NOT NULL").select("ticker", "_corrupt_record")
    assert rows(broken) == [(None, "{broken")]
    assert rows(landing.parsed(landed), "ticker", "close") == [("AA", 1.5), ("BB", 1.5)]


def test_csv_and_parquet(spark, tmp_path, rows):
    frame = spark.createDataFrame([("AA", "2024-01-02", 1.0, 2.0, 1.0, 1.5, 7)], BRONZE_PRICES)
    frame.write.parquet(str(tmp_path / "p"))
    frame.write.option("header", "true").csv(str(tmp_path / "c"))
    for fmt, path, options in (("parquet", "p", {}), ("csv", "c", {"header": "true"})):
        landed = landing.read_landed(spark, str(tmp_path / path), BRONZE_PRICES, fmt, **options)
        assert rows(landing.parsed(landed)) == rows(frame)


def test_prices_of_the_trailing_days(spark, rows):
    frame = spark.createDataFrame(
        [("AA", d, 1.0, 1.0, 1.0, 1.0, 1) for d in ("2023-01-30", "2023-01-31", "2024-01-30", "2024-01-31")]
        + [("BB", "2024-01-30", 1.0, 1.0, 1.0, 1.0, 1)],
        BRONZE_PRICES,
    )
    found = landing.bronze_prices(frame, date(2024, 1, 31), tickers=["aa"])
    assert rows(found, "ticker", "date") == [("AA", "2023-01-31"), ("AA", "2024-01-30")]


def test_company_defaults(spark):
    frame = spark.createDataFrame([("AA",) + (None,) * 9], BRONZE_COMPANIES)
    assert tuple(landing.bronze_companies(frame).first()) == (
        "AA", "AA", "Unknown", "Unknown", 0, "", "", 0, "", "USD",
    )


def test_news_defaults_and_limit(spark, rows):
    frame = spark.createDataFrame(
        [("AA", "t1", None, 3, "u1", None, None), ("AA", "t2", "s", 2, "u2", "m", "c"),
         ("AA", None, "s", None, None, None, None), ("BB", "t4", "s", 1, "u4", None, "c")],
        BRONZE_NEWS,
    )
    assert rows(landing.bronze_news(frame, limit=2), "ticker", "title", "source", "summary", "content") == [
        ("AA", "t1", "Yahoo Finance", "t1", "t1"), ("AA", "t2", "s", "m", "c"), ("BB", "t4", "s", "t4", "c"),
    ]
    assert landing.bronze_news(frame, limit=None).count() == 4
    assert rows(landing.bronze_news(frame, limit=None).filter("publishedAt = 0"), "title", "url") == [("", "")]


def test_report_names_missing_tickers(spark, rows):
    asked = spark.createDataFrame([("AA",), ("CC",)], "ticker string")
    landed = spark.createDataFrame([("AA",), ("AA",), ("BB",)], "ticker string")
    assert rows(landing.ingest_report(asked, landed, "prices")) == [
        ("prices", "AA", 2, "ok"), ("prices", "CC", 0, "missing"),
    ]
