from datetime import date, datetime

import pytest

from marketlake.plans.medallion import Landed, run_embedding, run_medallion
from marketlake.schemas import (
    INDEX,
    AGENT_TOOL_CALLS, BRONZE_COMPANIES, BRONZE_NEWS, BRONZE_PRICES, DAILY_USAGE_STATS,
    DECLARED_TABLES,
)
from marketlake.session import work_root
from marketlake.sources import landing, tables


@pytest.fixture
def database(spark):
    name = "shop"
    tables.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_writes_count_their_rows(spark, database, rows):
    name = f"{database}.log"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert tables.overwrite(first, name) == 2
    assert tables.append(first.limit(1), name) == 1
    assert spark.table(name).count() == 3
    wider = first.selectExpr("id", "name", "id * 2 AS twice")
    assert tables.overwrite(wider, name) == 2
    assert rows(spark.table(name)) == [(1, "a", 2), (2, "b", 4)]


def test_declared_tables(spark, database):
    calls = f"{database}.agent_tool_calls"
    for _ in range(2):
        tables.create_table(spark, calls, AGENT_TOOL_CALLS)
    sample = [
        ("c-1", datetime(2024, 2, 3, 7, 30), "ann", "quote", "XX", True, None, 12),
        ("c-2", datetime(2024, 2, 3, 7, 31), "ben", "compare", None, False, "timed out", 5000),
        ("c-3", datetime(2024, 2, 4), "ann", "quote", "YY", False, None, 0),
    ]
    assert tables.append(spark.createDataFrame(sample, AGENT_TOOL_CALLS), calls) == 3
    assert spark.table(calls).dtypes == [(f.name, f.dataType.simpleString()) for f in AGENT_TOOL_CALLS]


def test_all_declared_tables(spark, database):
    for _ in range(2):
        tables.create_declared_tables(spark, database)
    names = {t.name for t in spark.catalog.listTables(database)}
    assert names == set(DECLARED_TABLES)


def test_only_touched_partitions_are_replaced(spark, database, tmp_path, rows):
    name = f"{database}.daily_usage_stats"
    tables.create_table(spark, name, DAILY_USAGE_STATS, ["date"])
    row = lambda day, user, n: (day, user, n, n, 0, 0, 0, 0, "t", datetime(2024, 1, 9))
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    frame = lambda *r: spark.createDataFrame(list(r), DAILY_USAGE_STATS)
    path = str(tmp_path / "stats")
    for write, read in (
        (lambda df: tables.overwrite_table_partitions(df, name), lambda: spark.table(name)),
        (lambda df: tables.overwrite_partitions(df, path, ["date"]), lambda: spark.read.parquet(path)),
    ):
        assert write(frame(row(one, "u", 1), row(two, "u", 1), row(two, "v", 1))) == 3
        assert write(frame(row(two, "u", 5))) == 1
        assert rows(read(), "date", "user_id", "total_tool_calls") == [(one, "u", 1), (two, "u", 5)]


def test_profile(spark, rows):
    frame = spark.createDataFrame([(1, [1.0])], "id bigint, v array<float>")
    assert rows(tables.profile(frame, "t"), "table_name", "row_count", "position", "column_name", "data_type") == [
        ("t", 1, 1, "id", "bigint"), ("t", 1, 2, "v", "array<float>"),
    ]


def test_work_root_is_the_shared_folder_of_the_session(spark):
    assert work_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_whole_etl(spark, database, rows, tmp_path):
    landed = Landed(
        spark.createDataFrame(
            [("AA", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10), ("AA", "2024-01-02", 1.0, 2.0, 0.5, 1.6, 10),
             ("BB", "2020-01-02", 1.0, 2.0, 0.5, 1.5, 10), ("ZZ", "2024-01-02", 1.0, 2.0, 0.5, 1.5, 10)],
            BRONZE_PRICES,
        ),
        spark.createDataFrame([("AA", "Alpha", "s", "i", 5, "d", "w", 3, "c", None)], BRONZE_COMPANIES),
        spark.createDataFrame([("AA", "t", "s", 5, "u", None, "c"), ("AA", "t", "s", 6, "u", None, "c2")], BRONZE_NEWS),
    )
    written = run_medallion(
        spark, database, landed, datetime(2024, 1, 31), tickers=["aa", "bb", "CC"], price_days=365, articles=50
    )
    assert written == {
        "bronze_prices": 2, "bronze_companies": 1, "bronze_news": 2,
        "silver_prices": 1, "silver_companies": 1, "silver_news": 2,
        "quarantine": 0, "ingest_report": 9,
    }
    report = spark.table(f"{database}.ingest_report").filter("source = 'prices'")
    assert rows(report, "ticker", "rows", "status") == [("AA", 2, "ok"), ("BB", 1, "ok"), ("CC", 0, "missing")]
    everything = run_medallion(spark, database, landed, datetime(2024, 1, 31))
    assert (everything["bronze_prices"], everything["silver_prices"]) == (4, 3)
    path = str(tmp_path / "index")
    assert run_embedding(spark, database, path) == 2
    assert run_embedding(spark, database, path) == 2
    index = tables.read_version(spark, path, INDEX)
    assert rows(index, "doc_id", "text") == [("AA", "Alpha\n\nSector: s\n\nIndustry: i\n\nd"), ("AA | t", "t\n\nt\n\nc2")]


def test_etl_from_landed_json(spark, database, tmp_path, rows):
    def land(name, schema, *lines):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part-0.json").write_text("\n".join(lines))
        return landing.read_landed(spark, str(folder), schema)

    landed = Landed(
        land("prices", BRONZE_PRICES, '{"ticker": "AA", "date": "2024-01-02", "close": 1.5}', "{broken"),
        land("companies", BRONZE_COMPANIES, '{"ticker": "AA", "name": "Alpha"}', '{"ticker": "AA", "marketCap": "x"}'),
        land("news", BRONZE_NEWS, '{"ticker": "AA", "title": "t", "publishedAt": 5}'),
    )
    written = run_medallion(spark, database, landed, datetime(2024, 1, 31))
    assert written == {
        "bronze_prices": 1, "bronze_companies": 1, "bronze_news": 1,
        "silver_prices": 1, "silver_companies": 1, "silver_news": 1,
        "quarantine": 2, "ingest_report": 5,
    }
    assert rows(spark.table(f"{database}.quarantine"), "source", "record") == [
        ("companies", '{"ticker": "AA", "marketCap": "x"}'), ("prices", "{broken"),
    ]
    corrupt = spark.table(f"{database}.ingest_report").filter("status = 'corrupt'")
    assert rows(corrupt, "source", "rows") == [("companies", 1), ("prices", 1)]
    assert rows(spark.table(f"{database}.bronze_companies"), "ticker", "name", "sector") == [("AA", "Alpha", "Unknown")]


def test_nothing_landed_writes_nothing(spark, database):
    empty = Landed(*(spark.createDataFrame([], s) for s in (BRONZE_PRICES, BRONZE_COMPANIES, BRONZE_NEWS)))
    assert run_medallion(spark, database, empty, datetime(2024, 1, 31)) == {"quarantine": 0, "ingest_report": 0}


def test_a_versioned_table_can_be_made_from_itself(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), "id long"
    frame = spark.createDataFrame([], schema)
    assert tables.read_version(spark, path, frame.schema).count() == 0
    assert tables.write_version(spark.range(3), path) == 3
    before = tables.read_version(spark, path, frame.schema)
    assert tables.write_version(before.selectExpr("id + 1 AS id").unionByName(before), path) == 6
    assert before.count() == 3
    assert rows(tables.read_version(spark, path, frame.schema)) == [(0,), (1,), (1,), (2,), (2,), (3,)]
