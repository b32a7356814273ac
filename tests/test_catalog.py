"""Every registered query against DuckDB, and what its plan must and must not contain."""

import contextlib
import io
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from marketlake.plans import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = catalog.registered()
ORACLES = oracles.statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in SOURCES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{FOLDER}/{name}.parquet'")
    return connection


def value(cell):
    if isinstance(cell, float):
        return "nan" if math.isnan(cell) else repr(cell)
    return repr(cell)


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


# Tested against the full search in test_lsh.
WITHOUT_SQL = {"knn_lsh"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) | WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = sorted(tuple(value(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(ORACLES[name])
    named = [d[0] for d in result.description]
    assert sorted(named) == columns
    places = [named.index(c) for c in columns]
    assert found == sorted(tuple(value(r[p]) for p in places) for r in result.fetchall())
    assert found

    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # Python is used for vectors only, on Arrow batches.
    assert "BatchEvalPython" not in plan and "FlatMapGroupsInPandas" not in plan


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "ticker" and df.count() > 0


@pytest.mark.parametrize("name", ["silver_prices", "bronze_news", "price_quote", "knn_batch", "notes_get"])
def test_rank_limits_are_cut_down_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["price_history", "price_period_summary", "compare_tickers", "bronze_prices"])
def test_date_bounds_reach_the_scan(spark, name):
    if name == "compare_tickers":  # its ranking step reads a written table; look at the bars
        plan = plan_of(catalog._bars_back(spark, FOLDER, 1))
    else:
        plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate" in plan


def test_unused_columns_are_not_read(spark):
    plan = plan_of(QUERIES["tool_calls_hourly"](spark, FOLDER))
    assert "value" not in plan.split("ReadSchema: ")[1].split("\n")[0]
