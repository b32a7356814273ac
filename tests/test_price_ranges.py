import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.operators import price_ranges

BARS = "ticker string, snapshot_date date, open_price decimal(12,4), close_price decimal(12,4), high_price decimal(12,4), low_price decimal(12,4), volume long"


@pytest.fixture(scope="module")
def bars():
    chance = random.Random(2)
    made = []
    for ticker in ("AA", "BB"):
        for n in range(500):
            if chance.random() < 0.6:
                close = Decimal(chance.randrange(1, 10**6)) / 100
                made.append((ticker, date(2020, 1, 20) + timedelta(n), close, close, close + 1, close - 1, chance.randrange(100)))
    return made


def brute(bars, requests):
    found = []
    for number, ticker, since, until in requests:
        rows = [] if None in (ticker, since, until) else [b for b in bars if b[0] == ticker.upper() and since <= b[1] < until]
        if rows:
            first, last = float(rows[0][3]), float(rows[-1][3])
            mean = round(sum(b[6] for b in rows) / len(rows), 4)
            change = pytest.approx(round((last - first) * 100 / first, 4), abs=1e-4)
            found.append((number, ticker.upper(), rows[0][1], rows[-1][1], len(rows), first, last, float(max(b[4] for b in rows)), float(min(b[5] for b in rows)), mean, change))
    return found


def asked():
    chance = random.Random(4)
    start = date(2020, 1, 1)
    requests = [(i, chance.choice(["aa", "BB", "CC"]), start + timedelta(chance.randrange(520)), start + timedelta(chance.randrange(560))) for i in range(150)]
    months = [date(2020, m, 1) for m in range(1, 13)]
    requests += [(200 + i, "AA", a, b) for i, (a, b) in enumerate((x, y) for x in months[:4] for y in months[:6])]
    requests += [(300, "AA", date(2020, 2, 10), date(2020, 2, 20)), (301, "AA", date(2020, 2, 10), date(2020, 3, 1)), (302, "AA", date(2020, 2, 29), date(2020, 3, 2))]
    return [*requests, (400, None, start, start), (401, "AA", None, date(2021, 1, 1)), (402, "AA", start, None), (403, "AA", date(2021, 1, 1), start)]


def test_ranges_against_bars(spark, bars, rows):
    frame, requests = spark.createDataFrame(bars, BARS), asked()
    wanted = spark.createDataFrame(requests, "request_id int, ticker string, since date, until date")
    found = price_ranges.summaries(wanted, price_ranges.month_blocks(frame), frame)
    assert rows(found) == brute(bars, requests)


def test_changed_months_are_made_anew(spark, bars, rows):
    frame = spark.createDataFrame(bars, BARS)
    before = frame.filter("snapshot_date < '2020-12-15' or ticker = 'BB'")
    blocks = price_ranges.month_blocks(before)
    late = frame.filter("snapshot_date >= '2020-12-15' and ticker = 'AA'").select("ticker", price_ranges.month_of(F.col("snapshot_date")).alias("month"))
    assert rows(price_ranges.refreshed_blocks(blocks, frame, late)) == rows(price_ranges.month_blocks(frame))


def test_only_edges_are_read_from_bars(spark, bars):
    """A range of whole months meets no bar."""
    frame = spark.createDataFrame(bars, BARS)
    wanted = spark.createDataFrame([(1, "AA", date(2020, 3, 1), date(2020, 9, 1))], "request_id int, ticker string, since date, until date")
    blocks = price_ranges.month_blocks(frame)
    assert price_ranges.summaries(wanted, blocks, frame.limit(0)).first()["bars"] == sum(b[0] == "AA" and 3 <= b[1].month < 9 and b[1].year == 2020 for b in bars)


def test_requests_are_not_broadcast(spark, bars, capsys):
    """A request is listed once per month: what Spark takes for small is not."""
    held = spark.createDataFrame(bars, BARS)
    requests = spark.range(1000).selectExpr("id AS request_id", "'aa' AS ticker", "DATE '2020-01-05' AS since", "DATE '2021-05-20' AS until")
    found = price_ranges.summaries(requests, price_ranges.month_blocks(held), held)
    found.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert found.count() == 1000
