import hashlib

import pytest
from pyspark.sql import functions as F

from marketlake.llm import warc
from marketlake.session import fresh_path

LONG = "x" * 1200
TRICKY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + LONG


@pytest.fixture
def pages(spark):
    rows = [
        (1, "u", LONG),
        (2, None, LONG),
        (2, None, LONG),
        (3, "a\r\nWARC-Type: x", "é" * 700),
        (4, "", None),
        (5, "s", "short"),
        (6, "s", "short"),
        (None, "n", LONG),
        (7, "t", TRICKY),
        (8, "t", TRICKY),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return frame.withColumn("digest", F.lit("clash")).withColumn("row", F.lit(0))


def test_round_trip(pages, rows):
    found = rows(warc.round_trip(pages), "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")

    def digest(text):
        return hashlib.sha1(text.encode()).hexdigest()

    long, tricky, short = digest(LONG), digest(TRICKY), digest("short")
    assert found == [
        (None, "revisit", 2, 1200, long),
        (1, "revisit", 2, 1200, long),
        (2, "response", None, 1200, long),
        (2, "revisit", 2, 1200, long),
        (3, "response", None, 1400, digest("é" * 700)),
        (4, "response", None, 0, digest("")),
        (5, "response", None, 5, short),
        (6, "response", None, 5, short),
        (7, "revisit", 8, len(TRICKY), tricky),
        (8, "response", None, len(TRICKY), tricky),
    ]


def test_archives_hold_each_long_payload_once(spark, pages):
    path = fresh_path(spark, "warc-test")
    warc.write_archives(pages, path)
    read = warc.read_archives(spark, path).filter("payload_bytes >= 1000").collect()
    payloads = [bytes(r["payload"]).decode() for r in read if r["payload"] is not None]
    assert sorted(payloads) == sorted([LONG, TRICKY, "é" * 700])
    responses = {r["record_id"]: r for r in read if r["record_type"] == "response"}
    for r in read:
        if r["record_type"] == "revisit":
            assert responses[r["refers_to_record"]]["payload_digest"] == r["payload_digest"]


def test_many_files(spark, pages, rows, monkeypatch):
    whole = rows(warc.round_trip(pages), "page_id", "record_type", "refers_to")
    monkeypatch.setattr(warc, "FILE_BYTES", 1)
    assert rows(warc.round_trip(pages), "page_id", "record_type", "refers_to") == whole


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.records(b"nonsense"))
    with pytest.raises(ValueError):
        list(warc.records(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"))
    head = {"WARC-Type": "response", "WARC-Record-ID": "<x>", "WARC-Payload-Digest": "sha1:00"}
    with pytest.raises(ValueError):
        warc._parsed(head, b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\na")


def test_empty_table(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_one_long_page_leaves_the_others_together(spark, tmp_path):
    rows = [(i, f"u{i}", f"{i} " + "x" * 1200) for i in range(400)] + [(1000, "long", "y" * (20 << 20)), (1001, "long", "y" * (20 << 20))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(pages, str(tmp_path / "w"))
    files = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part") and f.stat().st_size]
    assert len(files) <= 6
    found = warc.read_archives(spark, str(tmp_path / "w")).filter("page_id >= 1000").collect()
    assert sorted((r["page_id"], r["record_type"], r["payload_bytes"]) for r in found) == [(1000, "revisit", 20 << 20), (1001, "response", 20 << 20)]
