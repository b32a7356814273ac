"""WARC archives without repeated payloads, and reading them back.

Headers (page, url, length and digest of the payload) are taken from the pages and shuffled by
digest; of equal payloads that are long enough the one with the largest page id is written as
a response and every other one as a revisit that refers to it. Responses take their payloads
from the pages, revisits need no payload. All headers are written anew.

Archives are plain WARC/1.1 files: a text table whose rows are records and whose line
separator is the blank line that ends a record, so any file system Spark knows will do. A
file has at most `FILE_BYTES` of payload, as far as single pages allow, and is read in one
piece.

Pages may be very long: one above the largest size class has a file of its own. A null payload
counts as empty. Payloads below `min_bytes` are always responses. A null url
leaves its header out. Rows that repeat page id and payload give one response and revisits to
it; of short payloads each row gives a response, with the same record id. A null page id is
smaller than any other. Empty tables give an empty archive; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.keys import attach
from marketlake.session import fresh_path, materialize

MIN_BYTES = 1000
FILE_BYTES = 256 << 20
# Where classes of record sizes end.
SIZE_CLASSES = (64 << 10, 1 << 20, 16 << 20, 256 << 20)
WRITTEN_AT = "2024-01-01T00:00:00Z"
LINE = "\r\n"
RECORD_END = "\r\n\r\n"
GROUP_BYTES = 128

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_ID = "X-Page-ID"

PARSED = (
    "record_type string, record_id string, page_id long, url string, payload_bytes long, "
    "payload_digest string, refers_to_record string, payload binary"
)


class Headers(NamedTuple):
    """One row per page; groups: digest, keep_id, keep_row, same (rows with that id)."""

    rows: DataFrame
    groups: DataFrame


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def _digest() -> Column:
    return F.sha1(_payload().cast("binary"))


def headers(pages: DataFrame, min_bytes: int = MIN_BYTES) -> Headers:
    """Headers of all pages and the groups of equal payloads, by partial aggregates."""
    rows = pages.select(
        "page_id", "url", F.octet_length(_payload()).cast("long").alias("bytes"), _digest().alias("digest")
    )
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "warc-headers")
    per_page = rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "page_id")
    per_page = per_page.agg(F.max("row").alias("row"), F.count("*").alias("same"))
    best = F.max(F.struct("page_id", "row", "same")).alias("best")
    groups = per_page.groupBy("digest").agg(best, F.sum("same").alias("n")).filter("n > 1")
    groups = groups.select(
        "digest",
        F.col("best.page_id").alias("keep_id"),
        F.col("best.row").alias("keep_row"),
        F.col("best.same").alias("same"),
    )
    return Headers(rows, materialize(groups, "warc-groups"))


# Writing -----------------------------------------------------------------------------------


def _record_id(kind: str, *parts: Column) -> Column:
    name = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    pieces = [F.substring(name, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(
        F.lit(VERSION + LINE),
        *[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit("")) for name, value in fields],
        F.lit(LINE),
    )


def _url() -> Column:
    """The url in one line."""
    return F.regexp_replace("url", r"[\r\n]", " ")


def _http(length: Column) -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        length.cast("string"),
        F.lit(LINE + LINE),
    )


def _responses(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """Pages whose payload is written; payloads move only where the groups are too many to send."""
    rows = pages.select("page_id", "url", _payload().alias("html"), _digest().alias("digest"))
    known = groups.withColumnRenamed("digest", "_digest").select("_digest", "keep_id", "same")
    named = attach(
        rows.withColumn("_digest", F.col("digest")),
        known,
        ["_digest"],
        spread=["page_id"],
        row_bytes=GROUP_BYTES,
        how="left",
    )
    stay = named.filter(F.col("same").isNull() | F.col("page_id").eqNullSafe(F.col("keep_id")))
    once = F.coalesce(F.col("same") > 1, F.lit(False))
    columns = ["page_id", "url", "html", "digest"]
    return stay.filter(~once).select(*columns).unionByName(
        stay.filter(once).dropDuplicates(["_digest"]).select(*columns)
    )


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, written_at: str = WRITTEN_AT
) -> None:
    """Write pages (page_id, url, html) as archives into a new folder."""
    found = headers(pages, min_bytes)
    length = F.octet_length("html")
    http = _http(length)
    response = _lines(
        ("WARC-Type", F.lit("response")),
        ("WARC-Record-ID", _record_id("response", F.col("page_id"), F.col("digest"))),
        ("WARC-Date", F.lit(written_at)),
        ("WARC-Target-URI", _url()),
        (PAGE_ID, F.col("page_id").cast("string")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", (F.octet_length(http) + length).cast("string")),
    )
    responses = _responses(pages, found.groups).select(
        F.concat(response, http, "html").alias("value"), F.octet_length("html").alias("size")
    )

    group = found.groups.drop("same")
    repeats = attach(found.rows, group, ["digest"], spread=["row"], row_bytes=GROUP_BYTES)
    repeats = repeats.filter(F.col("row") != F.col("keep_row"))
    http = _http(F.col("bytes"))
    revisit = _lines(
        ("WARC-Type", F.lit("revisit")),
        ("WARC-Record-ID", _record_id("revisit", F.col("page_id"), F.col("digest"), F.col("row"))),
        ("WARC-Date", F.lit(written_at)),
        ("WARC-Target-URI", _url()),
        (PAGE_ID, F.col("page_id").cast("string")),
        ("WARC-Profile", F.lit(REVISIT_PROFILE)),
        ("WARC-Refers-To", _record_id("response", F.col("keep_id"), F.col("digest"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("Content-Type", F.lit("application/http; msgtype=response")),
        ("Content-Length", F.octet_length(http).cast("string")),
    )
    revisits = repeats.select(F.concat(revisit, http).alias("value"), F.lit(0).alias("size"))
    _write_by_size(responses.unionByName(revisits), found.rows, path)


def _write_by_size(values: DataFrame, rows: DataFrame, path: str) -> None:
    """Records (value, size of the payload) into files of at most about `FILE_BYTES`, by classes
    of size.

    Files are cut after a number of records that their class allows, so that one long page
    makes a file of its own and leaves the files of the others as they are.
    """
    bounds = list(zip((0, *SIZE_CLASSES), (*SIZE_CLASSES, None)))

    def within(size: str, low: int, high: int | None) -> Column:
        return F.col(size) >= low if high is None else F.col(size).between(low, high - 1)

    present = rows.agg(*[F.count_if(within("bytes", *bound)) for bound in bounds]).first()
    for i, (low, high) in enumerate(bounds):
        # Revisits are in the first class.
        if i == 0 or present[i]:
            part = values.filter(within("size", low, high)).select("value")
            records = 1 if high is None else max(1, FILE_BYTES // high)
            writer = part.write.mode("append").option("lineSep", RECORD_END).option("maxRecordsPerFile", records)
            writer.option("compression", "none").text(path)


# Reading -----------------------------------------------------------------------------------


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive."""
    at = 0
    while at < len(archive):
        end = archive.find(b"\r\n\r\n", at)
        lines = archive[at:end].decode().split(LINE)
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it should")
        yield fields, archive[start:stop]
        at = stop + 4


def _parsed(fields: dict[str, str], block: bytes) -> tuple:
    """A row of `PARSED`; the payload of a response is held against its digest."""
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in head.decode().split(LINE) if x.startswith("Content-Length: ")).split(": ")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (
        len(payload) != length or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    page = fields.get(PAGE_ID)
    return (
        fields["WARC-Type"],
        fields["WARC-Record-ID"],
        int(page) if page is not None else None,
        fields.get("WARC-Target-URI"),
        length,
        digest,
        fields.get("WARC-Refers-To"),
        payload if fields["WARC-Type"] == "response" else None,
    )


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of a folder of archives, with the columns of `PARSED`."""
    chosen = PARSED if payloads else PARSED.removesuffix(", payload binary")
    names = [c.split(" ")[0] for c in chosen.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                columns: list[list] = [[] for _ in names]
                for fields, block in records(content.as_py()):
                    for column, value in zip(columns, _parsed(fields, block)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=names
                )

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, chosen)


def resolved(parsed: DataFrame) -> DataFrame:
    """Records with `refers_to`, the page of the response that a revisit refers to."""
    asked = parsed.filter("record_type = 'revisit'").groupBy("refers_to_record").agg(F.lit(1).alias("asked"))
    originals = parsed.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to")
    )
    known = materialize(originals.join(asked.drop("asked"), "refers_to_record"), "warc-originals")
    revisits = parsed.filter("record_type = 'revisit'")
    found = attach(revisits, known, ["refers_to_record"], spread=["record_id"], row_bytes=GROUP_BYTES, how="left")
    others = parsed.filter("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return found.unionByName(others)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the pages, read the archives back, and resolve the revisits."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return resolved(materialize(read_archives(spark, path, payloads=False), "warc-records"))
