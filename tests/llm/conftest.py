import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text[, lang[, source]]), with columns whose names operators use
    for themselves."""

    def frame(*rows):
        full = [(*row, *[None] * (4 - len(row)), 0) for row in rows]
        named = spark.createDataFrame(full, DOCUMENTS)
        clashing = ("row", "size", "digest", "key", "kept", "start", "position", "class", "held")
        return named.withColumns({name: F.lit("clash") for name in clashing})

    return frame
