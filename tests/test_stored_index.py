import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import changefeed, search, stored_index

DIM = 8
COLUMNS = ["query_id", "rank", "doc_id", "score"]


def frame(spark, vectors, first=0):
    rows = [
        (first + i, "news" if i % 3 else "company_profile", f"T{i % 40}", [float(x) for x in v])
        for i, v in enumerate(vectors)
    ]
    return spark.createDataFrame(rows, "doc_id bigint, doc_type string, ticker string, embedding array<float>").repartition(5)


def queries_of(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "query_id int, query_vector array<double>")


@pytest.fixture(scope="module")
def vectors():
    """Groups around eight directions, many copies of one vector, and zero vectors."""
    random = np.random.default_rng(5)
    made = np.eye(DIM)[random.integers(0, DIM, 900)] + random.normal(scale=0.1, size=(900, DIM))
    made[::3] = made[0]
    made[1::300] = 0
    return made


@pytest.fixture
def asked(spark, vectors):
    return queries_of(spark, [vectors[0], np.zeros(DIM), *np.random.default_rng(9).normal(size=(4, DIM))])


def test_build_close_open_search(spark, tmp_path, rows, vectors, asked):
    path, corpus = str(tmp_path / "index"), frame(spark, vectors)
    assert not stored_index.exists(spark, path)
    stored_index.build(corpus, path, DIM, 8)
    assert stored_index.exists(spark, path)
    index = stored_index.open_index(spark, path)
    for k in (1, 5, 700, 1000):
        assert rows(stored_index.search(spark, index, asked, k), *COLUMNS) == rows(search.top_k(corpus, asked, k), *COLUMNS)
    assert stored_index.search(spark, index, asked.limit(0)).count() == 0


@pytest.mark.parametrize(("kind", "ticker"), [("news", None), (None, "t7"), ("company_profile", "T3"), (None, "nobody")])
def test_filters_skip_clusters_and_lose_nothing(spark, tmp_path, rows, vectors, asked, kind, ticker):
    corpus = frame(spark, vectors).withColumn("ticker", F.when(F.col("doc_id") < 4, "T7").otherwise(F.concat(F.lit("S"), F.col("doc_id") % 9)))
    index = stored_index.build(corpus, str(tmp_path / "index"), DIM, 8)
    kept = corpus.filter(search.search_filter(kind, ticker))
    assert rows(stored_index.search(spark, index, asked, 5, kind, ticker), *COLUMNS) == rows(search.top_k(kept, asked, 5), *COLUMNS)
    if ticker is not None:
        allowed = stored_index.may_hold(spark, index, kind, ticker)
        assert allowed.sum() <= 4 < (index.rows > 0).sum()


def changes(old, new, version):
    return changefeed.committed(changefeed.snapshot_diff(old, new, ["doc_id"]), version, "2024-01-01 00:00:00")


def test_fed_index_equals_a_new_one(spark, tmp_path, rows, vectors, asked):
    path = str(tmp_path / "index")
    states = [frame(spark, vectors)]
    states.append(states[0].filter("doc_id % 10 != 0").withColumn("embedding", F.when(F.col("doc_id") == 7, F.reverse("embedding")).otherwise(F.col("embedding"))))
    states.append(states[1].filter("doc_id != 7").unionByName(frame(spark, vectors[:50] + 0.01, 2000)).unionByName(states[0].filter("doc_id = 10")))
    feed = changes(states[0], states[1], 1).unionByName(changes(states[1], states[2], 2))
    index = stored_index.build(states[0], path, DIM, 8)
    expected = [rows(search.top_k(state, asked, 5), *COLUMNS) for state in states]
    stored_index.apply_feed(spark, index, feed.filter("_commit_version = 1"), lambda df: df)
    index = stored_index.open_index(spark, path)
    assert rows(stored_index.search(spark, index, asked, 5), *COLUMNS) == expected[1]
    written = spark.read.schema(index.schema).parquet(f"{path}/{index.deltas[0]}/rows")
    assert [r["doc_id"] for r in written.collect()] == [7]
    index = stored_index.apply_feed(spark, index, feed, lambda df: df)
    assert stored_index.apply_feed(spark, index, feed, lambda df: df) is index
    assert rows(stored_index.search(spark, index, asked, 5), *COLUMNS) == expected[2]
    small = stored_index.compact(spark, index, most_rows=150)
    assert not small.deltas and len(small.centres) > len(index.centres)
    assert small.rows.sum() == states[2].count()
    assert rows(stored_index.search(spark, small, asked, 5), *COLUMNS) == expected[2]
    assert rows(stored_index.live_rows(spark, small), "doc_id") == rows(states[2], "doc_id")


def test_both_commits_at_once(spark, tmp_path, rows, vectors):
    first = frame(spark, vectors[:60])
    second = first.filter("doc_id != 3").withColumn("ticker", F.when(F.col("doc_id") == 5, "NEW").otherwise(F.col("ticker")))
    third = second.unionByName(first.filter("doc_id = 3")).filter("doc_id != 4")
    feed = changes(first, second, 1).unionByName(changes(second, third, 2))
    index = stored_index.build(first, str(tmp_path / "index"), DIM, 2)
    index = stored_index.apply_feed(spark, index, feed, lambda df: df)
    assert rows(stored_index.live_rows(spark, index), "doc_id", "ticker") == rows(third, "doc_id", "ticker")


def test_many_parts_and_blocks(spark, tmp_path, rows, vectors, monkeypatch):
    corpus = frame(spark, vectors)
    asked = corpus.filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    index = stored_index.build(corpus, str(tmp_path / "index"), DIM, 4)
    monkeypatch.setattr(stored_index, "PART_BYTES", 8 * DIM * 20)
    assert rows(stored_index.search(spark, index, asked, 4), *COLUMNS) == rows(search.top_k(corpus, asked, 4), *COLUMNS)


def test_empty_corpus(spark, tmp_path, asked):
    index = stored_index.build(frame(spark, [np.eye(DIM)[0]]).limit(0), str(tmp_path / "index"), DIM, 3)
    assert stored_index.search(spark, index, asked).count() == 0
    with pytest.raises(Exception):
        stored_index.open_index(spark, str(tmp_path / "nothing"))
