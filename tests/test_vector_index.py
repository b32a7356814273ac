import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import search, vector_index


def frame(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "doc_id bigint, embedding array<float>").repartition(5)


def queries_of(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "query_id int, query_vector array<double>")


@pytest.fixture
def clustered():
    """Tight groups around eight directions, many copies of one vector, and zero vectors."""
    random = np.random.default_rng(5)
    directions = np.eye(8)
    vectors = directions[random.integers(0, 8, 900)] + random.normal(scale=0.05, size=(900, 8))
    vectors[::3] = vectors[0]
    vectors[1::300] = 0
    return vectors


@pytest.mark.parametrize("k", [1, 5, 320, 1000])
def test_same_result_as_the_full_search(spark, tmp_path, rows, clustered, k):
    corpus = frame(spark, clustered)
    index = vector_index.build_index(corpus, str(tmp_path / "index"), dim=8, clusters=8)
    random = np.random.default_rng(9)
    asked = queries_of(spark, [clustered[0], *random.normal(size=(3, 8))])
    columns = ["query_id", "rank", "doc_id", "score"]
    assert rows(vector_index.search_index(spark, index, asked, k), *columns) == rows(
        search.top_k(corpus, asked, k), *columns
    )


def test_far_clusters_are_skipped(spark, tmp_path, clustered, monkeypatch):
    index = vector_index.build_index(frame(spark, clustered), str(tmp_path / "index"), dim=8, clusters=8)
    read = []
    original = vector_index.ClusteredIndex.read

    def reading(self, session, clusters):
        read.extend(clusters)
        return original(self, session, clusters)

    monkeypatch.setattr(vector_index.ClusteredIndex, "read", reading)
    vector_index.search_index(spark, index, queries_of(spark, [np.eye(8)[3]])).collect()
    assert 0 < len(set(read)) < 4


def test_no_queries_and_queries_without_direction(spark, tmp_path, clustered):
    corpus = frame(spark, clustered)
    index = vector_index.build_index(corpus, str(tmp_path / "index"), dim=8, clusters=4)
    asked = queries_of(spark, [np.zeros(8)])
    assert vector_index.search_index(spark, index, asked.limit(0)).count() == 0
    found = vector_index.search_index(spark, index, asked, 3).orderBy("rank").collect()
    assert [(r["doc_id"], r["score"]) for r in found] == [(0, None), (1, None), (2, None)]


def test_queries_without_direction_among_others(spark, tmp_path, rows, clustered):
    corpus = frame(spark, clustered)
    index = vector_index.build_index(corpus, str(tmp_path / "index"), dim=8, clusters=4)
    asked = queries_of(spark, [np.zeros(8), clustered[0], np.eye(8)[2]])
    columns = ["query_id", "rank", "doc_id", "score"]
    assert rows(vector_index.search_index(spark, index, asked, 3), *columns) == rows(search.top_k(corpus, asked, 3), *columns)


def test_filtered_search(spark, tmp_path, rows, clustered):
    corpus = frame(spark, clustered)
    index = vector_index.build_index(corpus, str(tmp_path / "index"), dim=8, clusters=8)
    asked, keep = queries_of(spark, np.eye(8)[:3]), F.col("doc_id") % 50 == 7
    columns = ["query_id", "rank", "doc_id", "score"]
    assert rows(vector_index.search_index(spark, index, asked, 5, keep), *columns) == rows(
        search.top_k(corpus.filter(keep), asked, 5), *columns
    )


def test_empty_corpus(spark, tmp_path, clustered):
    empty = frame(spark, clustered).limit(0)
    index = vector_index.build_index(empty, str(tmp_path / "index"), dim=8)
    assert vector_index.search_index(spark, index, queries_of(spark, np.eye(8)[:2])).count() == 0


def test_vectors_are_scaled_once(spark, capsys):
    from marketlake.functions.vectors import unit_column

    corpus = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "doc_id int, embedding array<float>")
    unit = corpus.select(unit_column(corpus["embedding"], 2).alias("unit")).filter("unit is not null")
    unit.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1
    assert [r["unit"] for r in unit.collect()] == [[0.6, 0.8]]
