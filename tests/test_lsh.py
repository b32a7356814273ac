import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import lsh, search
from marketlake.sources import sample_tables

DIM = 16


def frame(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "doc_id bigint, embedding array<float>").repartition(5)


def asked_of(corpus, every=20):
    rows = corpus.filter(F.col("doc_id") % every == 0)
    return rows.select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def measured(corpus, dim, k=5, **settings):
    asked = asked_of(corpus)
    index = lsh.build(corpus, dim, **settings)
    row = lsh.recall(lsh.knn_lsh(index, asked, k), search.top_k(corpus, asked, k)).first()
    return index, row


def test_probes_come_in_order_of_cost():
    margins = np.array([0.9, -0.1, 0.5, -0.3])
    found = lsh.nearest_probes(0b0101, margins, 16)
    costs = [sum(m * m for i, m in enumerate(margins) if (code ^ 0b0101) >> i & 1) for code in found]
    assert len(set(found)) == 16 and costs == sorted(costs) and found[0] == 0b0101


def test_recall_on_the_sample_vectors(spark):
    corpus = sample_tables.vector_index(spark, "/root/testdata/sf0.01")
    _, row = measured(corpus, 64)
    assert row["queries"] > 20 and row["hits"] >= 0.9 * row["wanted"]


def test_hot_bucket_is_split(spark):
    """Most vectors lie close together, and far from zero: planes through zero do not part them."""
    random = np.random.default_rng(3)
    close = np.ones(DIM) * 10 + random.normal(size=(2500, DIM)) * 0.3
    corpus = frame(spark, [*close, *random.normal(size=(500, DIM))])
    index, row = measured(corpus, DIM, bucket_rows=64, split_rows=256)
    assert index.depths
    largest = index.rows.groupBy("bucket").count().agg(F.max("count")).first()[0]
    assert largest < 1500
    assert row["hits"] >= 0.9 * row["wanted"]


def test_copies_lose_nothing(spark):
    random = np.random.default_rng(4)
    vectors = random.normal(size=(900, DIM))
    vectors[::3] = vectors[0]
    corpus = frame(spark, vectors)
    index, _ = measured(corpus, DIM)
    assert index.rows.select("doc_id").distinct().count() == 600 + 5
    found = lsh.knn_lsh(index, asked_of(corpus).filter("query_id = 0")).orderBy("rank").collect()
    assert [(r["doc_id"], r["score"]) for r in found] == [(i, 1.0) for i in (0, 3, 6, 9, 12)]
    with pytest.raises(ValueError, match="copies"):
        lsh.knn_lsh(index, asked_of(corpus), k=6)


def test_scores_are_exact_and_documents_come_once(spark):
    corpus = frame(spark, np.random.default_rng(5).normal(size=(400, DIM)))
    asked = asked_of(corpus)
    found = lsh.knn_lsh(lsh.build(corpus, DIM), asked)
    every = {(r["query_id"], r["doc_id"]): r["score"] for r in search.top_k(corpus, asked, 400).collect()}
    rows = found.collect()
    assert len({(r["query_id"], r["doc_id"]) for r in rows}) == len(rows)
    assert all(every[r["query_id"], r["doc_id"]] == r["score"] for r in rows)


def test_no_direction_and_no_rows(spark):
    corpus = frame(spark, [np.zeros(DIM), np.ones(DIM)])
    index = lsh.build(corpus, DIM)
    asked = corpus.select(F.col("doc_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    assert [(r["query_id"], r["doc_id"]) for r in lsh.knn_lsh(index, asked).collect()] == [(1, 1)]
    assert lsh.knn_lsh(lsh.build(corpus.limit(0), DIM), asked).count() == 0


def test_pairs_are_scored_in_groups_and_large_buckets_in_pieces(spark, monkeypatch, capsys):
    """No vector is copied onto a pair; cut or not, the same is found."""
    corpus = frame(spark, np.random.default_rng(6).normal(size=(700, DIM)))
    index, asked = lsh.build(corpus, DIM), asked_of(corpus)
    whole = lsh.knn_lsh(index, asked)
    whole.explain()
    plan = capsys.readouterr().out
    assert "CoGroup" in plan and "ArrowEvalPython" not in plan
    monkeypatch.setattr(lsh, "PIECE_ROWS", 7)
    monkeypatch.setattr(lsh, "CELL_BYTES", 20_000)
    key = lambda r: (r["query_id"], r["rank"])
    assert sorted(lsh.knn_lsh(index, asked).collect(), key=key) == sorted(whole.collect(), key=key)
