import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import keys, search
from marketlake.operators.embed import DEFAULT_ENCODER as ENCODER
from marketlake.operators.embed import embed


def index_of(spark, vectors, ids=None, ticker=lambda i: "AA", kind=lambda i: "news"):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, kind(i), ticker(i), None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "doc_id bigint, doc_type string, ticker string, embedding array<float>")


def queries_of(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "query_id int, query_vector array<double>")


def brute_force(vectors, query, k, ids=None):
    vectors, query = np.float32(vectors).astype(float), np.asarray(query, dtype=float)
    scores = np.round(vectors @ query / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query)), 6)
    ids = range(len(vectors)) if ids is None else ids
    return sorted(zip(-scores, ids))[:k]


def ranked(found):
    result = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        result.setdefault(r["query_id"], []).append((-r["score"], r["doc_id"]))
    return result


def test_ties_zero_and_opposite_vectors(spark):
    index = index_of(spark, [[1, 0, 0], [2, 0, 0], [0, 0, 0], [-1, 0, 0], None, [1, 0]])
    found = search.top_k(index, queries_of(spark, [[3, 0, 0]]), k=10).orderBy("rank").collect()
    assert [(r["doc_id"], r["score"], r["rank"]) for r in found] == [
        (0, 1.0, 1), (1, 1.0, 2), (3, -1.0, 3), (2, None, 4), (4, None, 5), (5, None, 6),
    ]
    assert search.top_k(index, queries_of(spark, [[3, 0, 0]]), k=3).filter("score IS NULL").count() == 0


def test_empty_corpus_filter_and_queries(spark):
    index = index_of(spark, [[1, 0]])
    queries = queries_of(spark, [[1, 0]])
    assert search.top_k(index.filter(search.search_filter(ticker="zz")), queries).count() == 0
    assert search.top_k(index, queries.limit(0)).count() == 0
    assert search.top_k(index.filter(search.search_filter("news", "aa")), queries).count() == 1


@pytest.mark.parametrize(("block", "held", "sent"), [(1024, 64 << 20, 64 << 20), (4, 2000, 64 << 20), (4, 2000, 0)])
def test_equals_brute_force_with_many_copies(spark, monkeypatch, block, held, sent):
    """A third of the corpus is one document; more queries than fit one block, or a broadcast."""
    monkeypatch.setattr(search, "QUERY_BLOCK", block)
    monkeypatch.setattr(search, "HELD_BYTES", held)
    monkeypatch.setattr(search, "QUERY_BYTES", sent)
    random = np.random.default_rng(7)
    vectors = random.normal(size=(600, 8))
    vectors[::3] = vectors[0]
    questions = [vectors[0], *random.normal(size=(9, 8))]
    index = index_of(spark, vectors).repartition(6)
    found = ranked(search.top_k(index, queries_of(spark, questions), k=7))
    assert found == {i: brute_force(vectors, q, 7) for i, q in enumerate(questions)}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_per_ticker_with_a_hot_ticker(spark, monkeypatch, limit):
    """One ticker holds most rows; the queries are broadcast, or the lookup is salted."""
    monkeypatch.setattr(keys, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(search, "QUERY_BYTES", limit)
    random = np.random.default_rng(3)
    vectors = random.normal(size=(300, 4))
    ticker = lambda i: "HOT" if i % 5 else f"T{i % 4}"
    index = index_of(spark, vectors, ticker=ticker)
    names = sorted({ticker(i) for i in range(300)})
    asked = {name: random.normal(size=4).tolist() for name in names}
    queries = spark.createDataFrame(list(asked.items()), "ticker string, query_vector array<double>")
    found = search.top_k_per_ticker(index, queries, dim=4, k=4)
    result = ranked(found.withColumnRenamed("ticker", "query_id"))
    for name in names:
        ids = [i for i in range(300) if ticker(i) == name]
        assert result[name] == brute_force(vectors[ids], asked[name], 4, ids)


def test_text_search_finds_the_matching_text(spark):
    docs = spark.createDataFrame(
        [
            ("AA | rates", "news", "AA", "rates", "banks face rising interest rates " * 30),
            ("AA", "company_profile", "AA", "Alpha", "maker of electric cars"),
            ("BB", "company_profile", "BB", "Beta", "bank lending at interest"),
        ],
        "doc_id string, doc_type string, ticker string, title string, text string",
    ).withColumn("metadata_date", F.lit("2024-01-01"))
    index = embed(docs)
    questions = spark.createDataFrame(
        [(1, "companies exposed to rising interest rates in the banking sector"), (2, "electric cars")],
        "query_id int, text string",
    )
    found = search.semantic_search(index, questions, ENCODER, 64, k=1).collect()
    assert {(r["query_id"], r["doc_id"]) for r in found} == {(1, "AA | rates"), (2, "AA")}

    news = search.search_news(index, questions, ENCODER, 64, ticker="aa").collect()
    assert {r["doc_id"] for r in news} == {"AA | rates"}
    assert all(len(r["snippet"]) == 203 and r["snippet"].endswith("...") for r in news)

    profiles = search.search_profiles(index, questions, ENCODER, 64)
    assert {r["doc_id"] for r in profiles.collect()} == {"AA", "BB"}

    tickers = spark.createDataFrame([("AA",), ("CC",)], "ticker string")
    panel = {r["doc_id"]: r["text"] for r in search.ticker_panel(index, tickers, ENCODER, 64).collect()}
    assert set(panel) == {"AA | rates", "AA"}
    assert len(panel["AA | rates"]) == 503 and panel["AA"] == "maker of electric cars"


def test_missing_index_reads_as_empty(spark):
    from marketlake.schemas import TEXT_EMBEDDINGS
    from marketlake.sources.tables import read_or_empty

    index = read_or_empty(spark, "no_such_index", TEXT_EMBEDDINGS)
    questions = spark.createDataFrame([(1, "anything")], "query_id int, text string")
    assert search.semantic_search(index, questions, ENCODER, 64).count() == 0


def test_a_task_sends_rows_that_its_earlier_ones_do_not_beat(spark, monkeypatch):
    """Held a few rows at a time, a task still sends about k rows per query, not k each time."""
    monkeypatch.setattr(search, "HELD_BYTES", 1)
    monkeypatch.setattr(search, "QUERY_BLOCK", 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        random = np.random.default_rng(9)
        vectors = random.normal(size=(800, 8))
        vectors[5] = 0
        questions = random.normal(size=(20, 8))
        index = index_of(spark, vectors).coalesce(1)
        assert search.scored(index, queries_of(spark, questions), 3).count() < 20 * 3 * 15
        found = ranked(search.top_k(index, queries_of(spark, questions), 3))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    keep = [i for i in range(800) if i != 5]
    assert found == {i: brute_force(vectors[keep], q, 3, keep) for i, q in enumerate(questions)}


def test_a_matrix_product_is_bounded():
    """Many rows meet a block of queries a block at a time; scores of all pairs are never held."""
    import tracemalloc

    import pyarrow as pa

    random = np.random.default_rng(2)
    rows, dim = 40_000, 4
    column = pa.array(random.normal(size=(rows, dim)).astype(np.float32).tolist(), pa.list_(pa.float32()))
    table = pa.table({"doc_id": pa.array(range(rows)), "embedding": column})
    queries = random.normal(size=(256, dim))
    schema = pa.schema([("query_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())])
    unit = queries / np.linalg.norm(queries, axis=1)[:, None]
    tracemalloc.start()
    found = pa.Table.from_batches(search.best_pairs(table, pa.array(range(256)), unit, 5, schema, 256), schema=schema)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 256 * 5
    assert peak < rows * 256 * 8 / 4
