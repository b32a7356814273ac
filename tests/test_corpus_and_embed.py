from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from row_order import ordered

from marketlake.functions.vectors import HashingEncoder
from marketlake.operators import corpus, embed
from marketlake.schemas import INDEX, SILVER_COMPANIES, SILVER_NEWS

NOW = datetime(2024, 1, 31)


@pytest.fixture
def news(spark):
    return spark.createDataFrame(
        [
            ("AA", "t1", "s", datetime(2024, 1, 1, 5), "u", "sum", "full", NOW),
            ("AA", "t1", "s", datetime(2024, 1, 2), "u", None, "later", NOW),
            ("BB", "", "s", None, "u", None, None, NOW),
        ],
        SILVER_NEWS,
    )


@pytest.fixture
def companies(spark):
    return spark.createDataFrame(
        [("AA", "Alpha", "Tech", None, 1, "Makes things", NOW), ("BB", None, None, None, None, None, NOW)],
        SILVER_COMPANIES,
    )


def test_documents(news, companies, rows):
    docs = rows(corpus.text_corpus(news, companies), "doc_id", "doc_type", "text", "metadata_date", "metadata_source")
    assert docs == ordered(
        [
            ("AA | t1", "news", "t1\n\nsum\n\nfull", "2024-01-01 05:00:00", "s"),
            ("AA | t1", "news", "t1\n\nlater", "2024-01-02 00:00:00", "s"),
            ("BB | ", "news", "", None, "s"),
            ("AA", "company_profile", "Alpha\n\nSector: Tech\n\nMakes things", "2024-01-31 00:00:00", "Company Profile"),
            ("BB", "company_profile", "", "2024-01-31 00:00:00", "Company Profile"),
        ]
    )
    assert corpus.with_text(corpus.text_corpus(news, companies)).count() == 3


def test_sentences(news, companies, rows):
    docs = rows(corpus.sentence_corpus(news, companies), "ticker", "text", "date", "doc_type")
    assert docs == ordered(
        [
            ("AA", "Alpha. Sector: Tech. Makes things", "2024-01-01", "company_profile"),
            ("BB", "", "2024-01-01", "company_profile"),
            ("AA", "t1. sum full", "2024-01-01", "news_article"),
            ("AA", "t1. later", "2024-01-02", "news_article"),
            ("BB", ".", "2024-01-01", "news_article"),
        ]
    )


def test_newest_version_of_a_document_is_embedded(news, companies, rows):
    embedded = embed.embed_corpus(corpus.text_corpus(news, companies))
    assert rows(embedded, "doc_id", "text", "embed_ok") == ordered(
        [
            ("AA | t1", "t1\n\nlater", True), ("BB | ", "", False), ("BB", "", False),
            ("AA", "Alpha\n\nSector: Tech\n\nMakes things", True),
        ]
    )


def test_encoder_is_unit_length_and_ignores_case_and_order():
    encoder = HashingEncoder(32)
    vectors = encoder(["The fox, the dog", "dog THE the fox", "...", "other words here"])
    assert vectors.dtype == np.float32 and vectors.shape == (4, 32)
    assert np.array_equal(vectors[0], vectors[1])
    assert not vectors[2].any()
    assert np.allclose(np.linalg.norm(vectors[[0, 3]], axis=1), 1)


def test_null_and_empty_texts_get_zero_vectors(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "word")], "id int, text string")
    found = {r["id"]: r["embedding"] for r in embed.embed(frame).collect()}
    assert found[1] == found[2] == [0.0] * 64
    assert any(found[3])


def test_a_failing_text_gets_a_zero_vector(spark):
    def encoder(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no answer")
        return np.ones((len(texts), 2))

    frame = spark.createDataFrame([("bad",), ("good",)], "text string").coalesce(1)
    assert [r["embedding"] for r in embed.embed(frame, encoder, 2).collect()] == [[0.0, 0.0], [1.0, 1.0]]
    fine = frame.filter("text = 'good'")
    assert [r["embedding"] for r in embed.embed(fine, encoder, 2).collect()] == [[1.0, 1.0]]


def test_input_limit_is_optional(spark):
    def length(texts):
        return np.array([[len(t)] for t in texts], dtype=float)

    frame = spark.createDataFrame([("x" * 9000,)], "text string")
    assert embed.embed(frame, length, 1).first()["embedding"] == [9000.0]
    limited = embed.embed(frame, length, 1, max_chars=embed.MODEL_INPUT_LENGTH)
    assert limited.first()["embedding"] == [8000.0]


def test_only_changed_documents_are_embedded(spark, rows):
    schema = "doc_id string, doc_type string, ticker string, title string, text string, metadata_date string, metadata_source string"
    make = lambda *docs: spark.createDataFrame(
        [(i, "news", "AA", "t", text, day, "s") for i, text, day in docs], schema
    )
    old = make(("a", "one", "1"), ("b", "two", "1"), ("c", "three", "1"))
    new = make(("a", "one", "2"), ("b", "older", "1"), ("b", "changed", "2"), ("d", "four", "1"))
    index = embed.embed_corpus(old)
    fresh = embed.embed_incremental(new, index)
    assert rows(fresh, "doc_id", "text") == [("b", "changed"), ("d", "four")]
    merged = embed.merge_index(index, fresh, new)
    whole = embed.embed_corpus(new)
    assert sorted(merged.columns) == sorted(whole.columns)
    assert rows(merged, *whole.columns) == rows(whole, *whole.columns)
    assert embed.embed_incremental(new, merged).count() == 0


def test_failed_documents_are_tried_again_and_empty_ones_are_not(spark, rows):
    docs = spark.createDataFrame(
        [("a", "n", "AA", "t", "one", "1", "s"), ("b", "n", "AA", "t", "", "1", "s"), ("c", "n", "AA", "t", None, "1", "s")],
        "doc_id string, doc_type string, ticker string, title string, text string, metadata_date string, metadata_source string",
    )

    def failing(texts):
        raise RuntimeError("no answer")

    broken = embed.embed_corpus(docs, failing)
    assert rows(broken, "doc_id", "embed_ok") == [("a", False), ("b", False), ("c", False)]
    fresh = embed.embed_incremental(docs, broken)
    assert rows(fresh, "doc_id", "embed_ok") == [("a", True)]
    mended = embed.merge_index(broken, fresh, docs)
    assert rows(mended, "doc_id", "embed_ok") == [("a", True), ("b", False), ("c", False)]
    assert embed.embed_incremental(docs, mended).count() == 0


def test_text_column_alone_reaches_the_encoder(news, companies, capsys):
    embed.embed_corpus(corpus.text_corpus(news, companies)).select("doc_id", "embedding").explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "ArrowEvalPython" in plan



def test_a_bad_text_costs_only_itself():
    from marketlake.functions import vectors

    calls = []

    def picky(texts):
        calls.append(len(texts))
        if any("bad" in t for t in texts):
            raise ValueError("refused")
        return embed.DEFAULT_ENCODER(texts)

    texts = [f"word{i} text" if i % 50 else f"bad {i}" for i in range(400)] + [None, ""]
    found, errors = vectors.encode_rows(texts, picky, 64)
    assert [i for i, e in enumerate(errors) if e] == list(range(0, 400, 50))
    assert errors[0] == "ValueError: refused"
    good = [i for i, t in enumerate(texts) if t and i % 50]
    assert (found[good] == embed.DEFAULT_ENCODER([texts[i] for i in good])).all()
    assert not found[[0, 50, 400, 401]].any()
    assert len(calls) < 8 * 2 * 10


def test_an_encoder_that_is_down_is_not_asked_for_ever():
    from marketlake.functions import vectors

    calls = []

    def down(texts):
        calls.append(1)
        raise RuntimeError("no answer")

    _, errors = vectors.encode_rows([f"t{i}" for i in range(5000)], down, 4)
    assert len(calls) == vectors.MOST_FAILING_CALLS and all(errors)
    assert errors.count(vectors.NOT_TRIED) > 4900


def test_failures_are_tried_again_until_given_up(spark, tmp_path, rows):
    from marketlake.plans import medallion
    from marketlake.sources import tables

    docs = [(str(i), "news", "T", f"t{i}", "bad" if i == 3 else f"text {i}", "2024", "s") for i in range(8)]
    corpus_of = lambda some: spark.createDataFrame(some, "doc_id string, doc_type string, ticker string, title string, text string, metadata_date string, metadata_source string")
    path, seen = str(tmp_path / "index"), str(tmp_path / "calls")

    def picky(texts):
        with open(seen, "a") as log:
            log.write("".join(f"{t}\n" for t in texts if len(texts) == 1))
        if "bad" in texts:
            raise ValueError("refused")
        return embed.DEFAULT_ENCODER(texts)

    for tries in (1, 2, 3, 3):
        medallion.refresh_index(corpus_of(docs), path, picky)
        assert rows(medallion.read_failures(spark, path), "doc_id", "error", "tries") == [("3", "ValueError: refused", tries)]
    assert open(seen).read().split("\n").count("bad") == 3
    docs[3] = (*docs[3][:4], "better", *docs[3][5:])
    medallion.refresh_index(corpus_of(docs), path, picky)
    assert medallion.read_failures(spark, path).count() == 0
    assert tables.read_version(spark, path, INDEX).filter("embed_ok").count() == 8


def test_unbalanced_documents_are_dealt_anew(spark):
    one = spark.range(500).repartition(1).withColumn("text", F.lit("a"))
    assert embed.balanced(one).select(F.spark_partition_id()).distinct().count() > 4
    even = spark.range(500).repartition(8).withColumn("text", F.lit("a"))
    assert embed.balanced(even) is even
    assert embed.balanced(one.limit(0)).count() == 0


def test_texts_stay_in_place_where_most_or_few_documents_change(spark, rows, capsys):
    """Of changed and unchanged documents the fewer are broadcast, by short names of their ids."""
    schema = "doc_id string, doc_type string, ticker string, title string, text string, metadata_date string, metadata_source string"
    docs = [(f"{i} " + "long " * 200, "news", "AA", "t", f"text text {i}", "1", "s") for i in range(300)]
    docs += [(docs[0][0], "news", "AA", "t", "newer", "2", "s"), (None, "news", "AA", "t", "no id", "1", "s")]
    whole = spark.createDataFrame(docs, schema)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for known in (3, 297):
        index = embed.embed_corpus(whole.filter("doc_id is not null").join(
            spark.createDataFrame([(d[0],) for d in docs[300 - known:300]], "doc_id string"), "doc_id", "left_semi"
        ))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20KB")
        try:
            fresh = embed.documents_to_embed(whole, index)
            fresh.explain()
            merged = embed.merge_index(index, fresh.join(embed.embed_corpus(whole).select("doc_id", "embedding", "embed_ok", "embed_error"), "doc_id"), whole)
            assert merged.count() == 300
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert "SortMergeJoin" not in capsys.readouterr().out
        assert sorted(r["text"] for r in fresh.select("text").collect()) == sorted(["newer"] + [d[4] for d in docs[1 : 300 - known]])
