import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from marketlake.llm import catalog, oracles

FOLDER = "/root/testdata/sf0.001"


def key(row):
    return tuple((value is not None, value) for value in row)


@pytest.mark.parametrize("name", sorted(oracles.statements()))
def test_against_sql(spark, name):
    found = catalog.registered()[name](spark, FOLDER)
    columns = sorted(found.columns)
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        db.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    expected = db.sql(oracles.statements()[name])
    assert sorted(expected.columns) == columns
    places = [expected.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=key) == sorted(
        (tuple(r[i] for i in places) for r in expected.fetchall()), key=key
    )


def test_contract_columns(spark):
    columns = {name: query(spark, FOLDER).columns for name, query in catalog.registered().items()}
    assert columns["op1_quality_divergence"] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert columns["op2_katz_backoff"] == ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "train_tokens"]
    assert columns["op4_language_spans"][:4] == ["doc_id", "held_out", "lang_pred", "score"]
    assert columns["op8_best_fit_packing"] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert columns["op9_ngram_jaccard"] == ["doc_id", "n_shingles", "component_id"]


def test_all_operators_are_registered():
    names = __spark_entry__.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names


def test_stages_hand_documents_on(spark, documents):
    docs = documents
    kept = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        ids = {r["doc_id"] for r in docs.collect()}
        assert ids and ids <= kept
        kept = ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == kept


def test_stages_on_an_empty_table(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents.limit(0), FOLDER).count() == 0


def test_near_duplicates_by_five_words(make, spark):
    """One changed word of 50: 41 of 51 shingles of five words are shared, 43 of 51 of four."""
    words = [f"w{i}" for i in range(50)]
    other = [f"v{i}" for i in range(49)]
    # Of 49 words 40 of 50 remain, just at the threshold; two changed words are too many.
    changed = [*words[:20], "x", *words[21:]]
    rows = [(1, words), (2, changed), (3, other), (4, [*other[:20], "x", *other[21:]]), (5, ["y", *words[1:9], "y", *words[10:30], "y", *words[31:]])]
    docs = make(*[(i, " ".join(text)) for i, text in rows])
    sets = {i: {tuple(text[at : at + 5]) for at in range(len(text) - 4)} for i, text in rows}
    near = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert near == {(1, 2), (3, 4)}
    kept = dict(corpus_pipeline.STAGES)["near duplicates"](spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5]


def test_pipeline_against_brute_force(spark, documents):
    """The filters' decisions by plain Python: the documents left before mixing."""
    from collections import Counter

    from test_ngram_join import brute

    texts = {}
    for r in documents.collect():
        if any(c.isalpha() for c in r["text"] or ""):
            texts[r["text"]] = max(r["doc_id"], texts.get(r["text"], -1))
    unique = spark.createDataFrame([(i, t) for t, i in texts.items()], "doc_id long, text string")
    left = {c for _, _, c in brute(unique, n=corpus_pipeline.SHINGLE_WORDS, threshold=corpus_pipeline.NEAR_THRESHOLD)}
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER)
    assert {r["doc_id"] for r in docs.collect()} == left
    mixed = Counter(r["doc_id"] for r in corpus_pipeline.STAGES[3][1](spark, docs, FOLDER).collect())
    pieces = {}
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], 0) + (r["piece"] == 0)
    assert pieces == dict(mixed)
