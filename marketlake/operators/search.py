"""Exact filtered top-k search by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from marketlake.functions.text import clip_marked, snippet, ticker_of
from marketlake.functions.vectors import SCORE_DIGITS, Encoder, cosine_column, matrix, rounded, unit_rows
from marketlake.operators.corpus import COMPANY_PROFILE, NEWS
from marketlake.operators.embed import balanced, embed
from marketlake.operators.keys import attach
from marketlake.session import materialize

# Result counts, shown lengths and the text asked for a ticker's panel.
RESULTS = 5
CHAT_RESULTS = 3
RESULT_LENGTH = 500
NEWS_SNIPPET = 200
PROFILE_SNIPPET = 300
NO_TITLE, NO_DATE, NO_TYPE = "No title", "N/A", "document"
PANEL_QUESTION = "recent news and analysis for "

# Queries, and rows, that meet in one matrix product.
QUERY_BLOCK = 1024
# Bytes of queries that are broadcast; of rows that a task holds at a time while it scores them
# in place; of vectors in a part of the corpus and in a block of queries that meet in a group. A
# task takes several times as much.
QUERY_BYTES = 64 << 20
HELD_BYTES = 8 << 20
PART_BYTES = 32 << 20
# Queries from which scoring in place takes longer than dealing the vectors evenly first.
MANY_QUERIES = 1024

_BELOW_ANY_SCORE = -2.0


def search_filter(doc_type: str | None = None, ticker: str | None = None) -> Column:
    """Predicate for an optional document type and an optional ticker."""
    predicate = F.lit(True)
    if doc_type is not None:
        predicate &= F.col("doc_type") == doc_type
    if ticker is not None:
        predicate &= F.col("ticker") == ticker_of(F.lit(ticker))
    return predicate


def _cut(which: np.ndarray, where: np.ndarray, values: np.ndarray, best: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of scored pairs the k best of each query that reach its k-th best score; among equal ones
    the first rows. Their places among the pairs of their query come last."""
    reaching = np.flatnonzero(values >= best[which, 0])
    order = reaching[np.lexsort((where[reaching], -values[reaching], which[reaching]))]
    which = which[order]
    place = np.arange(len(which)) - np.searchsorted(which, which)
    kept = place < k
    order = order[kept]
    return which[kept], where[order], values[order], place[kept]


def _met(queries: np.ndarray, rows: np.ndarray, coarse_rows: np.ndarray, best: np.ndarray, k: int, at_once: int) -> tuple[np.ndarray, ...]:
    """Places of queries and rows, and scores, of all pairs of unit vectors that may be among the
    k best of a query; `best` (query, k), ascending, takes up what is found.

    Products of single precision tell which pairs come near the k-th best score, with room for
    their error; only those are scored in double precision.
    """
    slack = np.float32((rows.shape[1] + 8) * 2.0**-23 + 10.0**-SCORE_DIGITS)
    coarse_queries, found = queries.astype(np.float32), []
    for first in range(0, len(rows), at_once):
        coarse = coarse_queries @ coarse_rows[first : first + at_once].T
        least, width = best[:, 0].astype(np.float32), coarse.shape[1]
        if width >= k and np.isneginf(least).any():
            least = np.maximum(least, np.partition(coarse, width - k, axis=1)[:, width - k] - slack)
        which, where = np.divmod(np.flatnonzero(coarse >= (least - slack)[:, None]), width)
        if not len(which):
            continue
        if len(which) <= coarse.size // 64:
            values = rounded(np.einsum("ij,ij->i", queries[which], rows[first + where]))
        else:
            values = rounded(queries @ rows[first : first + at_once].T)[which, where]
        which, where, values, place = _cut(which, first + where, values, best, k)
        fresh = np.unique(which)
        grown = np.full((len(best), k), -np.inf)
        grown[which, place] = values
        best[fresh] = np.sort(np.concatenate([best[fresh], grown[fresh]], axis=1))[:, -k:]
        found.append((which, where, values))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(map(np.concatenate, zip(*found)))


def best_pairs(
    table: pa.Table, query_ids: pa.Array, queries: np.ndarray, k: int, schema: pa.Schema, rows_at_once: int, reached: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """The k best rows (doc_id, embedding) of a table for each query, given as unit vectors.

    Rows are put in id order first, so among equal scores the smallest ids are taken. Blocks of
    rows and of queries meet in one matrix product. A row or query without direction scores null
    and ranks after every number. `reached` (query, k), at first without limit, has the best
    scores of the tables before this one: rows below them are left out, better ones noted.
    """
    if not table.num_rows or not len(queries):
        return
    table = table.take(pc.sort_indices(table.column(0))).combine_chunks()
    ids, vectors = table.column(0), unit_rows(matrix(table.column(1), queries.shape[1]))
    if reached is None:
        reached = unreached(len(queries), k)
    lost = np.isnan(vectors).any(axis=1)
    aimed, aimless = np.flatnonzero(~lost), np.flatnonzero(lost)[:k]
    rows = vectors[aimed] if lost.any() else vectors
    coarse = rows.astype(np.float32)
    for start in range(0, len(queries), rows_at_once):
        block, best = queries[start : start + rows_at_once], reached[start : start + rows_at_once]
        astray = np.isnan(block).any(axis=1)
        asked = np.flatnonzero(~astray)
        reaching = best[asked]
        which, where, values = _met(block[asked], rows, coarse, reaching, k, rows_at_once)
        best[asked] = reaching
        which, where = asked[which], aimed[where]
        # What scores null: all rows for a query without direction, else rows without.
        short = asked[best[asked, 0] <= _BELOW_ANY_SCORE]
        for some, places in ((short, aimless), (np.flatnonzero(astray), np.arange(min(k, len(vectors))))):
            if len(some) and len(places):
                which = np.concatenate([which, np.repeat(some, len(places))])
                where = np.concatenate([where, np.tile(places, len(some))])
                values = np.concatenate([values, np.full(len(some) * len(places), _BELOW_ANY_SCORE)])
        which, where, values, _ = _cut(which, where, values, best, k)
        yield pa.RecordBatch.from_arrays(
            [
                query_ids.take(pa.array(start + which)),
                ids.take(pa.array(where)).combine_chunks(),
                pa.array(values, mask=values == _BELOW_ANY_SCORE),
            ],
            schema=schema,
        )


def unreached(queries: int, k: int) -> np.ndarray:
    """What queries have reached before any row was seen."""
    return np.full((queries, k), -np.inf)


def pair_schema(queries: DataFrame, corpus: DataFrame) -> tuple[T.StructType, pa.Schema]:
    """Schema of scored pairs, for Spark and for Arrow."""
    result = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("doc_id", corpus.schema["doc_id"].dataType),
        T.StructField("score", T.DoubleType()),
    ])
    return result, pa.schema([(f.name, to_arrow_type(f.dataType)) for f in result])


def scored(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """At least the k best rows of every query.

    The queries are written once and measured. Up to `QUERY_BYTES` they are broadcast, and the
    corpus is scored where it lies, a bounded number of bytes at a time; where that would leave many
    queries to a few tasks, its vectors are dealt evenly first. Beyond that, parts of the corpus meet
    blocks of queries by a join.
    """
    vector = F.col("query_vector").cast("array<double>").alias("query_vector")
    asked = materialize(queries.select("query_id", vector), "queries")
    measured = asked.agg(F.count("*").alias("rows"), F.max(F.size("query_vector")).alias("dim")).first()
    dim = max(measured["dim"] or 0, 1)
    if 8 * dim * measured["rows"] <= QUERY_BYTES:
        if measured["rows"] >= MANY_QUERIES:
            corpus = balanced(corpus.select("doc_id", "embedding"))
        return _scored_in_place(corpus, asked, k, dim)
    return _scored_in_blocks(corpus, asked, k, dim, measured["rows"])


def _scored_in_place(corpus: DataFrame, asked: DataFrame, k: int, dim: int) -> DataFrame:
    result, arrow = pair_schema(asked, corpus)
    told = asked.toArrow().cast(pa.schema([arrow.field(0), ("query_vector", pa.list_(pa.float64()))])).combine_chunks()
    ids = told.column(0).combine_chunks()
    sent = corpus.sparkSession.sparkContext.broadcast((ids, unit_rows(matrix(told.column(1), dim))))

    at_once, held_bytes = QUERY_BLOCK, HELD_BYTES

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, reached = [], 0, unreached(len(sent.value[1]), k)
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= held_bytes:
                yield from best_pairs(pa.Table.from_batches(held), *sent.value, k, arrow, at_once, reached)
                held, size = [], 0
        if held:
            yield from best_pairs(pa.Table.from_batches(held), *sent.value, k, arrow, at_once, reached)

    return corpus.select("doc_id", "embedding").mapInArrow(best, result)


def _scored_in_blocks(corpus: DataFrame, asked: DataFrame, k: int, dim: int, count: int) -> DataFrame:
    """Each part of the corpus meets each block of queries in a group of its own."""
    result, arrow = pair_schema(asked, corpus)
    rows = corpus.count()
    parts, blocks = (max(1, -(-n * 8 * dim // PART_BYTES)) for n in (rows, count))

    def spread(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    at_once = QUERY_BLOCK

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        unit = unit_rows(matrix(right.column("query_vector"), dim))
        ids = right.column("query_id").combine_chunks()
        return pa.Table.from_batches(best_pairs(left.select(["doc_id", "embedding"]), ids, unit, k, arrow, at_once), schema=arrow)

    placed = corpus.select("doc_id", "embedding", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("part"))
    placed = placed.withColumn("block", spread(blocks)).groupBy("part", "block")
    questions = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("part", spread(parts))
    return placed.cogroup(questions.groupBy("part", "block")).applyInArrow(meet, result)


def top_k(corpus: DataFrame, queries: DataFrame, k: int = RESULTS) -> DataFrame:
    """The k nearest documents of every query, over the whole corpus.

    `corpus` has (doc_id, embedding) with unique ids, `queries` (query_id, query_vector) in any
    number, with unique ids. The final ranking sees at most k rows per query and task.
    """
    return rank_results(scored(corpus, queries, k), k)


def rank_results(scored: DataFrame, k: int) -> DataFrame:
    order = [F.desc_nulls_last("score"), F.asc("doc_id")]
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return scored.withColumn("rank", place).filter(F.col("rank") <= k)


def top_k_per_ticker(corpus: DataFrame, queries: DataFrame, dim: int, k: int = RESULTS) -> DataFrame:
    """The k documents of each ticker nearest to that ticker's own query.

    `queries` has one (ticker, query_vector) per ticker. Each document is scored once, and
    at most k rows per ticker and task reach the final ranking.
    """
    asked = queries.select("ticker", F.col("query_vector").cast("array<double>").alias("query_vector"))
    rows = corpus.select("doc_id", "ticker", "embedding")
    count = asked.count()
    if 8 * dim * count <= QUERY_BYTES:
        scored = _scored_with_own(rows, asked, dim)
    else:
        met = attach(rows, asked, ["ticker"], spread=["doc_id"], row_bytes=8 * dim + 64)
        scored = met.select(
            "ticker", "doc_id", cosine_column(F.col("embedding"), F.col("query_vector"), dim).alias("score")
        )
    order = [F.desc_nulls_last("score"), F.asc("doc_id")]
    place = F.row_number().over(Window.partitionBy("ticker").orderBy(*order))
    return scored.withColumn("rank", place).filter(F.col("rank") <= k)


def _scored_with_own(rows: DataFrame, asked: DataFrame, dim: int) -> DataFrame:
    """ticker, doc_id, score of rows whose ticker has a query; the queries are a broadcast matrix,
    no vector is copied onto a row."""
    told = asked.toArrow()
    places = {ticker: i for i, ticker in enumerate(told.column("ticker").to_pylist()) if ticker is not None}
    sent = rows.sparkSession.sparkContext.broadcast((places, unit_rows(matrix(told.column("query_vector"), dim))))
    result = T.StructType([rows.schema["ticker"], rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, queries = sent.value
        for batch in batches:
            which = np.array([places.get(t, -1) for t in batch.column("ticker").to_pylist()], np.int64)
            batch, which = batch.filter(pa.array(which >= 0)), which[which >= 0]
            values = (unit_rows(matrix(batch.column("embedding"), dim)) * queries[which]).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ticker"), batch.column("doc_id"), pa.array(rounded(values), from_pandas=True)],
                names=["ticker", "doc_id", "score"],
            )

    return rows.mapInArrow(score, result)


def with_documents(found: DataFrame, corpus: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fetch document columns for what was found; texts stay out of the scoring pass.

    The found rows are written first: Spark then knows their size and broadcasts them while
    they are small, so that texts stay in place.
    """
    facts = corpus.select("doc_id", *[c for c in columns if c not in found.columns])
    return facts.join(materialize(found, "found"), "doc_id")


def top_k_documents(
    corpus: DataFrame, queries: DataFrame, columns: Sequence[str], k: int = RESULTS
) -> DataFrame:
    """`top_k` with the named document columns."""
    return with_documents(top_k(corpus, queries, k), corpus, columns)


def as_results(found: DataFrame) -> DataFrame:
    """Found documents as a reader sees them: clipped texts, a date, nothing missing."""
    return found.withColumns({
        "title": F.coalesce("title", F.lit(NO_TITLE)),
        "text": clip_marked(F.col("text"), RESULT_LENGTH),
        "date": F.coalesce("metadata_date", F.lit(NO_DATE)),
        "doc_type": F.coalesce("doc_type", F.lit(NO_TYPE)),
    }).drop("metadata_date")


def semantic_search(
    index: DataFrame,
    questions: DataFrame,
    encoder: Encoder,
    dim: int,
    *,
    doc_type: str | None = None,
    ticker: str | None = None,
    k: int = RESULTS,
) -> DataFrame:
    """Answer text questions (query_id, text) from an embedded corpus.

    The filters cut the corpus before ranking; nothing left gives an empty result.
    """
    corpus = index.filter(search_filter(doc_type, ticker))
    queries = embed(questions.select("query_id", "text"), encoder, dim, output="query_vector")
    return top_k_documents(corpus, queries, ["doc_type", "ticker", "title", "text", "metadata_date"], k)


def semantic_search_indexed(
    spark,
    index,
    questions: DataFrame,
    encoder: Encoder,
    dim: int,
    *,
    doc_type: str | None = None,
    ticker: str | None = None,
    k: int = RESULTS,
) -> DataFrame:
    """`semantic_search` over a clustered index (`vector_index`) that keeps document columns."""
    from marketlake.operators.vector_index import search_index

    queries = embed(questions.select("query_id", "text"), encoder, dim, output="query_vector")
    found = search_index(spark, index, queries, k, search_filter(doc_type, ticker))
    return with_documents(found, index.table(spark), ["doc_type", "ticker", "title", "text", "metadata_date"])


def search_news(index: DataFrame, questions: DataFrame, encoder: Encoder, dim: int, ticker: str | None = None) -> DataFrame:
    found = semantic_search(index, questions, encoder, dim, doc_type=NEWS, ticker=ticker)
    return found.withColumn("snippet", snippet(F.col("text"), NEWS_SNIPPET)).drop("text")


def search_profiles(index: DataFrame, questions: DataFrame, encoder: Encoder, dim: int) -> DataFrame:
    found = semantic_search(index, questions, encoder, dim, doc_type=COMPANY_PROFILE)
    return found.withColumn("snippet", snippet(F.col("text"), PROFILE_SNIPPET)).drop("text")


def answer_chat(index: DataFrame, questions: DataFrame, encoder: Encoder, dim: int) -> DataFrame:
    found = semantic_search(index, questions, encoder, dim, k=CHAT_RESULTS)
    return found.withColumn("snippet", snippet(F.col("text"), NEWS_SNIPPET)).drop("text")


def ticker_panel(index: DataFrame, tickers: DataFrame, encoder: Encoder, dim: int, k: int = RESULTS) -> DataFrame:
    """For every ticker, its documents nearest to the panel question about it."""
    asked = tickers.select("ticker").distinct()
    asked = asked.withColumn("question", F.concat(F.lit(PANEL_QUESTION), "ticker"))
    queries = embed(asked, encoder, dim, text="question", output="query_vector")
    found = top_k_per_ticker(index, queries, dim, k)
    return as_results(with_documents(found, index, ["doc_type", "title", "text", "metadata_date"]))
