"""A vector index that outlives its session: opened again, fed with changes, searched exactly.

Below its folder an index has the centres of its clusters, its rows in one base folder and in
delta folders, all partitioned by cluster, the ids that each delta takes away, and statistics
per cluster. A manifest names what belongs together; what it does not name yet is not there.

* `build` learns at most `MOST_CENTRES` centres from a bounded sample and places every row.
* `apply_feed` takes the commits after the version it has noted, and writes their documents
  and ids only: what is written follows the change. Rows are merged when they are read.
* `compact` writes one base again, and splits clusters that have outgrown the others.
* `search` sends each query to the clusters that may hold its answers. A cluster holds nothing
  nearer than the distance to its centre less its radius, and nothing of a ticker or a type
  that its Bloom filter does not know. Queries and clusters meet by a join in bounded blocks.

The driver holds centres, radii, sizes and filters: `MOST_CENTRES` times the dimensions and
4 KB at most. One writer at a time.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from marketlake.functions.text import ticker_of
from marketlake.functions.vectors import SCORE_DIGITS, matrix, unit_column, unit_rows
from marketlake.operators.changefeed import CURRENT_ROWS
from marketlake.operators.embed import embed
from marketlake.operators.search import RESULTS, best_pairs, rank_results, search_filter, with_documents
from marketlake.operators.vector_index import NO_DIRECTION, assigned
from marketlake.session import materialize

# Documents per cluster aimed at, and the most centres there are.
CLUSTER_ROWS = 50_000
MOST_CENTRES = 4096
# Vectors that centres are learned from.
SAMPLE_ROWS = 200_000
# Rows of a cluster, and queries, that meet in one group (a task takes several times as much);
# queries, and rows, compared together.
PART_BYTES = 16 << 20
QUERY_BLOCK = 1024
# Bits and hashes of a cluster's filter. Fixed value: what Spark's bitmap aggregate makes.
FILTER_BITS = 32_768
FILTER_HASHES = 3

_MANIFEST = "number long, base string, deltas array<string>, centres string, statistics string, feed_version long, schema string"
_CENTRES = "cluster int, centre array<double>"
_STATISTICS = "cluster int, radius double, rows long, known binary"


@dataclass(frozen=True)
class StoredIndex:
    path: str
    number: int
    base: str
    deltas: tuple[str, ...]
    centres_folder: str
    feed_version: int
    schema: T.StructType
    centres: np.ndarray
    radii: np.ndarray  # per centre; -1 where a cluster has no row
    rows: np.ndarray  # per centre, and last without direction; rows taken away count as well
    known: np.ndarray  # filter bits per centre, and last without direction

    @property
    def dim(self) -> int:
        return self.centres.shape[1]


# Files -------------------------------------------------------------------------------------


def _fresh(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def _filter_key(doc_type: Column, ticker: Column) -> Column:
    """A type, a ticker, or both, as one text; null for what is not asked."""
    return F.concat(F.coalesce(doc_type, F.lit("\x00")), F.lit("\x01"), F.coalesce(ticker, F.lit("\x00")))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(FILTER_BITS)) for i in range(FILTER_HASHES)]


def _measured(rows: DataFrame) -> DataFrame:
    """Radius, rows and filter of every cluster; the filter knows types, tickers and pairs."""
    nothing = F.lit(None).cast("string")
    keys = F.array(_filter_key(F.col("doc_type"), nothing), _filter_key(nothing, F.col("ticker")), _filter_key(F.col("doc_type"), F.col("ticker")))
    pairs = rows.groupBy("cluster", "doc_type", "ticker").agg(F.max("distance").alias("radius"), F.count("*").alias("rows"))
    counted = pairs.groupBy("cluster").agg(F.max("radius").alias("radius"), F.sum("rows").alias("rows"))
    bits = pairs.select("cluster", F.explode(keys).alias("key")).select("cluster", F.explode(F.array(*_bits(F.col("key")))).alias("bit"))
    known = bits.groupBy("cluster").agg(F.bitmap_construct_agg("bit").alias("known"))
    return counted.join(known, "cluster")


def _write_statistics(spark: SparkSession, path: str, *parts: DataFrame) -> str:
    """Statistics of several parts together: at most one row per centre."""
    folder = _fresh("statistics")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    merged = whole.groupBy("cluster").agg(
        F.max("radius").alias("radius"), F.sum("rows").alias("rows"), F.bitmap_or_agg("known").alias("known")
    )
    merged.coalesce(1).write.parquet(f"{path}/{folder}")
    return folder


def _commit(spark: SparkSession, path: str, number: int, base: str, deltas, centres: str, statistics: str, feed_version: int, schema: T.StructType) -> StoredIndex:
    row = [(number, base, list(deltas), centres, statistics, feed_version, schema.json())]
    spark.createDataFrame(row, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/_manifest")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> StoredIndex:
    """The newest complete state of an index."""
    named = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest").orderBy(F.desc("number")).first()
    if named is None:
        raise FileNotFoundError(f"no index below {path}")
    centres = spark.read.schema(_CENTRES).parquet(f"{path}/{named['centres']}").orderBy("cluster").collect()
    statistics = spark.read.schema(_STATISTICS).parquet(f"{path}/{named['statistics']}").collect()
    count = len(centres)
    radii, rows = np.full(count, -1.0), np.zeros(count + 1, np.int64)
    known = np.zeros((count + 1, FILTER_BITS // 8), np.uint8)
    for r in statistics:
        rows[r["cluster"]], known[r["cluster"]] = r["rows"], np.frombuffer(r["known"], np.uint8)
        if r["cluster"] != NO_DIRECTION:
            radii[r["cluster"]] = r["radius"]
    return StoredIndex(
        path, named["number"], named["base"], tuple(named["deltas"]), named["centres"], named["feed_version"],
        T.StructType.fromJson(json.loads(named["schema"])), np.array([r["centre"] for r in centres]), radii, rows, known,
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether an index was ever completed below a folder."""
    spark.createDataFrame([], _MANIFEST).write.mode("ignore").parquet(f"{path}/_manifest")
    return bool(spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest").take(1))


# Building ----------------------------------------------------------------------------------


def learn_centres(corpus: DataFrame, dim: int, clusters: int, seed: int = 1) -> np.ndarray:
    """Centres of unit vectors, learned from at most about `SAMPLE_ROWS` by hash of the id."""
    count = corpus.count()
    some = corpus if count <= SAMPLE_ROWS else corpus.filter(F.pmod(F.xxhash64("doc_id"), F.lit(count)) < SAMPLE_ROWS)
    unit = some.select(unit_column(F.col("embedding"), dim).alias("unit")).filter(F.col("unit").isNotNull())
    training = materialize(unit, "training-vectors").select(array_to_vector("unit").alias("features"))
    if not training.take(1):
        return np.zeros((1, dim))
    model = KMeans(k=max(clusters, 2), seed=seed, initMode="random", maxIter=5).fit(training)
    return np.array(model.clusterCenters())


def _write_centres(spark: SparkSession, path: str, centres: np.ndarray) -> str:
    folder = _fresh("centres")
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    spark.createDataFrame(rows, _CENTRES).coalesce(1).write.parquet(f"{path}/{folder}")
    return folder


def _write_rows(rows: DataFrame, path: str, folder: str) -> DataFrame:
    """Rows by cluster, files in filter order; read back."""
    rows.hint("rebalance", "cluster").sortWithinPartitions("cluster", "doc_type", "ticker").write.partitionBy("cluster").parquet(f"{path}/{folder}")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/{folder}")


def build(corpus: DataFrame, path: str, dim: int, clusters: int | None = None, feed_version: int = 0) -> StoredIndex:
    """A new index of a corpus (doc_id, doc_type, ticker, embedding, ...) with unique ids."""
    spark = corpus.sparkSession
    if clusters is None:
        clusters = min(MOST_CENTRES, -(-corpus.count() // CLUSTER_ROWS))
    centres = learn_centres(corpus, dim, clusters)
    base = _fresh("base")
    table = _write_rows(assigned(corpus, centres), path, base)
    statistics = _write_statistics(spark, path, _measured(table))
    number = open_index(spark, path).number + 1 if exists(spark, path) else 1
    return _commit(spark, path, number, base, (), _write_centres(spark, path, centres), statistics, feed_version, table.schema)


# Reading -----------------------------------------------------------------------------------


def live_rows(spark: SparkSession, index: StoredIndex, clusters: list[int] | None = None) -> DataFrame:
    """Rows of all clusters, or of some; what later deltas take away is left out."""

    def read(folder: str) -> DataFrame:
        table = spark.read.schema(index.schema).parquet(f"{index.path}/{folder}")
        return table if clusters is None else table.filter(F.col("cluster").isin(clusters))

    rows = read(index.base)
    if not index.deltas:
        return rows
    rows = rows.withColumn("_delta", F.lit(0))
    for place, folder in enumerate(index.deltas, 1):
        rows = rows.unionByName(read(f"{folder}/rows").withColumn("_delta", F.lit(place)))
    id_field = T.StructType([index.schema["doc_id"]])
    gone = [
        spark.read.schema(id_field).parquet(f"{index.path}/{folder}/gone").withColumn("_gone", F.lit(place))
        for place, folder in enumerate(index.deltas, 1)
    ]
    every = gone[0]
    for part in gone[1:]:
        every = every.unionByName(part)
    last = every.groupBy("doc_id").agg(F.max("_gone").alias("_gone"))
    met = rows.join(last, "doc_id", "left")
    return met.filter(F.col("_gone").isNull() | (F.col("_gone") <= F.col("_delta"))).drop("_gone", "_delta").select(index.schema.names)


# Changes -----------------------------------------------------------------------------------


def net_changes(feed: DataFrame, after: int) -> DataFrame:
    """The last image of every document changed after a version; `_current` says it is there."""
    new = feed.filter(F.col("_commit_version") > after)
    current = F.col("_change_type").isin(*CURRENT_ROWS)
    last = Window.partitionBy("doc_id").orderBy(F.desc("_commit_version"), F.desc(current))
    return new.withColumn("_place", F.row_number().over(last)).filter("_place = 1").withColumn("_current", current).drop("_place")


def apply_feed(spark: SparkSession, index: StoredIndex, feed: DataFrame, encode) -> StoredIndex:
    """The index after all commits of a feed that it has not taken up.

    `feed` holds changes of the corpus with their commit versions; `encode` adds `embedding` to
    documents and whatever else the index keeps. A run that fails leaves the index as it was.
    """
    newest = feed.agg(F.max("_commit_version")).first()[0]
    if newest is None or newest <= index.feed_version:
        return index
    changes = materialize(net_changes(feed.filter(F.col("_commit_version") <= newest), index.feed_version), "net-changes")
    folder = _fresh("delta")
    fresh = encode(changes.filter("_current").drop("_current", "_change_type", "_commit_version", "_commit_timestamp"))
    fresh = fresh.select([F.col(f.name).cast(f.dataType) for f in index.schema if f.name not in ("cluster", "distance")])
    placed = _write_rows(assigned(fresh, index.centres).select(index.schema.names), index.path, f"{folder}/rows")
    changes.select(F.col("doc_id").cast(index.schema["doc_id"].dataType)).write.parquet(f"{index.path}/{folder}/gone")
    statistics = _write_statistics(spark, index.path, _stored_statistics(spark, index), _measured(placed))
    return _commit(
        spark, index.path, index.number + 1, index.base, (*index.deltas, folder), index.centres_folder, statistics, newest, index.schema
    )


def _stored_statistics(spark: SparkSession, index: StoredIndex) -> DataFrame:
    named = spark.read.schema(_MANIFEST).parquet(f"{index.path}/_manifest").filter(F.col("number") == index.number).first()
    return spark.read.schema(_STATISTICS).parquet(f"{index.path}/{named['statistics']}")


def compact(spark: SparkSession, index: StoredIndex, most_rows: int = 2 * CLUSTER_ROWS) -> StoredIndex:
    """One base of all live rows. Clusters above `most_rows` are split by centres of their own,
    as long as there are less than `MOST_CENTRES`."""
    centres, split = [*index.centres], {}
    for cluster in np.flatnonzero(index.rows[:-1] > most_rows).tolist():
        parts = min(math.ceil(index.rows[cluster] / most_rows), MOST_CENTRES - len(centres) + 1)
        if parts > 1:
            first, *more = learn_centres(live_rows(spark, index, [cluster]), index.dim, parts)
            split[cluster] = [cluster, *range(len(centres), len(centres) + len(more))]
            centres[cluster] = first
            centres += more
    rows = live_rows(spark, index)
    if split:
        again = assigned(rows.drop("cluster", "distance"), np.array(centres)).select(index.schema.names)
        rows = again
    base = _fresh("base")
    table = _write_rows(rows, index.path, base)
    statistics = _write_statistics(spark, index.path, _measured(table))
    folder = _write_centres(spark, index.path, np.array(centres)) if split else index.centres_folder
    return _commit(spark, index.path, index.number + 1, base, (), folder, statistics, index.feed_version, index.schema)


# Searching ---------------------------------------------------------------------------------


def may_hold(spark: SparkSession, index: StoredIndex, doc_type: str | None, ticker: str | None) -> np.ndarray:
    """Which clusters, and last the rows without direction, may hold documents of a filter."""
    present = index.rows > 0
    if doc_type is None and ticker is None:
        return present
    kind = F.lit(doc_type).cast("string")
    name = ticker_of(F.lit(ticker)) if ticker is not None else F.lit(None).cast("string")
    bits = spark.range(1).select(*_bits(_filter_key(kind, name))).first()
    for bit in bits:
        present = present & (index.known[:, bit // 8] >> (bit % 8) & 1).astype(bool)
    return present


def _distances(centres: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Distances of unit vectors to centres; NaN for those without direction."""
    products = unit_rows(vectors) @ centres.T
    return np.sqrt(np.maximum(1 + (centres**2).sum(axis=1) - 2 * products, 0))


def _routes(asked: DataFrame, index: StoredIndex, allowed: np.ndarray, k: int, further: bool) -> DataFrame:
    """(query_id, query_vector, cluster) of the clusters a query is sent to.

    At first those nearest to it that hold k documents between them; then, given the k-th score
    found (`kth`), all others that may hold a better one, rounding allowed for.
    """
    sent = asked.sparkSession.sparkContext.broadcast((index.centres, index.radii, index.rows, allowed))

    def near(distances: np.ndarray) -> np.ndarray:
        centres, _, rows, allowed = sent.value
        chosen = np.zeros((len(distances), len(centres) + 1), bool)
        order = np.argsort(distances, axis=1)
        held = np.where(allowed[:-1], rows[:-1], 0)[order]
        before = np.cumsum(held, axis=1) - held
        np.put_along_axis(chosen, order, (before < k) & (held > 0), axis=1)
        chosen[np.isnan(distances).any(axis=1)] = allowed
        return chosen

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii, _, allowed = sent.value
        for batch in batches:
            for first in range(0, batch.num_rows, QUERY_BLOCK):
                block = batch.slice(first, QUERY_BLOCK)
                distances = _distances(centres, matrix(block.column("query_vector"), centres.shape[1]))
                chosen = near(distances)
                if further:
                    kth = block.column("kth").to_numpy(zero_copy_only=False).astype(float)
                    closest = np.maximum(distances - radii, 0)
                    best = 1 - closest**2 / 2 + 2 * 10.0**-SCORE_DIGITS
                    missing = np.isnan(kth)
                    open_ = np.zeros_like(chosen)
                    open_[:, :-1] = missing[:, None] | (best >= kth[:, None])
                    open_[missing, -1] = True
                    chosen = open_ & allowed & ~chosen
                query, cluster = np.nonzero(chosen)
                cluster = np.where(cluster == len(centres), NO_DIRECTION, cluster)
                taken = block.take(pa.array(query))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("query_id"), taken.column("query_vector"), pa.array(cluster.astype(np.int32))],
                    names=["query_id", "query_vector", "cluster"],
                )

    fields = [asked.schema["query_id"], T.StructField("query_vector", T.ArrayType(T.DoubleType())), T.StructField("cluster", T.IntegerType())]
    return asked.mapInArrow(route, T.StructType(fields))


def _scored(spark: SparkSession, index: StoredIndex, routes: DataFrame, k: int, keep: Column) -> DataFrame:
    """The k best rows of every route. A cluster is cut in parts and its queries in blocks; a part
    and a block meet in matrix products of bounded size."""
    wanted = routes.groupBy("cluster").agg(F.count("*").alias("queries")).collect()  # one row per centre at most
    part_rows = max(1, PART_BYTES // (8 * index.dim))
    sizes = [
        (r["cluster"], int(-(-index.rows[r["cluster"]] // part_rows)) or 1, -(-r["queries"] // part_rows)) for r in wanted
    ]
    cut = F.broadcast(spark.createDataFrame(sizes, "cluster int, parts long, blocks long"))

    def pieces(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rows = live_rows(spark, index, [c for c, _, _ in sizes]).filter(keep).select("doc_id", "embedding", "cluster").join(cut, "cluster")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts"))).withColumn("block", pieces("blocks"))
    asked = routes.join(cut, "cluster")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks"))).withColumn("part", pieces("parts"))
    result = T.StructType([routes.schema["query_id"], index.schema["doc_id"], T.StructField("score", T.DoubleType())])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in result])
    dim = index.dim

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        queries = unit_rows(matrix(right.column("query_vector"), dim))
        ids = right.column("query_id").combine_chunks()
        return pa.Table.from_batches(best_pairs(left.select(["doc_id", "embedding"]), ids, queries, k, arrow, QUERY_BLOCK), schema=arrow)

    keys = ["cluster", "part", "block"]
    return rows.select("doc_id", "embedding", *keys).groupBy(*keys).cogroup(
        asked.select("query_id", "query_vector", *keys).groupBy(*keys)
    ).applyInArrow(score, result)


def search(
    spark: SparkSession, index: StoredIndex, queries: DataFrame, k: int = RESULTS, doc_type: str | None = None, ticker: str | None = None
) -> DataFrame:
    """The k nearest documents of every query (query_id, query_vector), as a full search finds them."""
    vector = F.col("query_vector").cast("array<double>").alias("query_vector")
    asked = materialize(queries.select("query_id", vector), "asked")
    allowed = may_hold(spark, index, doc_type, ticker)
    keep = search_filter(doc_type, ticker)
    first = materialize(_routes(asked, index, allowed, k, further=False), "routes")
    near = materialize(rank_results(_scored(spark, index, first, k, keep), k).drop("rank"), "near")
    found = near.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("score").alias("n"))
    kth = F.when(F.col("n") >= k, F.col("kth")).cast("double").alias("kth")
    worst = asked.join(found, "query_id", "left").select("query_id", "query_vector", kth)
    second = materialize(_routes(worst, index, allowed, k, further=True), "further-routes")
    return rank_results(near.unionByName(_scored(spark, index, second, k, keep)), k)


def semantic_search(
    spark: SparkSession, index: StoredIndex, questions: DataFrame, encoder, *, doc_type: str | None = None, ticker: str | None = None, k: int = RESULTS
) -> DataFrame:
    """Answer text questions (query_id, text) from an index that keeps document columns."""
    queries = embed(questions.select("query_id", "text"), encoder, index.dim, output="query_vector")
    found = search(spark, index, queries, k, doc_type, ticker)
    return with_documents(found, live_rows(spark, index), ["doc_type", "ticker", "title", "text", "metadata_date"])
