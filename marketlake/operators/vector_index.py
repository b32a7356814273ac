"""A vector index as a table partitioned by cluster, searched exactly.

Unit vectors are assigned to the nearest of a few centres. For a query, no member of a
cluster can be nearer than the distance to its centre less the cluster's radius. A search
reads the clusters nearest to the queries, and then only those that could still hold a
better document than the k-th found; the others are skipped as partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.vectors import SCORE_DIGITS, matrix, unit_column, unit_rows
from marketlake.operators.search import RESULTS, rank_results, scored
from marketlake.session import materialize

# Documents per cluster aimed at; the number of clusters follows the corpus.
CLUSTER_ROWS = 50_000
NO_DIRECTION = -1

_ASSIGNED = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.DoubleType())])


@dataclass(frozen=True)
class ClusteredIndex:
    path: str
    schema: T.StructType
    centres: np.ndarray
    radii: np.ndarray  # per centre; -1 where a cluster has no member
    sizes: np.ndarray

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)

    def read(self, spark: SparkSession, clusters: list[int]) -> DataFrame:
        return self.table(spark).filter(F.col("cluster").isin(clusters))


def learn_centres(corpus: DataFrame, dim: int, clusters: int, seed: int = 1) -> np.ndarray:
    """Cluster centres of all unit vectors; none where there is no vector with a direction."""
    unit = corpus.select(unit_column(F.col("embedding"), dim).alias("unit"))
    training = unit.filter(F.col("unit").isNotNull()).select(array_to_vector("unit").alias("features"))
    if not training.take(1):
        return np.zeros((1, dim))
    model = KMeans(k=max(clusters, 2), seed=seed, initMode="random", maxIter=5).fit(training)
    return np.array(model.clusterCenters())


def assigned(corpus: DataFrame, centres: np.ndarray) -> DataFrame:
    """Add the nearest centre and the distance to it; vectors without direction stand apart."""
    dim = centres.shape[1]

    @F.arrow_udf(_ASSIGNED)
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            unit = unit_rows(matrix(batch, dim))
            usable = ~np.isnan(unit[:, 0])
            squared = (centres**2).sum(axis=1) - 2 * np.nan_to_num(unit) @ centres.T
            cluster = np.where(usable, squared.argmin(axis=1), NO_DIRECTION)
            distance = np.linalg.norm(np.nan_to_num(unit) - centres[cluster], axis=1)
            yield pa.StructArray.from_arrays(
                [pa.array(cluster.astype(np.int32)), pa.array(np.where(usable, distance, 0.0))],
                names=["cluster", "distance"],
            )

    return corpus.withColumn("_near", nearest("embedding")).select(*corpus.columns, "_near.*")


def build_index(corpus: DataFrame, path: str, dim: int, clusters: int | None = None) -> ClusteredIndex:
    """Write the corpus (doc_id, embedding, ...) by cluster, and measure the clusters."""
    spark = corpus.sparkSession
    if clusters is None:
        clusters = -(-corpus.count() // CLUSTER_ROWS)
    centres = learn_centres(corpus, dim, clusters)
    near = assigned(corpus, centres)
    near.hint("rebalance", "cluster").write.partitionBy("cluster").parquet(path)
    table = spark.read.schema(near.schema).parquet(path)
    radii, sizes = np.full(len(centres), -1.0), np.zeros(len(centres), dtype=int)
    measured = table.filter(F.col("cluster") != NO_DIRECTION).groupBy("cluster")
    for row in measured.agg(F.max("distance").alias("radius"), F.count("*").alias("size")).collect():
        radii[row["cluster"]], sizes[row["cluster"]] = row["radius"], row["size"]
    return ClusteredIndex(path, near.schema, centres, radii, sizes)


def _clusters(queries: DataFrame, function) -> set[int]:
    """The clusters that any query names: at most as many as there are."""
    named = queries.mapInArrow(function, "cluster int").distinct().collect()
    return {row["cluster"] for row in named}


def _distances(index: ClusteredIndex, batch: pa.RecordBatch) -> np.ndarray:
    """Distances of a batch's queries to the centres; NaN for queries without direction."""
    dim = index.centres.shape[1]
    unit = unit_rows(np.array(batch.column("query_vector").to_pylist(), dtype=float).reshape(-1, dim))
    products = unit @ index.centres.T
    return np.sqrt(np.maximum(1 + (index.centres**2).sum(axis=1) - 2 * products, 0))


def _named(clusters: set[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(sorted(clusters), pa.int32())], names=["cluster"])


def _nearest(index: ClusteredIndex, k: int):
    """For each query the nearest clusters that hold k documents between them. One without
    direction scores null everywhere: any documents do, those with the smallest ids."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: set[int] = set()
        for batch in batches:
            for row in _distances(index, batch):
                if np.isnan(row).any():
                    chosen.update([*np.flatnonzero(index.sizes).tolist(), NO_DIRECTION])
                    continue
                order = np.argsort(row)
                needed = np.searchsorted(np.cumsum(index.sizes[order]), k) + 1
                chosen.update(int(c) for c in order[:needed] if index.sizes[c])
        yield _named(chosen)

    return choose


def _still_open(index: ClusteredIndex):
    """Clusters that could hold a score of at least the k-th found, rounding allowed for."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: set[int] = set()
        for batch in batches:
            kth = batch.column("kth").to_numpy(zero_copy_only=False).astype(float)
            closest = np.maximum(_distances(index, batch) - index.radii, 0)
            best = 1 - closest**2 / 2 + 2 * 10.0**-SCORE_DIGITS
            missing = np.isnan(kth)
            possible = (missing[:, None] | (best >= kth[:, None])) & (index.sizes > 0)
            chosen.update(np.flatnonzero(possible.any(axis=0)).tolist())
            if missing.any():
                chosen.add(NO_DIRECTION)
        yield _named(chosen)

    return choose


def search_index(
    spark: SparkSession, index: ClusteredIndex, queries: DataFrame, k: int = RESULTS, keep: Column | None = None
) -> DataFrame:
    """The same result as `top_k` over the corpus (or the rows to `keep`), from the clusters
    that matter to any of the queries.

    The driver sees numbers of clusters only. A filter may leave less than k documents in the
    nearest clusters; then all clusters are still open.
    """
    asked = materialize(queries.select("query_id", F.col("query_vector").cast("array<double>").alias("query_vector")), "asked")
    chosen = F.lit(True) if keep is None else keep
    first = _clusters(asked, _nearest(index, k))
    near = materialize(rank_results(scored(index.read(spark, sorted(first)).filter(chosen), asked, k), k).drop("rank"), "near")
    found = near.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("score").alias("n"))
    worst = asked.join(found, "query_id", "left").select(
        "query_vector", F.when(F.col("n") >= k, F.col("kth")).alias("kth")
    )
    further = _clusters(worst, _still_open(index)) - first
    if not further:
        return rank_results(near, k)
    rest = scored(index.read(spark, sorted(further)).filter(chosen), asked, k)
    return rank_results(near.unionByName(rest), k)
