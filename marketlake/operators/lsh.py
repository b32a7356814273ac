"""Approximate search by random-hyperplane hashing, in several tables with several probes.

A vector's bucket in a table is the sides of some hyperplanes it lies on. A query looks into its
own bucket of each table and into those behind the planes nearest to it; what it finds there is
scored exactly, so a result is wrong only by what it lacks.

* Every row is indexed in every table. The number of planes follows the number of rows.
* Vectors that are equal score equally with any query: of each, the `copies` smallest ids are
  kept, which is all that a search for as many results can return. A bucket full of copies does
  not arise, and nothing is lost.
* A bucket above `SPLIT_ROWS` is split by a second hash: planes through the mean of its own
  vectors, not through zero, so that vectors close together part. It is probed likewise.

Buckets and queries meet by a cogroup, in matrix products; no vector is copied onto a pair. The
driver holds the planes, and one mean per split bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.vectors import list_array, matrix, unit_rows
from marketlake.operators.search import QUERY_BLOCK, RESULTS, best_pairs, pair_schema, rank_results
from marketlake.session import materialize

TABLES = 12
PROBES = 12
# Rows per bucket aimed at; rows from which a bucket is split.
BUCKET_ROWS = 256
SPLIT_ROWS = 4 * BUCKET_ROWS
MOST_PLANES = 24
SECOND_PLANES = 16
# Rows, or queries, of a bucket that meet in one piece; bytes of vectors that meet in a cell of them.
PIECE_ROWS = 16 * BUCKET_ROWS
CELL_BYTES = 16 << 20

_CODES = "array<long>"


@dataclass(frozen=True)
class HashIndex:
    rows: DataFrame  # bucket, doc_id, embedding
    planes: np.ndarray  # table, plane, dimension
    second: np.ndarray  # plane, dimension
    # Split buckets: planes of the second hash that each uses, and the mean they pass through.
    depths: dict[int, int]
    means: dict[int, np.ndarray]
    dim: int
    copies: int


def planes(tables: int, bits: int, dim: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables, bits, dim))


def sides(unit: np.ndarray, normals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket number in every table (row, table), and distances from the planes (row, table, plane)."""
    margins = np.einsum("nd,tbd->ntb", unit, normals, optimize=True)
    weights = 1 << np.arange(normals.shape[1], dtype=np.int64)
    return ((margins > 0) * weights).sum(axis=2), margins


def bucket_ids(codes: np.ndarray) -> np.ndarray:
    """One number per table and bucket."""
    return (np.arange(codes.shape[1], dtype=np.int64) << MOST_PLANES) | codes


def second_ids(buckets: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Numbers of the parts of split buckets; those of whole buckets are part 0."""
    return (buckets << SECOND_PLANES) | codes


def nearest_probes(code: int, margins: np.ndarray, probes: int) -> list[int]:
    """Buckets by what it costs to cross to them, the own one first.

    Crossing costs the squares of the distances from the planes crossed. Sets of planes are made
    in order of cost from the planes sorted by distance: by taking the next one in, or instead of
    the last.
    """
    import heapq

    order = np.argsort(np.abs(margins))
    cost = (margins[order] ** 2).tolist()
    found, waiting = [code], [(cost[0], (0,))] if len(cost) else []
    while waiting and len(found) < probes:
        total, crossed = heapq.heappop(waiting)
        flipped = code
        for i in crossed:
            flipped ^= 1 << int(order[i])
        found.append(flipped)
        following = crossed[-1] + 1
        if following < len(cost):
            heapq.heappush(waiting, (total + cost[following], (*crossed, following)))
            heapq.heappush(waiting, (total - cost[following - 1] + cost[following], (*crossed[:-1], following)))
    return found


def distinct_vectors(corpus: DataFrame, copies: int) -> DataFrame:
    """doc_id, embedding with the smallest ids of each vector; ranks are cut in the map tasks."""
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("doc_id"))
    rows = corpus.select("doc_id", "embedding").withColumn("_place", place)
    return rows.filter(F.col("_place") <= copies).drop("_place")


def _in_buckets(rows: DataFrame, normals: np.ndarray, dim: int) -> DataFrame:
    """Every row once per table; rows without direction have no bucket."""
    sent = rows.sparkSession.sparkContext.broadcast(normals)

    @F.arrow_udf(_CODES)
    def codes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            unit = unit_rows(matrix(batch, dim))
            found, _ = sides(np.nan_to_num(unit), sent.value)
            mask = np.isnan(unit[:, 0])
            yield pa.array([None if m else row for m, row in zip(mask, bucket_ids(found).tolist())], pa.list_(pa.int64()))

    return rows.select(F.explode(codes("embedding")).alias("bucket"), "doc_id", "embedding")


def build(corpus: DataFrame, dim: int, tables: int = TABLES, copies: int = RESULTS, bucket_rows: int = BUCKET_ROWS, split_rows: int = SPLIT_ROWS, seed: int = 1) -> HashIndex:
    """Index every row of a corpus (doc_id, embedding) with unique ids."""
    kept = materialize(distinct_vectors(corpus, copies), "distinct-vectors")
    count = kept.count()
    bits = min(MOST_PLANES, max(1, round(math.log2(max(count, 2) / bucket_rows))))
    normals, second = planes(tables, bits, dim, seed), planes(1, SECOND_PLANES, dim, seed + 1)[0]
    rows = materialize(_in_buckets(kept, normals, dim), "buckets")
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("rows")).filter(F.col("rows") > split_rows)
    # At most tables x rows / split_rows buckets.
    depths = {
        r["bucket"]: min(SECOND_PLANES, math.ceil(math.log2(r["rows"] / bucket_rows))) for r in sizes.collect()
    }
    means = _means(rows, depths, dim)
    split = _split(rows, second, depths, means, dim)
    return HashIndex(materialize(split, "split-buckets"), normals, second, depths, means, dim, copies)


def _means(rows: DataFrame, depths: dict[int, int], dim: int) -> dict[int, np.ndarray]:
    """Mean unit vector of each split bucket, summed per task first."""
    hot = rows.filter(F.col("bucket").isin(list(depths))) if depths else rows.limit(0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            unit, buckets = np.nan_to_num(unit_rows(matrix(batch.column("embedding"), dim))), batch.column("bucket").to_numpy()
            for bucket in np.unique(buckets).tolist():
                mine = unit[buckets == bucket]
                sums[bucket] = sums.get(bucket, 0) + np.append(mine.sum(axis=0), len(mine))
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), list_array(np.array(list(sums.values())))], names=["bucket", "total"])

    parts = hot.select("bucket", "embedding").mapInArrow(add, "bucket long, total array<double>")
    places = parts.select("bucket", F.posexplode("total").alias("place", "value")).groupBy("bucket", "place").agg(F.sum("value").alias("value"))
    whole = places.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("total"))
    totals = {r["bucket"]: np.array([x["value"] for x in r["total"]]) for r in whole.collect()}
    return {bucket: total[:-1] / total[-1] for bucket, total in totals.items()}


def _parts(unit: np.ndarray, bucket: int, second: np.ndarray, depths: dict, means: dict) -> tuple[np.ndarray, np.ndarray]:
    """Second hash of vectors in a split bucket, and the distances from its planes."""
    margins = (unit - means[bucket]) @ second[: depths[bucket]].T
    return ((margins > 0) * (1 << np.arange(depths[bucket], dtype=np.int64))).sum(axis=1), margins


def _split(rows: DataFrame, second: np.ndarray, depths: dict, means: dict, dim: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast((second, depths, means))

    @F.arrow_udf("long")
    def part(bucket: pa.Array, vectors: pa.Array) -> pa.Array:
        second, depths, means = sent.value
        buckets = bucket.to_numpy()
        codes = np.zeros(len(buckets), np.int64)
        hot = [b for b in np.unique(buckets).tolist() if b in depths]
        if hot:
            unit = np.nan_to_num(unit_rows(matrix(vectors, dim)))
            for b in hot:
                mine = np.flatnonzero(buckets == b)
                codes[mine] = _parts(unit[mine], b, second, depths, means)[0]
        return pa.array(second_ids(buckets, codes))

    return rows.select(part("bucket", "embedding").alias("bucket"), "doc_id", "embedding")


def _probes(queries: DataFrame, index: HashIndex, probes: int) -> DataFrame:
    """(query_id, query_vector) with the buckets to look into."""
    sent = queries.sparkSession.sparkContext.broadcast((index.planes, index.second, index.depths, index.means))
    dim = index.dim

    @F.arrow_udf(_CODES)
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        normals, second, depths, means = sent.value
        for batch in batches:
            unit = unit_rows(matrix(batch, dim))
            codes, margins = sides(np.nan_to_num(unit), normals)
            found = []
            for row in range(len(unit)):
                if np.isnan(unit[row, 0]):
                    found.append(None)
                    continue
                mine = []
                for table in range(len(normals)):
                    for code in nearest_probes(int(codes[row, table]), margins[row, table], probes):
                        bucket = table << MOST_PLANES | code
                        if bucket in depths:
                            own, away = _parts(unit[row : row + 1], bucket, second, depths, means)
                            mine += [bucket << SECOND_PLANES | c for c in nearest_probes(int(own[0]), away[0], probes)]
                        else:
                            mine.append(bucket << SECOND_PLANES)
                found.append(mine)
            yield pa.array(found, pa.list_(pa.int64()))

    return queries.select("query_id", "query_vector", F.explode(look("query_vector")).alias("bucket"))


def _cuts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(bucket, parts, blocks) of the buckets that more than `PIECE_ROWS` rows or queries meet in:
    at most as many as there are such pieces."""
    counted = rows.groupBy("bucket").agg(F.count("*").alias("rows"), F.lit(0).cast("long").alias("queries"))
    probed = asked.groupBy("bucket").agg(F.lit(0).cast("long").alias("rows"), F.count("*").alias("queries"))
    sizes = counted.unionByName(probed).groupBy("bucket").agg(F.max("rows").alias("rows"), F.max("queries").alias("queries"))
    many = sizes.filter((F.col("rows") > PIECE_ROWS) | (F.col("queries") > PIECE_ROWS)).filter("rows > 0 and queries > 0")
    cuts = [(r["bucket"], -(-r["rows"] // PIECE_ROWS), -(-r["queries"] // PIECE_ROWS)) for r in many.collect()]
    return rows.sparkSession.createDataFrame(cuts, "bucket long, parts long, blocks long")


def _scored(index: HashIndex, asked: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query in every piece of a bucket it looks into.

    Rows and queries of a bucket meet in a matrix product. Buckets are dealt to cells of a bounded
    size; one with many rows or queries is cut in parts and blocks first.
    """
    rows, dim = index.rows, index.dim
    cuts = F.broadcast(_cuts(rows, asked))
    cells = max(1, -(-(rows.count() + asked.count()) * 8 * dim // CELL_BYTES))

    def pieces(table: DataFrame, key: str, own: str, other: str) -> DataFrame:
        cut = table.join(cuts, "bucket", "left")
        parts = [F.coalesce(n, F.lit(1)) for n in (own, other)]
        mine = F.pmod(F.xxhash64(key), parts[0])
        cut = cut.select("*", mine.alias("_own"), F.explode(F.sequence(F.lit(0).cast("long"), parts[1] - 1)).alias("_other"))
        place = [F.col(c) for c in (("_own", "_other") if own == "parts" else ("_other", "_own"))]
        cut = cut.withColumn("piece", F.xxhash64("bucket", *place))
        return cut.select(*[c for c in table.columns if c != "bucket"], "piece", F.pmod("piece", F.lit(cells)).alias("cell"))

    result, arrow = pair_schema(asked, rows)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.sort_by("piece").combine_chunks(), right.sort_by("piece").combine_chunks()
        held, wanted = (t.column("piece").to_numpy() for t in (left, right))
        found: list[pa.RecordBatch] = []
        for piece in np.intersect1d(held, wanted).tolist():
            (a, b), (c, d) = (np.searchsorted(x, [piece, piece + 1]).tolist() for x in (held, wanted))
            queries = right.slice(c, d - c)
            unit = unit_rows(matrix(queries.column("query_vector"), dim))
            ids = queries.column("query_id").combine_chunks()
            found += best_pairs(left.slice(a, b - a).select(["doc_id", "embedding"]), ids, unit, k, arrow, QUERY_BLOCK)
        return pa.Table.from_batches(found, schema=arrow)

    held = pieces(rows, "doc_id", "parts", "blocks").groupBy("cell")
    return held.cogroup(pieces(asked, "query_id", "blocks", "parts").groupBy("cell")).applyInArrow(meet, result)


def knn_lsh(index: HashIndex, queries: DataFrame, k: int = RESULTS, probes: int = PROBES) -> DataFrame:
    """query_id, doc_id, score, rank of the best rows found in the probed buckets.

    Scores are exact. A row can be found once per table; so many times k rows per query and
    task are kept until they are told apart. Rows and queries without direction find nothing.
    """
    if k > index.copies:
        raise ValueError(f"the index keeps {index.copies} copies of a vector, less than {k}")
    vector = F.col("query_vector").cast("array<double>").alias("query_vector")
    asked = materialize(_probes(queries.select("query_id", vector), index, probes), "probes")
    found = rank_results(_scored(index, asked, k), k * len(index.planes)).drop("rank")
    return rank_results(found.distinct(), k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """queries, wanted, hits: how many of the exact results a search has found.

    A document counts when its score reaches the last exact one, so that ties do not matter.
    """
    worst = exact.groupBy("query_id").agg(F.min("score").alias("_kth"), F.count("*").alias("_wanted"))
    good = found.join(worst, "query_id").filter(F.col("score") >= F.col("_kth"))
    hits = good.groupBy("query_id").agg(F.least(F.count("*"), F.first("_wanted")).alias("_hits"))
    return worst.join(hits, "query_id", "left").agg(
        F.count("*").alias("queries"), F.sum("_wanted").alias("wanted"), F.coalesce(F.sum("_hits"), F.lit(0)).alias("hits")
    )
