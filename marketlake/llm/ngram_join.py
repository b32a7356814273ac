"""Join of documents whose sets of word n-grams have a high Jaccard similarity, all of them.

A document is a row of a sparse incidence matrix, its columns the hashes of its n-grams.
Documents with equal rows form a class. The product of the matrix with its transpose has the
overlaps; it is computed in blocks of columns and only where a pair can reach the threshold:

1. Two similar rows share a column among the first n - ceil(t n) + 1 of both, whatever the
   order of the columns, as long as it is the same. Columns are ordered by how often their
   fold occurs (a table of fixed size, counted over all documents), so frequent passages come
   last. Only those entries are shuffled, by block of columns.
2. In a block, documents of a column make pairs unless their sizes, or what is left of both
   rows behind the column, rule the threshold out.
3. Folded rows (two bytes per column) bound the overlap from above and discard most others.
4. The overlaps of what remains are counted over whole rows and held against the threshold.

A column that many documents share would give pairs of all with all. There, only three of
its documents are paired with each other one; links are verified and components formed. Then
the folded rows of the column's documents are multiplied in the task, block by block. Of the
pairs of different components that pass the bound, a second turn verifies as many as could
connect them all, and a third turn every one that still lies between components. No link
between components is lost, and no pair inside one is needed.

The threshold is exact in whole numbers. n-grams and classes are 64-bit hashes. Words: ASCII letters in lower case, split at ASCII white space. A text
with fewer words than n has one n-gram, all of them; null and empty texts have none and link
with nothing. Copies are one class whatever their number. Very long texts are one row of 8
bytes per n-gram. Null ids take part but never name a component unless all its ids are null.
Empty tables give empty results; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.components import components
from marketlake.operators.keys import attach
from marketlake.session import materialize

N = 4
THRESHOLD = 85  # percent
# Columns folded for their frequencies, counted in that many blocks.
FREQUENCY_FOLDS = 1 << 20
FREQUENCY_BLOCKS = 64
# Documents of a column that are paired all with all; beyond, three of them with the others.
ALL_PAIRS = 12
# Rows of a column and their entries in one part (two parts meet in a task), and columns
# multiplied at a time.
PART_ROWS = 2000
PART_ENTRIES = 4_000_000
PRODUCT_COLUMNS = 4096
ID_BYTES = 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xBF58476D1CE4E5B9)
SETS = "doc_id long, key long, size long, class long, print binary, folds binary, block int, counts binary"
POSTINGS = "block int, columns binary, classes binary, sizes binary, places binary"
CANDIDATES = "a long, b long, column long, class long, size long, place long"


class Rows(NamedTuple):
    """documents: doc_id, key, size, class; classes: class, size, folds, key of a row; frequencies per fold."""

    documents: DataFrame
    classes: DataFrame
    frequencies: np.ndarray


# Rows of the matrix ------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIXER
    return x ^ (x >> np.uint64(27))


def row(text: bytes, n: int = N) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text."""
    words = text.lower().split()
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    if not width:
        return hashed
    grams = np.zeros(len(words) - width + 1, np.uint64)
    for at in range(width):
        grams = _mixed(grams * _MULTIPLIER + hashed[at : at + len(grams)])
    return np.unique(grams)


def fingerprint(columns: np.ndarray) -> bytes:
    return hashlib.blake2b(columns.tobytes(), digest_size=16).digest()


def class_of(print_: bytes) -> int:
    return int.from_bytes(print_[:8], "little", signed=True)


def folded(columns: np.ndarray) -> np.ndarray:
    """The upper two bytes of a row's columns, in order; two columns may share a fold."""
    return (columns >> np.uint64(48)).astype("<u2")


def _told_apart(folds: np.ndarray) -> np.ndarray:
    """Folds with their number among equal ones: overlaps of multisets as overlaps of sets."""
    starts = np.flatnonzero(np.concatenate([[True], np.diff(folds) != 0])) if len(folds) else np.zeros(0, np.int64)
    nth = np.arange(len(folds)) - np.repeat(starts, np.diff(np.append(starts, len(folds))))
    return folds.astype(np.int64) + (nth << 16)


def _frequency_fold(columns: np.ndarray) -> np.ndarray:
    return (columns % np.uint64(FREQUENCY_FOLDS)).astype(np.int64)


def row_key(docs: DataFrame) -> Column:
    """Names a document by its id and text."""
    return F.xxhash64(F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.coalesce(docs["text"], F.lit("")))


def rows(docs: DataFrame, n: int = N) -> Rows:
    """Sizes, classes and folded rows of all documents, and the frequencies of the columns."""
    names = [c.split(" ")[0] for c in SETS.split(", ")]
    types = [*[pa.int64()] * 4, pa.binary(), pa.binary(), pa.int32(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequencies = np.zeros(FREQUENCY_FOLDS, np.int64)
        for batch in batches:
            out: list[tuple] = []
            ids = [batch.column(c).to_pylist() for c in ("doc_id", "key")]
            for doc_id, key, text in zip(*ids, _texts(batch)):
                columns = row(text, n)
                print_ = fingerprint(columns)
                folds = folded(columns).tobytes() if len(columns) else b""
                out.append((doc_id, key, len(columns), class_of(print_), print_, folds, None, None))
                np.add.at(frequencies, _frequency_fold(columns), 1)
            yield _batch(out, names, types)
        blocks = frequencies.reshape(FREQUENCY_BLOCKS, -1)
        yield _batch(
            [(*[None] * 6, i, block.tobytes()) for i, block in enumerate(blocks) if block.any()],
            names,
            types,
        )

    texts = docs.select("doc_id", row_key(docs).alias("key"), "text")
    read_ = materialize(texts.mapInArrow(read, SETS), "ngram-rows")

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(counts, np.int64) for counts in part["counts"])
        return pd.DataFrame({"block": part["block"].iloc[:1], "counts": [total.tobytes()]})

    counted = read_.filter("block is not null").select("block", "counts").groupBy("block")
    frequencies = np.zeros((FREQUENCY_BLOCKS, FREQUENCY_FOLDS // FREQUENCY_BLOCKS), np.int64)
    # A table of fixed size.
    for found in counted.applyInPandas(add, "block int, counts binary").collect():
        frequencies[found["block"]] = np.frombuffer(found["counts"], np.int64)
    documents = read_.filter("block is null").select("doc_id", "key", "size", "class", "folds")
    classes = documents.filter("size > 0").groupBy("class").agg(
        F.min("key").alias("key"), F.max("size").alias("size"), F.max("folds").alias("folds")
    )
    return Rows(documents.drop("folds"), classes, frequencies.reshape(-1))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]


def _batch(out: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


# Candidates --------------------------------------------------------------------------------


def prefix_length(size: int, threshold: int) -> int:
    return size - -(-threshold * size // 100) + 1


def needed(size_a, size_b, threshold: int):
    """The least overlap of two rows that reach the threshold."""
    return -(-threshold * (size_a + size_b) // (100 + threshold))


def postings(docs: DataFrame, frequencies: np.ndarray, blocks: int, n: int, threshold: int) -> DataFrame:
    """First entries of all rows, packed by block of columns; copies within a task count once."""
    sent = docs.sparkSession.sparkContext.broadcast(frequencies)
    names = [c.split(" ")[0] for c in POSTINGS.split(", ")]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            parts: list[tuple[np.ndarray, int, int]] = []
            for text in _texts(batch):
                columns = row(text, n)
                class_ = class_of(fingerprint(columns))
                if not len(columns) or class_ in seen:
                    continue
                seen.add(class_)
                order = np.lexsort((columns, sent.value[_frequency_fold(columns)]))
                parts.append((columns[order[: prefix_length(len(columns), threshold)]], class_, len(columns)))
            if not parts:
                continue
            lengths = [len(c) for c, _, _ in parts]
            columns = np.concatenate([c for c, _, _ in parts])
            classes = np.repeat(np.array([c for _, c, _ in parts], np.int64), lengths)
            sizes = np.repeat(np.array([s for _, _, s in parts], np.uint32), lengths)
            places = np.concatenate([np.arange(k, dtype=np.uint32) for k in lengths])
            block = (columns % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            out = []
            for part in np.split(order, cuts):
                arrays = [x[part].tobytes() for x in (columns, classes, sizes, places)]
                out.append((int(block[part[0]]), *arrays))
            yield _batch(out, names, types)

    return docs.select("text").mapInArrow(read, POSTINGS)


def possible(size_a, place_a, size_b, place_b, threshold: int):
    """Whether rows whose first common column stands at these places can reach the threshold."""
    rest = np.minimum(size_a - place_a, size_b - place_b)
    return (rest >= needed(size_a, size_b, threshold)) & (
        100 * np.minimum(size_a, size_b) >= threshold * np.maximum(size_a, size_b)
    )


def _pairs_of_run(m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in a column's list of documents that are paired in the first turn."""
    if m <= ALL_PAIRS:
        return np.triu_indices(m, 1)
    heads = np.repeat([0, m // 2, m - 1], m)
    others = np.tile(np.arange(m), 3)
    apart = heads != others
    return heads[apart], others[apart]


def first_turn(packed: DataFrame, threshold: int) -> DataFrame:
    """Candidate pairs (a < b) of each block, and the entries of columns that many share."""

    def pair(part: pd.DataFrame) -> pd.DataFrame:
        columns = np.frombuffer(b"".join(part["columns"]), np.uint64)
        classes = np.frombuffer(b"".join(part["classes"]), np.int64)
        sizes = np.frombuffer(b"".join(part["sizes"]), np.uint32).astype(np.int64)
        places = np.frombuffer(b"".join(part["places"]), np.uint32).astype(np.int64)
        order = np.lexsort((classes, sizes, columns))
        columns, classes, sizes, places = columns[order], classes[order], sizes[order], places[order]
        if len(columns):
            new = np.concatenate([[True], (np.diff(columns) != 0) | (np.diff(classes) != 0)])
            columns, classes, sizes, places = columns[new], classes[new], sizes[new], places[new]
        starts = np.flatnonzero(np.concatenate([[True], columns[1:] != columns[:-1]])) if len(columns) else []
        lengths = np.diff(np.append(starts, len(columns))).astype(np.int64)
        left, right, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for m in np.unique(lengths[lengths > 1]).tolist():
            first, second = _pairs_of_run(m)
            at = np.asarray(starts)[lengths == m][:, None]
            left.append((at + first).ravel())
            right.append((at + second).ravel())
            if m > ALL_PAIRS:
                many.append((at + np.arange(m)).ravel())
        i, j = np.concatenate(left), np.concatenate(right)
        keep = possible(sizes[i], places[i], sizes[j], places[j], threshold)
        pairs = np.stack([classes[i[keep]], classes[j[keep]]], axis=1)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0) if len(pairs) else pairs
        shared = np.concatenate(many) if many else np.zeros(0, np.int64)
        none = [None] * len(shared)
        return pd.concat(
            [
                pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]}, dtype="Int64"),
                pd.DataFrame(
                    {
                        "a": pd.array(none, "Int64"),
                        "b": pd.array(none, "Int64"),
                        "column": columns[shared].view(np.int64),
                        "class": classes[shared],
                        "size": sizes[shared],
                        "place": places[shared],
                    }
                ).astype("Int64"),
            ]
        ).reindex(columns=["a", "b", "column", "class", "size", "place"]).astype("Int64")

    return packed.groupBy("block").applyInPandas(pair, CANDIDATES)


def later_turn(
    shared: DataFrame,
    classes: DataFrame,
    roots: DataFrame,
    threshold: int,
    connect: bool,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Pairs of documents of a column that lie in different components and pass the bound; with
    `connect` only as many as would connect what they can.

    Columns are summed up by partial aggregates and the sums brought to the rows where they
    lie, so a column's rows meet in a task only part by part.
    """
    named = shared.join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("root", F.coalesce("root", "class"))
    parts = F.ceil(F.greatest(F.count("*") / part_rows, F.sum("size") / PART_ENTRIES)).cast("long")
    open_ = named.groupBy("column").agg(F.min("root").alias("low"), F.max("root").alias("high"), parts.alias("parts"))
    open_ = materialize(open_.filter("low < high").select("column", "parts"), "ngram-open-columns")
    rest = attach(named, open_, ["column"], spread=["class"], row_bytes=ID_BYTES)
    # A column of many documents is cut into parts, and each two parts meet in a group.
    rest = rest.withColumn("part", F.pmod(F.xxhash64("class"), "parts"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rest = rest.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
    rest = rest.join(classes.select("class", "folds"), "class")

    def pair(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = pd.concat(list(batches)).sort_values(["size", "class"])
        size, place = group["size"].to_numpy(), group["place"].to_numpy()
        class_, root, part = group["class"].to_numpy(), group["root"].to_numpy(), group["part"].to_numpy()
        most = overlaps([np.frombuffer(f, "<u2") for f in group["folds"]])
        label = root.copy()
        for at in range(len(group)):
            others = slice(at + 1, len(group))
            apart = label[others] != label[at]
            if key[1] != key[2]:
                apart &= part[others] != part[at]
            keep = (
                apart
                & (most[at, others] >= needed(size[at], size[others], threshold))
                & possible(size[at], place[at], size[others], place[others], threshold)
            )
            chosen = np.flatnonzero(keep) + at + 1
            if connect and len(chosen):
                met, first = np.unique(label[chosen], return_index=True)
                chosen = chosen[first]
                label[np.isin(label, met)] = label[at]
            found = class_[chosen]
            if len(found):
                yield pd.DataFrame({"a": np.minimum(class_[at], found), "b": np.maximum(class_[at], found)})

    columns = ["column", "low", "high", "class", "size", "place", "root", "part", "folds"]
    return rest.select(*columns).groupBy("column", "low", "high").applyInPandas(pair, "a long, b long")


def overlaps(rows_: list[np.ndarray]) -> np.ndarray:
    """Overlaps of all folded rows: the product of the incidence matrix with its transpose,
    summed over blocks of columns. Columns of a single row add nothing and are left out."""
    codes = np.concatenate([_told_apart(r) for r in rows_])
    owner = np.repeat(np.arange(len(rows_)), [len(r) for r in rows_])
    columns, place, times = np.unique(codes, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    used = shared[place]
    owner, place = owner[used], number[place[used]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(rows_), len(rows_)), np.float32)
    for first in range(0, int(shared.sum()), PRODUCT_COLUMNS):
        part = slice(*np.searchsorted(place, [first, first + PRODUCT_COLUMNS]))
        block = np.zeros((len(rows_), PRODUCT_COLUMNS), np.float32)
        block[owner[part], place[part] - first] = 1.0
        total += block @ block.T
    return total


# Overlaps ----------------------------------------------------------------------------------


def bounded(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose folded rows leave the threshold within reach."""
    known = classes.select("class", "size", "folds")

    def side(name: str) -> DataFrame:
        return known.select(F.col("class").alias(name), F.col("size").alias(f"size_{name}"), F.col("folds").alias(f"folds_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c).to_pylist() for c in ("folds_a", "folds_b")]
            most = [
                len(np.intersect1d(*[_told_apart(np.frombuffer(f, "<u2")) for f in pair_], assume_unique=True))
                for pair_ in zip(*sides)
            ]
            sizes = [batch.column(c).to_numpy().astype(np.int64) for c in ("size_a", "size_b")]
            keep = np.array(most, np.int64) >= needed(*sizes, threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(bound, "a long, b long")


def linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, threshold: int) -> DataFrame:
    """The pairs that reach the threshold, their overlaps counted over whole rows."""
    asked = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    chosen = materialize(classes.select("class", "key").join(asked, "class"), "ngram-asked")
    # By key, not by id: ids may be null, and one id may have many texts.
    keyed = docs.select("doc_id", "text", row_key(docs).alias("key"))
    texts = attach(keyed, chosen.select("key").distinct(), ["key"], spread=["doc_id"], row_bytes=ID_BYTES)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            out = []
            for text in _texts(batch):
                columns = row(text, n)
                class_ = class_of(fingerprint(columns))
                if class_ not in seen:
                    seen.add(class_)
                    out.append((class_, columns.tobytes()))
            yield _batch(out, ["class", "columns"], [pa.int64(), pa.binary()])

    found = materialize(texts.select("text").mapInArrow(read, "class long, columns binary"), "ngram-sets")
    # One row per class, should the chosen row be repeated in several tasks.
    sets = found.groupBy("class").agg(F.max("columns").alias("columns"))
    left = sets.select(F.col("class").alias("a"), F.col("columns").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("columns").alias("right"))
    both = pairs.join(left, "a").join(right, "b")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * overlap >= threshold * (len(x) + len(y) - overlap))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(count, "a long, b long")


def joined(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, key, size of its set, and component_id, the smallest id of
    all documents that links reach; `kept` is true for one document of each component."""
    spark = docs.sparkSession
    blocks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = rows(docs, n)
    classes = materialize(known.classes, "ngram-classes")
    packed = postings(docs, known.frequencies, blocks, n, threshold)
    found = materialize(first_turn(packed, threshold), "ngram-candidates")

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        near = materialize(bounded(pairs, classes, threshold), name)
        return materialize(linked(near, docs, classes, n, threshold), f"{name}-links")

    first = links_of(found.filter("a is not null").select("a", "b").distinct(), "ngram-first")
    roots = materialize(components(first), "ngram-roots")
    shared = found.filter("a is null").select("column", "class", "size", "place")
    links, tested = first, None
    for turn, connect in (("second", True), ("third", False)):
        more = later_turn(shared, classes, roots, threshold, connect).distinct()
        more = more if tested is None else more.join(tested, ["a", "b"], "left_anti")
        tested = materialize(more, f"ngram-{turn}-pairs")
        found_ = links_of(tested, f"ngram-{turn}")
        if found_.take(1):
            links = links.unionByName(found_)
            roots = materialize(components(links), "ngram-roots")
    named = known.documents.join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = materialize(named.withColumn("root", F.coalesce("root", "class")), "ngram-components")
    first_of = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("first")
    found = named.filter("size > 0").groupBy("root").agg(first_of, F.count("*").alias("n"))
    several = named.join(found.filter("n > 1").drop("n"), "root", "left")
    alone = (F.col("size") == 0) | F.col("first").isNull()
    return several.select(
        "doc_id",
        "key",
        "size",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | (F.col("key") == F.col("first.key"))).alias("kept"),
    )


def representatives(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each component, with all columns: that with the smallest id.

    Rows that repeat both id and text stay together; exact duplicates are another operator's.
    """
    lost = joined(docs, n, threshold).filter("not kept").select(F.col("key").alias("_key")).distinct()
    named = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), row_key(docs).alias("_key"))
    lost = materialize(lost.withColumn("_lost", F.lit(True)), "ngram-lost")
    marked = attach(named, lost, ["_key"], spread=["_doc.doc_id"], row_bytes=ID_BYTES, how="left")
    return marked.filter("_lost is null").select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
