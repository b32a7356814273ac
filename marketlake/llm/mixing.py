"""Mixing sources to target weights along a schedule that changes during training.

Every source has a weight; targets share a budget by weight and stop at a cap, the excess
being shared again. A source's schedule says how its share of the stream changes over the
training time from 0 to 1. Its integral is the part of the target that is due by a time, so
a document that lies at some point of its source's stream gets the time at which that much
is due (the inverse of the integral), and the documents are range-sorted by it.

A source's stream is its documents in the order of the md5 of their ids, then the same again
up to the cap. A copy belongs to the mix when its middle lies within the target: the taken
words miss the target by half a document at most. A null text has size 0 and is taken when it
falls inside; a null source is a source of its own, the last. Repeated rows are documents of
their own. An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.text import words
from marketlake.operators.keys import attach
from marketlake.session import materialize

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2
POSITION_BYTES = 96

# Relative weight at times from 0 to 1, straight in between, for the sources of each place in
# WEIGHTS: the heavy ones fade, the light ones come in late.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 0.75), (1.0, 2.25)),
)


def row_key(docs: DataFrame) -> Column:
    """Names a document by its id, source and text."""
    parts = [docs["doc_id"].cast("string"), docs["source"], docs["text"]]
    return F.xxhash64(*[F.coalesce(p, F.lit("")) for p in parts], docs["source"].isNull())


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, order in the stream and a row number, written once."""
    return materialize(
        docs.select(
            "doc_id",
            "source",
            F.size(words(F.col("text"))).cast("long").alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("turn"),
            F.monotonically_increasing_id().alias("row"),
            row_key(docs).alias("key"),
        ),
        "document-sizes",
    )


def targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET, cap: int = CAP
) -> DataFrame:
    """Per source: source_size, target and its place in `weights`.

    Sources in the order of cap to weight reach their caps one after the other. What is left
    after those before it, shared by the weights not yet capped, decides about the next.
    The windows run over one row per source.
    """
    if not budget < cap:
        raise ValueError("the budget must stay below the cap")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("place") + 1)
    by_reach = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()

    def earlier(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    level = (F.sum("source_size").over(everything) * budget - earlier("source_size") * cap) / (
        F.sum("weight").over(everything) - earlier("weight")
    )
    leveled = per_source.withColumn("place", place).withColumn("weight", weight)
    leveled = leveled.withColumn("level", level).withColumn("reach", F.row_number().over(by_reach))
    capped = F.col("source_size") * cap <= F.col("weight") * F.col("level")
    final = F.min_by("level", F.when(~capped, F.col("reach"))).over(everything)
    return leveled.withColumn("final", final).select(
        "source",
        "source_size",
        "place",
        F.when(capped, (F.col("source_size") * cap).cast("double"))
        .otherwise(F.col("weight") * F.col("final"))
        .alias("target"),
    )


def streamed(sized: DataFrame) -> DataFrame:
    """Adds `start`: the words of the same source that lie before a document in the stream.

    Rows are range-partitioned by source and turn, so a large source is spread over many
    partitions; a running total over one sum per source and partition joins them up.
    """
    order = ["turn", "doc_id", "size", "row"]
    ranged = sized.repartitionByRange("source", *order).withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "source-ranges")
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("_source"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"),
    )
    inside = Window.partitionBy("part", "source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    start = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return ranged.join(offsets, same).withColumn("start", start).drop("part", "_part", "_source", "offset", "turn")


def due(time: float, schedule: Sequence[tuple[float, float]]) -> float:
    """Integral of a schedule up to a time, as a share of the whole."""
    return _area(time, schedule) / _area(1.0, schedule)


def _area(time: float, schedule) -> float:
    total = 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if time > t0:
            end = min(time, t1)
            at_end = w0 + (w1 - w0) * (end - t0) / (t1 - t0)
            total += (end - t0) * (w0 + at_end) / 2
    return total


def time_due(share: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """The time at which a share of a source's target is due: the inverse of `due`."""
    whole = _area(1.0, schedule)
    time = F.lit(None).cast("double")
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        rest = share * whole - _area(t0, schedule)
        slope = (w1 - w0) / (t1 - t0)
        inside = rest / w0 if slope == 0 else (F.sqrt(F.greatest(w0 * w0 + 2 * slope * rest, F.lit(0.0))) - w0) / slope
        time = F.when(share >= due(t0, schedule), F.lit(t0) + inside).otherwise(time)
    return F.least(time, F.lit(1.0))


def mixed(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    budget: float = BUDGET,
    cap: int = CAP,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, positions, row.

    `positions` has the training time of each copy that the mix takes, none if it takes none.
    """
    if len(weights) != len(schedules):
        raise ValueError("one schedule for each weight")
    sized = sizes(docs)
    goals = materialize(targets(sized, weights, budget, cap), "mixing-targets")
    stream = streamed(sized)
    goals = goals.withColumnRenamed("source", "_source")
    known = stream.join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def position(copy: Column) -> Column:
        middle = F.col("start") + copy * F.col("source_size") + F.col("size") / 2
        share = middle / F.col("target")
        time = F.lit(None).cast("double")
        for place, schedule in enumerate(schedules):
            time = F.when(F.col("place") == place, time_due(share, schedule)).otherwise(time)
        return F.when((middle <= F.col("target")) & (F.col("target") > 0), time)

    copies = F.array(*[position(F.lit(copy)) for copy in range(cap)])
    return known.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.array_compact(copies).alias("positions"),
        "row",
        "key",
    )


def training_order(mix: DataFrame) -> DataFrame:
    """The documents, range-sorted by the position of their first copy; those not taken last."""
    order = [F.col("first").asc_nulls_last(), "doc_id", "row"]
    placed = mix.withColumn("first", F.array_min("positions"))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """The training stream: documents with all their columns, once per copy the mix takes,
    range-sorted by training position.

    Positions travel to the texts; these move once, when they are sorted. Rows that repeat id,
    source and text are one text with the positions of all.
    """
    taken = materialize(mixed(docs, **settings).filter(F.size("positions") > 0).select("key", "positions"), "mix")
    repeated = materialize(taken.groupBy("key").count().filter("count > 1").select("key"), "mix-repeated")
    named = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), row_key(docs).alias("key"))
    single = attach(
        named,
        taken.join(repeated, "key", "left_anti"),
        ["key"],
        spread=["_doc.doc_id"],
        row_bytes=POSITION_BYTES,
    ).select("_doc", "key", F.explode("positions").alias("position"))
    same = named.join(repeated, "key", "left_semi").dropDuplicates(["key"])
    places = taken.join(repeated, "key", "left_semi").select("key", F.explode("positions").alias("position"))
    copies = single.unionByName(same.join(places, "key").select("_doc", "key", "position"))
    ordered = copies.repartitionByRange("position", "key").sortWithinPartitions("position", "key")
    return ordered.select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns])
