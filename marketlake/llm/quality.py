"""Quality rules: how far a document's letters and words lie from those of a language.

References are learned from the documents that name a language: the shares of character
classes, and the shares of the language's most common words with one bin for all others. Of
the languages of which it has a common word, a document is held against the one whose word
shares lie nearest to its own, by the Jensen-Shannon distance (base 2, from 0 to 1) of both
histograms; a text without any common word is held against the nearest language. A short text scatters widely
around its language, so the limits come down with the square root of its length, and below
`MIN_WORDS` words nothing is said.

Base rules go before that: too few words, or too much of the text in repeated word triples.

Everything is DataFrame expressions. Texts are read twice (word counts, then documents) and
never shuffled; only counts are. Null texts count as empty, null languages teach nothing;
without any reference, and for a language beyond the `LANGUAGES` with most words, the base rules
decide alone. Repeated rows get a row each; empty tables
give empty results; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.text import BREAKS, words
from marketlake.session import materialize

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
# Common words per language; as many languages as become references, those with most words.
COMMON_WORDS = 64
LANGUAGES = 100
# Limit of a distance at n words: the first number plus the second over the root of n.
WORD_LIMIT = (0.26, 1.4)
CHARACTER_LIMIT = (0.13, 1.1)

# Character classes, each taken from what the ones before have left.
CLASSES = {
    "lower": "[a-z]+",
    "space": BREAKS,
    "letters": r"[\p{L}&&[^A-Z]]+",
    "upper": "[A-Z]+",
    "digits": "[0-9]+",
    "marks": r"[.,;:?'\"()\-]+",
}
CLASS_COLUMNS = [f"n_{name}" for name in (*CLASSES, "other")]
BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# Counts of one text ------------------------------------------------------------------------


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, the base counts, a count per character class, and the words."""
    rows = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("words", words(F.col("text")))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    rows = _repeated_words(_classes(rows))
    n_words = F.size("words")
    symbols = F.col("text")
    for symbol in SYMBOLS:
        symbols = F.replace(symbols, F.lit(symbol), F.lit(""))
    return rows.select(
        "row",
        "doc_id",
        "lang",
        n_words.cast("long").alias("n_words"),
        (F.length("text") - F.col("n_space")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(symbols)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        *CLASS_COLUMNS,
        "words",
    )


def _classes(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("left", F.col("text"))
    for name, pattern in CLASSES.items():
        rows = rows.withColumn("rest", F.regexp_replace("left", pattern, ""))
        counted = (F.length("left") - F.length("rest")).cast("long").alias(f"n_{name}")
        rows = rows.select("*", counted).drop("left").withColumnRenamed("rest", "left")
    return rows.withColumn("n_other", F.length("left").cast("long")).drop("left")


def _repeated_words(rows: DataFrame) -> DataFrame:
    """Words covered by triples that the text has twice or more.

    Triples are compared by their 64-bit hashes, sorted with their places: equal neighbours
    give the places of repeated triples, and each covers three words less the overlap with the
    next. Texts without a repeated triple stop at the first comparison.
    """

    def triple(word: Column, at: Column) -> Column:
        second, third = F.get("words", at + 1), F.get("words", at + 2)
        return F.when(third.isNotNull(), F.xxhash64(word, second, third))

    hashes = F.slice(F.transform("words", triple), 1, F.greatest(F.size("words") - 2, F.lit(0)))
    rows = rows.withColumn("triples", hashes)
    repeats = F.size(F.array_distinct("triples")) < F.size("triples")
    placed = F.sort_array(F.transform("triples", lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    rows = rows.withColumn("placed", F.when(repeats, placed))

    def repeated(item: Column, at: Column) -> Column:
        before, after = F.get("placed", at - 1), F.get("placed", at + 1)
        twice = (item["h"] == before["h"]) | (item["h"] == after["h"])
        return F.when(F.coalesce(twice, F.lit(False)), item["at"])

    rows = rows.withColumn("places", F.sort_array(F.array_compact(F.transform("placed", repeated))))

    def covered(place: Column, at: Column) -> Column:
        after = F.get("places", at + 1)
        return F.least(F.lit(3), F.coalesce(after - place, F.lit(3)))

    total = F.aggregate(F.transform("places", covered), F.lit(0), lambda sum_, n: sum_ + n)
    counted = F.coalesce(total, F.lit(0)).cast("long")
    return rows.withColumn("n_repeat_words", counted).drop("triples", "placed", "places")


# References --------------------------------------------------------------------------------


def common_words(docs: DataFrame, count: int = COMMON_WORDS, languages: int = LANGUAGES) -> DataFrame:
    """lang, word, share: the most common words of each language as they are written.

    The words are counted with partial sums; the most common ones are cut down in the map
    tasks. The result has at most `count` x `languages` rows.
    """
    told = docs.filter("lang is not null").select("lang", F.explode(words(F.col("text"))).alias("word"))
    counts = materialize(told.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    totals = totals.orderBy(F.desc("total"), "lang").limit(languages)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = counts.withColumn("place", place).filter(F.col("place") <= count)
    shares = common.join(F.broadcast(totals), "lang")
    return materialize(shares.select("lang", "word", (F.col("n") / F.col("total")).alias("share")), "common-words")


def _part(x: Column, middle: Column) -> Column:
    return F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)


def divergence_bin(p: Column, q: Column) -> Column:
    """What one bin with shares p and q adds to the Jensen-Shannon divergence."""
    middle = (p + q) / 2
    return (_part(p, middle) + _part(q, middle)) / 2


def _distance(divergence: Column) -> Column:
    """Null where nothing was compared; rounding may leave a zero divergence below zero."""
    return F.when(divergence > 0, F.sqrt(divergence)).when(divergence.isNotNull(), 0.0)


# Documents ---------------------------------------------------------------------------------


def nearest_language(rows: DataFrame, common: DataFrame) -> DataFrame:
    """Measured documents without their words, with `nearest` and `word_distance`.

    A document's common words are picked out and sorted where the text is; each run of equal
    words becomes one row, meets the references by a broadcast join, and the sums per document
    and language are taken before anything is shuffled.
    """
    known = [r[0] for r in common.select("word").distinct().collect()]
    facts = [c for c in rows.columns if c != "words"]
    hits = rows.withColumn("hits", F.sort_array(F.filter("words", lambda w: w.isin(known))))

    def run_end(word: Column, at: Column) -> Column:
        last = F.coalesce(F.get("hits", at + 1) != word, F.lit(True))
        return F.when(last, F.struct(word.alias("word"), (at + 1).alias("end")))

    ends = hits.withColumn("ends", F.array_compact(F.transform("hits", run_end)))

    def run(end: Column, at: Column) -> Column:
        before = F.coalesce(F.get("ends", at - 1)["end"], F.lit(0))
        return F.struct(end["word"].alias("word"), (end["end"] - before).alias("n"))

    runs = ends.select(*facts, F.explode_outer(F.transform("ends", run)).alias("run"))
    runs = runs.select(*facts, F.col("run.word").alias("word"), (F.col("run.n") / F.col("n_words")).alias("p"))
    met = runs.join(F.broadcast(common.withColumnRenamed("lang", "nearest")), "word", "left")
    sums = met.groupBy(*facts, "nearest").agg(
        F.sum(divergence_bin(F.col("p"), F.col("share"))).alias("present"),
        F.sum("p").alias("p"),
        F.sum("share").alias("q"),
    )
    all_shares = common.groupBy(F.col("lang").alias("nearest")).agg(F.sum("share").alias("all_q"))
    # Bins of common words the text lacks add half their share; the last bin has all other words.
    absent = (F.col("all_q") - F.col("q")) / 2
    others = divergence_bin(1 - F.col("p"), 1 - F.col("all_q"))
    distance = _distance(F.col("present") + absent + others)
    scored = sums.join(F.broadcast(all_shares), "nearest", "left").withColumn("distance", distance)
    best = F.min(F.struct("distance", "nearest"))
    found = scored.groupBy(*facts).agg(best.alias("best"))
    # A text without any common word is nearest to the language with the least of them.
    bare = all_shares.select(
        _distance(F.col("all_q") / 2 + divergence_bin(F.lit(1.0), 1 - F.col("all_q"))).alias("d"), "nearest"
    ).orderBy("d", "nearest").first()
    bare_distance, bare_language = (bare["d"], bare["nearest"]) if bare else (None, None)
    return found.select(
        *facts,
        F.coalesce("best.nearest", F.lit(bare_language).cast("string")).alias("nearest"),
        F.coalesce("best.distance", F.lit(bare_distance).cast("double")).alias("word_distance"),
    )


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, both distances, base_failed and kept."""
    common = common_words(docs)
    found = materialize(nearest_language(measured(docs), common), "measured-documents")
    per_language = found.filter("lang is not null").groupBy("lang").agg(*[F.sum(c).alias(c) for c in CLASS_COLUMNS])
    total = sum((F.col(c) for c in CLASS_COLUMNS[1:]), F.col(CLASS_COLUMNS[0]))
    shares = per_language.filter(total > 0).select(
        F.col("lang").alias("nearest"), *[(F.col(c) / total).alias(f"q_{c}") for c in CLASS_COLUMNS]
    )
    listed = shares.join(F.broadcast(common.select(F.col("lang").alias("nearest")).distinct()), "nearest", "left_semi")
    divergence = sum((divergence_bin(F.col(c) / total, F.col(f"q_{c}")) for c in CLASS_COLUMNS), F.lit(0.0))
    characters = F.when((total > 0) & F.col(f"q_{CLASS_COLUMNS[0]}").isNotNull(), _distance(divergence))
    rows = found.join(F.broadcast(listed), "nearest", "left").withColumn("character_distance", characters)
    learned = common.select("lang").distinct().withColumn("learned", F.lit(True))
    rows = rows.join(F.broadcast(learned), "lang", "left")
    # Documents of a language that was not learned have nothing to be held against.
    comparable = F.col("lang").isNull() | F.col("learned").isNotNull()
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    base_failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)

    def limit(numbers: tuple[float, float]) -> Column:
        return F.lit(numbers[0]) + F.lit(numbers[1]) / F.sqrt("n_words")

    strange = (F.col("word_distance") > limit(WORD_LIMIT)) | (F.col("character_distance") > limit(CHARACTER_LIMIT))
    return rows.withColumn("base_failed", base_failed).select(
        "doc_id",
        *BASE_COLUMNS,
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(strange & comparable, F.lit(False))).alias("kept"),
        "nearest",
        "word_distance",
        "character_distance",
    )
