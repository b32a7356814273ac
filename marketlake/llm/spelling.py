"""Spelling variants: words that differ by one edit, grouped under their commonest form.

Two words are near when exactly one code point was inserted, deleted or replaced between them:
the common prefix and the common suffix together reach the longer length minus one. A word's
form is its commonest near word, if that is `RATIO` times as common as the word itself; its
root is where the forms end.

Near words are found by dense tiles. The edit lies in some stretch of `STRETCH` code points of
the longer word, and around that stretch both words agree. So every word goes, for its own
length and for one more, to one bin per stretch, chosen by all its code points but those of
the stretch. The words of a bin are compared as padded matrices of code points, block against
block: a running comparison from the left gives all prefix lengths, one from the right all
suffix lengths. The number of bins follows the vocabulary, and words that agree around a
stretch are at most as many as there are pairs of letters, so no bin grows with the corpus;
a bin above the size of a tile is cut in blocks, and each pair of blocks is a tile of its own.

Counting is Spark's: words are counted with partial sums, a hot word costs one row per task.
The bound on n and the length only leave out words that cannot be vocabulary.

Null texts have no words; a null id counts as empty text in the hash. Words that tie for the
form go by code points. Repeated rows are read like any others; empty tables give empty
results; extra columns are left out; texts of any length are split where they lie.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
# One run in so many loses a code point.
DAMAGED = 199
STRETCH = 2
TILE = 128
# Bins that one task takes up together.
BINS_PER_GROUP = 64

NEAR = "word string, n long, other string, other_n long"


# Words -------------------------------------------------------------------------------------


def runs(docs: DataFrame) -> DataFrame:
    """One row per run of letters, lower-cased from A to Z: doc_id, word."""
    lowered = F.translate(F.col("text"), UPPER, UPPER.lower())
    found = F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("word"))


def damaged(words: DataFrame, divisor: int = DAMAGED) -> DataFrame:
    """Words (doc_id, word), less one code point where the hash of both is a multiple of `divisor`."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    place, length = (F.col("_hash") % F.length("word")).cast("int"), F.length("word")
    shorter = F.concat(F.substring("word", F.lit(1), place), F.substring(F.col("word"), place + 2, length))
    word = F.when(F.col("_hash") % divisor == 0, shorter).otherwise(F.col("word"))
    return words.withColumn("_hash", F.crc32(key)).select(word.alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word and n for the words (word) that are long and common enough."""
    long_enough = words.filter(F.length("word") >= min_length)
    return long_enough.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# Tiles -------------------------------------------------------------------------------------


def stretches(length: Column, stretch: int) -> Column:
    """Places where a stretch of a word of this length begins."""
    return F.sequence(F.lit(0), length - 1, F.lit(stretch))


def binned(words: DataFrame, bins: int, stretch: int = STRETCH) -> DataFrame:
    """Every word once per bin it belongs to: bin, word, n.

    For a longer word of `longer` code points and the stretch from `at`, the key is what lies
    before the stretch and what lies behind it. A word one shorter has the same key.
    """
    length = F.length("word")
    longer = F.explode(F.array(length, length + 1)).alias("longer")
    placed = words.select("word", "n", longer).select("word", "n", "longer", F.explode(stretches(F.col("longer"), stretch)).alias("at"))
    behind = F.greatest(F.col("longer") - F.col("at") - stretch, F.lit(0))
    before = F.substring("word", F.lit(1), F.col("at"))
    after = F.substring(F.col("word"), length - behind + 1, behind)
    key = F.xxhash64("longer", "at", before, after)
    return placed.select(F.pmod(key, F.lit(bins)).alias("bin"), "word", "n").distinct()


def tiles(rows: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows dealt to pairs of blocks: bin, left, right, word, n. A bin within a tile is one pair."""
    sizes = rows.groupBy("bin").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > 2 * tile)
    blocks = F.ceil(F.coalesce("_rows", F.lit(1)) / tile).cast("long")
    dealt = rows.join(sizes, "bin", "left").withColumn("_blocks", F.when(F.col("_rows").isNull(), 1).otherwise(blocks))
    own = F.pmod(F.xxhash64("word", F.lit("block")), F.col("_blocks"))
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return dealt.select("bin", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "word", "n")


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrices of code points padded on the right and on the left, and the lengths."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) and codes.max() < 256:
        codes = codes.astype(np.uint8)
    width = int(lengths.max(initial=0))
    rows = np.repeat(np.arange(len(words)), lengths)
    within = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    heads = np.zeros((len(words), width), codes.dtype)
    tails = np.zeros((len(words), width), codes.dtype)
    heads[rows, within] = codes
    tails[rows, np.repeat(lengths, lengths) - 1 - within] = codes
    return heads, tails, lengths


def common_lengths(left: np.ndarray, right: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common prefix length of every row of one matrix with every row of another, `most` being
    the shorter length of each pair."""
    going = np.ones((len(left), len(right)), bool)
    common = np.zeros((len(left), len(right)), np.uint16)
    for a, b in zip(left.T, right.T):
        going &= a[:, None] == b[None, :]
        if not going.any():
            break
        common += going
    return np.minimum(common, most)


def single_edits(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the pairs that are one edit apart."""
    a, b = code_points(left), code_points(right)
    shorter = np.minimum(a[2][:, None], b[2][None, :]).astype(np.uint16)
    longer = np.maximum(a[2][:, None], b[2][None, :])
    prefix, suffix = common_lengths(a[0], b[0], shorter), common_lengths(a[1], b[1], shorter)
    equal = (prefix == longer) & (shorter == longer)
    one_edit = (prefix.astype(np.int64) + suffix >= longer - 1) & (longer - shorter <= 1) & ~equal
    return np.nonzero(one_edit)


def _compare(group: pd.DataFrame) -> Iterator[tuple]:
    """Both directions of every near pair of a tile."""
    same = group["left"].iat[0] == group["right"].iat[0]
    words, counts = group["word"].tolist(), group["n"].to_numpy()
    if same:
        i, j = single_edits(words, words)
        yield from zip((words[x] for x in i), counts[i], (words[x] for x in j), counts[j])
        return
    first = (group["own"] == group["left"]).to_numpy()
    own, other = np.flatnonzero(first), np.flatnonzero(~first)
    i, j = single_edits([words[x] for x in own], [words[x] for x in other])
    for x, y in ((own[i], other[j]), (other[j], own[i])):
        yield from zip((words[k] for k in x), counts[x], (words[k] for k in y), counts[y])


def near_words(words: DataFrame, tile: int = TILE, stretch: int = STRETCH) -> DataFrame:
    """word, n, other, other_n for every ordered pair of near words of a vocabulary (word, n)."""
    width = words.agg(F.sum(2 * F.ceil(F.length("word") / stretch) + 2).alias("rows")).first()["rows"] or 1
    bins = max(1, math.ceil(width / tile))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        found = [pair for _, part in group.groupby(["bin", "left", "right"], sort=False) for pair in _compare(part)]
        return pd.DataFrame(found, columns=["word", "n", "other", "other_n"])

    dealt = tiles(binned(words, bins, stretch), tile)
    many = F.pmod(F.xxhash64("bin", "left", "right"), F.lit(max(1, math.ceil(bins / BINS_PER_GROUP))))
    pairs = dealt.withColumn("group", many).groupBy("group").applyInPandas(compare, NEAR)
    # A pair may meet in the bins of several stretches.
    return pairs.distinct()


# Forms and roots ---------------------------------------------------------------------------


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, and form with form_n where the commonest near word is common enough."""
    best = F.min(F.struct(-F.col("other_n"), "other")).alias("best")
    found = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(found, "word", "left")
    form_n = -F.col("best.col1")
    taken = form_n >= ratio * F.col("n")
    return rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.other")).alias("form"),
        F.when(taken, form_n).alias("form_n"),
    )


def rooted(found: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Add the root of every word by doubling the steps along its forms.

    Counts rise `ratio`-fold with each step, so the largest count bounds the rounds.
    """
    most = found.agg(F.max("n")).first()[0] or 1
    steps = 1 + int(math.log(max(most, 1), ratio))
    roots = materialize(found.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        roots = materialize(roots, "roots")
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for the vocabulary of all texts."""
    words = materialize(vocabulary(damaged(runs(docs))), "vocabulary")
    found = materialize(forms(words), "forms")
    return rooted(found).select("word", "form", "root", "n", "n_near", "form_n")
