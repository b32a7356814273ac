"""Language identification with spans: words vote, a switching penalty keeps spans whole.

A word's score for a language is the log probability of its letter trigrams there. The
scripts of its letters narrow the languages down to those that were seen to use them. The
Viterbi path over the words, paying a penalty for every switch of language, labels spans of a
text; the language with most letters in its spans is the document's, and the share of those
letters is the score. Letters of words whose scripts no language uses are held by none: they
lower the score, and a text of such words alone has score 0 (and the commonest language).

The classifier is fitted on the documents with a language, at most `SAMPLE_ROWS` of each (a
bounded sample by hash of id and text); its size is fixed: languages times `BUCKETS`. More than
`LANGUAGES` languages are an error, for none may be left out. Every document is labelled from its whole text. Texts are read in place, nothing is
shuffled but the counts of the sample.

`und` with score 0 is for null texts, texts without a letter, and for all when nothing could
be learned. Very long texts are labelled from all their words. Equal scores go to the language
first in order. Repeated rows get a row each, and teach once; null ids are like others;
empty tables give empty results; extra columns are left out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.keys import attach
from marketlake.session import materialize

UNKNOWN = "und"
SAMPLE_ROWS = 2000
# Rows ranked of a language, as a multiple of the sample; samples below the least size are
# treated like it, for chance weighs more on them.
SAMPLE_MARGIN = 1.5
SAMPLE_LEAST = 1000
LANG_BYTES = 64
LANGUAGES = 200
BUCKETS = 1 << 16
SMOOTHING = 0.5
SWITCH_PENALTY = 30.0  # natural logarithm
# A language uses a script that holds this share of its letters.
SCRIPT_SHARE = 0.01
REMEMBERED_WORDS = 200_000
# Texts whose word scores are held at the same time have so many characters.
GROUP_CHARACTERS = 1 << 20

# First code points of script ranges; "" stands for everything else.
SCRIPTS = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, ""),
    (0x0B80, "Tamil"),
    (0x0C00, ""),
    (0x0E00, "Thai"),
    (0x0E80, ""),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x13A0, ""),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, ""),
    (0x3040, "Kana"),
    (0x3100, ""),
    (0x3400, "Han"),
    (0xA000, ""),
    (0xAC00, "Hangul"),
    (0xD7B0, ""),
    (0xF900, "Han"),
    (0xFB00, ""),
    (0x20000, "Han"),
    (0x30000, ""),
)
_STARTS = [start for start, _ in SCRIPTS]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
LATIN = SCRIPT_NAMES.index("Latin")
_SCRIPT_OF_RANGE = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])
# A document is accepted when one language holds this share of its letters.
ACCEPTED_SHARE = 1 / 3
RESULT = "doc_id long, lang_pred string, score double, spans array<struct<start:long,length:long,lang:string>>"


def script_of(letter: str) -> int:
    return int(_SCRIPT_OF_RANGE[bisect_right(_STARTS, ord(letter)) - 1])


class Model(NamedTuple):
    """languages; log probabilities (bucket, language); scripts used (script, language); the
    language with most letters."""

    languages: tuple[str, ...]
    logs: np.ndarray
    scripts: np.ndarray
    commonest: int


def letters_of(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def trigram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of words with a mark at both ends, and each word's start."""
    joined = "".join(f"\x02{word}\x03" for word in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(word) + 2 for word in words), np.int64, len(words))
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    hashed = mixed[:-2] ^ (mixed[1:-1] << np.uint64(7)) ^ (mixed[2:] * np.uint64(31))
    hashed ^= hashed >> np.uint64(29)
    hashed = hashed * np.uint64(0xBF58476D1CE4E5B9)
    buckets = (hashed >> np.uint64(40)).astype(np.int64) % BUCKETS
    # Of the trigrams at all places, those that cross from one word into the next are left out.
    ends = np.cumsum(lengths)
    inside = np.ones(len(buckets), bool)
    inside[(ends[:-1] - 2)] = False
    inside[(ends[:-1] - 1)] = False
    starts = np.concatenate([[0], np.cumsum(lengths - 2)[:-1]])
    return buckets[inside], starts


# Fitting -----------------------------------------------------------------------------------


def sample(docs: DataFrame, training: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled texts to fit on: of each language the rows with the smallest hashes of id and text.

    Rows of one id and text count once, null ids like any others. Rows are counted per
    language first, and only hashes below `SAMPLE_MARGIN` times the share that is wanted are
    ranked, so that no task sees more than a few samples' worth of a language's rows.
    """
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    labelled = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    labelled = labelled.select("lang", "text", key.alias("turn"))
    keys = materialize(labelled.select("lang", "turn").distinct(), "language-keys")
    sizes = materialize(keys.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    # Hashes are spread evenly over all longs; a language of few rows keeps them all.
    height = F.col("turn").cast("double") / float(1 << 64) + 0.5
    low = attach(keys, sizes, ["lang"], spread=["turn"], row_bytes=LANG_BYTES).filter(
        height * F.col("n") <= SAMPLE_MARGIN * max(rows, SAMPLE_LEAST)
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("turn"))
    chosen = low.withColumn("place", place).filter(F.col("place") <= rows)
    chosen = materialize(chosen.select("lang", "turn"), "language-sample")
    found = chosen.select("lang").distinct().count()
    if found > LANGUAGES:
        raise ValueError(f"{found} languages to learn, more than {LANGUAGES}")
    # At most rows x LANGUAGES keys.
    taken = labelled.join(F.broadcast(chosen), ["lang", "turn"], "left_semi")
    return taken.groupBy("lang", "turn").agg(F.first("text").alias("text")).select("lang", "text")


def fit(texts: DataFrame) -> Model:
    """Counts of trigrams and scripts per language; the result has a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                total = totals.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
                words = [w for w in map(letters_of, text.lower().split()) if w]
                if words:
                    total[:BUCKETS] += np.bincount(trigram_buckets(words)[0], minlength=BUCKETS)
                    total[BUCKETS:] += script_counts("".join(words))
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used), pa.array(total[used])], names=["lang", "place", "n"]
            )

    counted = texts.select("lang", "text").mapInArrow(count, "lang string, place long, n long")
    rows = counted.groupBy("lang", "place").agg(F.sum("n").alias("n")).collect()
    return model_of([(r["lang"], r["place"], r["n"]) for r in rows])


def script_counts(letters: str) -> np.ndarray:
    codes = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32)
    ranges = np.searchsorted(_STARTS, codes, side="right") - 1
    return np.bincount(_SCRIPT_OF_RANGE[ranges], minlength=len(SCRIPT_NAMES))


def model_of(rows: list[tuple[str, int, int]]) -> Model:
    languages = tuple(sorted({lang for lang, _, _ in rows}))
    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    for lang, place, n in rows:
        counts[place, languages.index(lang)] = n
    grams, scripts = counts[:BUCKETS], counts[BUCKETS:]
    logs = np.log(grams + SMOOTHING) - np.log(grams.sum(axis=0) + SMOOTHING * BUCKETS)
    shares = scripts / np.maximum(scripts.sum(axis=0), 1)
    commonest = int(grams.sum(axis=0).argmax()) if languages else 0
    return Model(languages, logs, shares >= SCRIPT_SHARE, commonest)


# Labelling ---------------------------------------------------------------------------------


class Labeler:
    """Labels texts; remembers the scores of words within a fixed number."""

    def __init__(self, model: Model, penalty: float = SWITCH_PENALTY):
        self.model, self.penalty = model, penalty
        self.letters: list[tuple[np.ndarray, np.ndarray]] = []
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self.sizes = np.zeros(1024, np.int32)
        # Letters that some language can hold: all of a word or none.
        self.held = np.zeros(1024, np.int32)

    def learn(self, words: list[str]) -> None:
        """Scores of words not seen before."""
        first, last = len(self.places), len(self.places) + len(words)
        if last > len(self.sizes):
            room = max(last, 2 * len(self.sizes)) - len(self.sizes)
            self.scores = np.concatenate([self.scores, np.zeros((room, self.scores.shape[1]), np.float32)])
            self.sizes = np.concatenate([self.sizes, np.zeros(room, np.int32)])
            self.held = np.concatenate([self.held, np.zeros(room, np.int32)])
        letters = list(map(letters_of, words))
        sizes = np.fromiter(map(len, letters), np.int64, len(letters))
        spelled = np.flatnonzero(sizes)
        self.sizes[first:last] = sizes
        self.held[first:last] = 0
        self.scores[first:last] = 0.0
        if len(spelled):
            letters = [word for word in letters if word]
            buckets, starts = trigram_buckets(letters)
            sums = np.add.reduceat(self.model.logs[buckets], starts, axis=0)
            self.scores[first + spelled], usable = self.narrowed(letters, sizes[spelled], sums)
            self.held[first + spelled] = np.where(usable, sizes[spelled], 0)
        self.places.update(zip(words, range(first, last)))

    def narrowed(self, words: list[str], sizes: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores with the languages out of reach that do not use the scripts of a word, and
        whether any language does."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        scripts = _SCRIPT_OF_RANGE[np.searchsorted(_STARTS, codes, side="right") - 1]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        sets = np.bitwise_or.reduceat(np.left_shift(1, scripts), starts)
        usable = np.ones(len(words), bool)
        for scripts_of_word in np.unique(sets):
            members = [s for s in range(len(SCRIPT_NAMES)) if scripts_of_word >> s & 1]
            used = self.model.scripts[members].all(axis=0)
            if used.all():
                continue
            rows = sets == scripts_of_word
            if used.any():
                floor = sums[rows][:, used].min(axis=1, keepdims=True) - 2 * self.penalty
                sums[rows] = np.where(used, sums[rows], floor)
            else:
                sums[rows] = 0.0
                usable[rows] = False
        return sums, usable

    def texts(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        """Language, score and spans of each text; a bounded number of characters at a time, or
        one longer text, has its scores in memory."""
        found: list[tuple[str, float, list[dict]]] = []
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > GROUP_CHARACTERS:
                found += self.together(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return found + self.together(group)

    def together(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        read = [self.read(text) for text in texts]
        open_ = [i for i, (_, scores, _, labels) in enumerate(read) if len(scores) and labels is None]
        paths = dict(zip(open_, viterbi([read[i][1] for i in open_], self.penalty)))
        found = []
        for i, (words, scores, spoken, labels) in enumerate(read):
            labels = paths.get(i, labels)
            if labels is None:
                found.append((UNKNOWN, 0.0, []))
                continue
            sizes, held = self.letters[i]
            letters = np.bincount(labels, weights=held, minlength=len(self.model.languages))
            best = int(letters.argmax()) if held.any() else self.model.commonest
            share = float(letters[best] / sizes.sum())
            found.append((self.model.languages[best], share, self.spans(spoken, labels, words)))
        self.letters.clear()
        return found

    def read(self, text: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray | None]:
        """Words of a text, scores and places of those with letters, and their labels if one
        language holds throughout.

        When no stretch of words prefers another language to the best single one by more than
        half the penalty, no switch can pay, and that language is the Viterbi path.
        """
        words = text.lower().split()
        places = self.known(words) if self.model.languages else np.zeros(0, np.int64)
        spoken = np.flatnonzero(self.sizes[places])
        scores = self.scores[places[spoken]].astype(np.float64)
        self.letters.append((self.sizes[places[spoken]], self.held[places[spoken]]))
        if not len(spoken):
            return len(words), scores, spoken, None
        if not scores.any():
            return len(words), scores, spoken, np.full(len(spoken), self.model.commonest)
        best = int(scores.sum(axis=0).argmax())
        gains = np.cumsum(scores - scores[:, best : best + 1], axis=0)
        lowest = np.minimum.accumulate(np.minimum(gains, 0.0), axis=0)
        if (gains - lowest).max() <= self.penalty / 2:
            return len(words), scores, spoken, np.full(len(spoken), best)
        return len(words), scores, spoken, None

    def known(self, words: list[str]) -> np.ndarray:
        distinct = set(words)
        new = distinct.difference(self.places)
        if len(self.places) + len(new) > REMEMBERED_WORDS:
            self.forget()
            new = distinct
        if new:
            self.learn(sorted(new))
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def spans(self, spoken: np.ndarray, labels: np.ndarray, n: int) -> list[dict]:
        """Spans of words with one language; words without letters belong to the span before."""
        switch = np.flatnonzero(np.diff(labels)) + 1
        first = np.concatenate([[0], switch])
        starts = spoken[first].copy()
        starts[0] = 0
        ends = np.concatenate([starts[1:], [n]])
        return [
            {"start": int(a), "length": int(b - a), "lang": self.model.languages[labels[at]]}
            for a, b, at in zip(starts, ends, first)
        ]


def viterbi(tables: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Best path over the rows of each table, with a price for every change of column.

    The tables advance row by row together, the longest first, so that those still going on
    are always the first ones.
    """
    if not tables:
        return []
    order = sorted(range(len(tables)), key=lambda i: -len(tables[i]))
    rows = np.concatenate([tables[i] for i in order])
    lengths = np.array([len(tables[i]) for i in order])
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    going = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    columns, every = np.arange(rows.shape[1]), np.arange(len(tables))
    total = rows[offsets]
    came = [None]
    for at in range(1, lengths[0]):
        n = going[at]
        now = total[:n]
        top = now.argmax(axis=1)
        switched = (now[every[:n], top] - penalty)[:, None]
        stay = now >= switched
        came.append(np.where(stay, columns, top[:, None]).astype(np.int16))
        total[:n] = np.where(stay, now, switched) + rows[offsets[:n] + at]
    state = total.argmax(axis=1)
    labels = np.empty(len(rows), np.int64)
    for at in range(lengths[0] - 1, -1, -1):
        n = going[at]
        labels[offsets[:n] + at] = state[:n]
        if at:
            state[:n] = came[at][every[:n], state[:n]]
    paths: list = [None] * len(tables)
    for place, i in enumerate(order):
        paths[i] = labels[offsets[place] : offsets[place] + lengths[place]]
    return paths


def identified(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """doc_id, lang_pred, score and spans (words from 0) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeler = Labeler(sent.value, penalty)
        for batch in batches:
            found = labeler.texts([text or "" for text in batch.column("text").to_pylist()])
            langs, scores, spans = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("lang", pa.string())]))),
                ],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(label, RESULT)


def accepted(docs: DataFrame, model: Model, share: float = ACCEPTED_SHARE) -> DataFrame:
    """The documents, with all their columns, in which some language prevails."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeler = Labeler(sent.value)
        for batch in batches:
            found = labeler.texts([text or "" for text in batch.column("text").to_pylist()])
            yield batch.filter(pa.array([lang != UNKNOWN and score >= share for lang, score, _ in found], pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
