"""Katz backoff model of word pairs: trained on most documents, scoring all of them.

Tokens are words (ASCII letters in lower case, split at ASCII white space) and an end per
text; a word's context is the word before it, or the start. With counts c of the training
texts, N tokens, V kinds of token and Good-Turing discounts d for counts up to `LARGEST`:

    p(w | h) = d(c(hw)) c(hw) / (c(h) + 1)      if the pair was seen,
             = alpha(h) p(w)                    otherwise,
    p(w)     = d(c(w)) c(w) / (N + 1)           if the word was seen,
             = what the others leave            for the unknown word,

and alpha(h) makes the probabilities of all V words and the unknown one sum to 1 after every
context. The 1 is a count kept back in each distribution, so that something is left even
where all counts are large.

How it runs. Texts are read twice. The first reading counts words into a table packed by
bucket. The second ships each chunk's distinct pairs, with the documents they occur in, to
buckets by their second word; pairs of very frequent words are spread by both words. A bucket
knows the counts of its pairs and words, so it can write the pair counts (the model's table),
its share of every context (counts of followers, their mass) and of every document (sums that
do not need the discounts, pairs by count otherwise). Contexts meet the unseen pairs in
buckets of their own, where the backoff weights are formed and stored; documents add up.
Everything shipped is packed in arrays, frequent context words as numbers of two bytes. Memory
per task follows `spark.sql.shuffle.partitions`, which should grow with the input.

Null and empty texts are one end. A null id belongs to the training texts or not like any
other (its text is empty for the remainder). Repeated rows are scored each, and counted each.
Very long texts are chunks of their own. Empty tables give empty results; extra columns are
left out. Words are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.session import fresh_path, materialize

# Counts up to this are discounted.
LARGEST = 5
ADDED = 0.1
# Tokens handled at a time, texts staying whole; texts of a chunk have numbers of two bytes.
CHUNK_TOKENS = 1_000_000
CHUNK_TEXTS = 50_000
# Frequent words that travel as a number of two bytes, all ones standing for the others.
NUMBERED = 65_535
# A word is spread over buckets when it has more than this share of a bucket's tokens.
SPREAD_SHARE = 0.25

START = np.uint64(xxhash.xxh64_intdigest(b" start"))
END = np.uint64(xxhash.xxh64_intdigest(b" end"))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xBF58476D1CE4E5B9)

WORDS = "bucket int, words binary, counts binary"
PACKED = (
    "bucket int, first long, held binary, ids binary, tokens binary, words binary, runs binary, "
    "numbers binary, others binary, times binary, texts binary"
)
# Rows of the counted tables; `kind` says which of the columns are filled.
COUNTED = (
    "kind string, home long, a binary, b binary, c binary, d binary, e binary, "
    "n array<long>"
)
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


class Unigrams(NamedTuple):
    """Totals of the training texts, discounts, and the frequent words with their counts."""

    tokens: int
    kinds: int
    texts: int
    discounts: np.ndarray
    unknown: float
    frequent: np.ndarray
    frequent_counts: np.ndarray

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """Of words by their counts; 0 is the unknown word."""
        small = np.minimum(counts, LARGEST)
        found = np.where(counts > LARGEST, counts, self.discounts[small] * counts) / (self.tokens + 1)
        return np.where(counts > 0, found, self.unknown)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIXER
    return x ^ (x >> np.uint64(27))


def hashed(text: bytes | None) -> np.ndarray:
    """Hashes of the tokens of a text, the end included."""
    words = (text or b"").lower().split()
    found = np.empty(len(words) + 1, np.uint64)
    found[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    found[-1] = END
    return found


def discounts(kinds: np.ndarray) -> np.ndarray:
    """Katz's discounts for counts 0 to LARGEST; kinds[r] is the number of events seen r times.

    Where copies in the corpus bend the counts of counts, a line through their logarithms takes
    their place; where even that does not fall steeply enough, a half is taken off each count.
    """
    r = np.arange(1, LARGEST + 2)
    n = np.asarray(kinds, float)[1:]
    found = np.ones(LARGEST + 1)
    found[1:] = (r[:-1] - 0.5) / r[:-1]
    if (n > 0).all():
        line = np.exp(np.polyval(np.polyfit(np.log(r), np.log(n), 1), np.log(r)))
        for shape in (line, n):
            last = (LARGEST + 1) * shape[-1] / shape[0]
            turing = (r[1:] * shape[1:] / (r[:-1] * shape[:-1]) - last) / (1 - last)
            if last < 1 and (turing > 0).all() and (turing < 1).all():
                found[1:] = turing
    return found


def left_over(kinds: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """What discounts take from counts 1 to LARGEST, and the count that is kept back."""
    r = np.arange(1, LARGEST + 1)
    return (kinds * (r * (1 - discount[1:]))).sum(axis=-1) + 1.0


# First reading: words ----------------------------------------------------------------------


def count_words(texts: DataFrame, buckets: int) -> Unigrams:
    """Counts of all training words as a table of packed buckets, and their totals."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def packed() -> pa.RecordBatch:
            words, counts = np.unique(np.concatenate(waiting), return_counts=True)
            home = (words % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(home[order])) + 1)
            rows = [(int(home[p[0]]), words[p].tobytes(), counts[p].astype("<u4").tobytes()) for p in parts]
            return _batch(rows, ["bucket", "words", "counts"], [pa.int32(), pa.binary(), pa.binary()])

        for batch in batches:
            kept = batch.filter(pc.invert(batch.column("held")))
            for text in kept.column("text").cast(pa.binary()).to_pylist():
                waiting.append(hashed(text))
                size += len(waiting[-1])
                if size >= CHUNK_TOKENS:
                    yield packed()
                    waiting, size = [], 0
        if waiting:
            yield packed()

    def add(part: pd.DataFrame) -> pd.DataFrame:
        words = np.frombuffer(b"".join(part["words"]), np.uint64)
        words, place = np.unique(words, return_inverse=True)
        counts = np.bincount(place, np.frombuffer(b"".join(part["counts"]), "<u4")).astype(np.int64)
        kinds = np.bincount(np.minimum(counts, LARGEST + 2), minlength=LARGEST + 3)[: LARGEST + 2]
        ends = counts[words == END].sum()
        return pd.DataFrame(
            {
                "bucket": part["bucket"].iloc[:1],
                "words": [words.tobytes()],
                "counts": [counts.tobytes()],
                "n": [[int(counts.sum()), len(words), int(ends), *kinds.tolist()]],
            }
        )

    packed_ = texts.select("text", "held").mapInArrow(count, WORDS)
    table = materialize(packed_.groupBy("bucket").applyInPandas(add, f"{WORDS}, n array<long>"), "katz-words")
    places = 3 + LARGEST + 2
    sums = table.agg(*[F.coalesce(F.sum(F.col("n")[i]), F.lit(0)) for i in range(places)]).first()
    tokens, kinds, ends = sums[0], sums[1], sums[2]
    of_kind = np.array(sums[3:], float)
    discount = discounts(of_kind)
    unknown = float(left_over(of_kind[1 : LARGEST + 1], discount)) / (tokens + 1)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column("words"), batch.column("counts")):
                words, counts = np.frombuffer(words.as_py(), np.uint64), np.frombuffer(counts.as_py(), np.int64)
                most = counts * NUMBERED >= tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[most].view(np.int64)), pa.array(counts[most])], names=["word", "n"]
                )

    # At most NUMBERED words can have that share of all tokens.
    found = table.select("words", "counts").mapInArrow(frequent, "word long, n long").orderBy("word").collect()
    words = np.array([r["word"] for r in found], np.int64).view(np.uint64)
    counts = np.array([r["n"] for r in found], np.int64)
    order = np.argsort(words)
    return Unigrams(tokens, kinds, ends, discount, unknown, words[order], counts[order])


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


# Second reading: pairs with the texts they occur in ----------------------------------------


def pack_chunk(
    first: int, ids: list, held: list[bool], tokens: list[np.ndarray], words: Unigrams, buckets: int
) -> Iterator[tuple]:
    """Rows of `PACKED`: the pairs of a chunk of texts by bucket."""
    lengths = np.array([len(t) for t in tokens])
    word = np.concatenate(tokens)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = START
    text = np.repeat(np.arange(len(tokens), dtype=np.uint16), lengths)
    spread = words.frequent[words.frequent_counts * buckets > SPREAD_SHARE * words.tokens]
    home = mixed(word)
    wide = np.isin(word, spread)
    home[wide] = mixed(home[wide] * _MULTIPLIER + context[wide])
    home = (home % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((text, context, word, home))
    word, context, text, home = word[order], context[order], text[order], home[order]
    new_word = np.concatenate([[True], (np.diff(word) != 0) | (np.diff(home) != 0)])
    new_pair = new_word | np.concatenate([[True], np.diff(context) != 0])
    at = np.flatnonzero(np.concatenate([[True], np.diff(home) != 0]))
    at_end = np.append(at[1:], len(home))
    flags = np.packbits(np.array(held, np.uint8)).tobytes()
    for start, stop in zip(at.tolist(), at_end.tolist()):
        part = slice(start, stop)
        pairs = np.flatnonzero(new_pair[part])
        starts = np.flatnonzero(new_word[part])
        numbers, others = _numbered(context[part][pairs], words.frequent)
        times = np.diff(np.append(pairs, stop - start))
        runs = np.diff(np.append(np.searchsorted(pairs, starts), len(pairs)))
        yield (
            int(home[start]),
            first,
            flags,
            None,
            None,
            word[part][starts].tobytes(),
            runs.astype("<u4").tobytes(),
            numbers.tobytes(),
            others.tobytes(),
            times.astype("<u4").tobytes(),
            text[part].tobytes(),
        )
    known = np.array([i if i is not None else 0 for i in ids], np.int64)
    missing = np.array([i is None for i in ids], np.uint8)
    # The texts themselves, with any bucket.
    yield (first % buckets, first, flags, known.tobytes() + missing.tobytes(), lengths.tobytes(), *[None] * 6)


def _numbered(contexts: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(frequent, contexts), max(len(frequent) - 1, 0))
    found = frequent[place] == contexts if len(frequent) else np.zeros(len(contexts), bool)
    return np.where(found, place, NUMBERED).astype("<u2"), contexts[~found]


def _contexts(numbers: np.ndarray, others: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    found = np.empty(len(numbers), np.uint64)
    far = numbers == NUMBERED
    found[far] = others
    found[~far] = frequent[numbers[~far]]
    return found


def pair_chunks(texts: DataFrame, words: Unigrams, buckets: int) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(words)
    names = [c.split(" ")[0] for c in PACKED.split(", ")]
    types = [pa.int32(), pa.int64(), *[pa.binary()] * 9]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row", "doc_id", "held")]
            rows = zip(*columns, batch.column("text").cast(pa.binary()).to_pylist())
            waiting: list[tuple] = []
            size = 0
            for row, doc_id, held, text in rows:
                waiting.append((row, doc_id, held, hashed(text)))
                size += len(waiting[-1][3])
                if size >= CHUNK_TOKENS or len(waiting) >= CHUNK_TEXTS:
                    yield packed(waiting)
                    waiting, size = [], 0
            if waiting:
                yield packed(waiting)

    def packed(waiting: list[tuple]) -> pa.RecordBatch:
        rows, ids, held, tokens = map(list, zip(*waiting))
        return _batch(list(pack_chunk(rows[0], ids, held, tokens, sent.value, buckets)), names, types)

    return texts.select("row", "doc_id", "held", "text").mapInArrow(read, PACKED)


class _Pairs(NamedTuple):
    """Distinct pairs of a bucket with their training counts, and per chunk its number, the pair
    of each occurrence and the text it stands in."""

    word: np.ndarray
    context: np.ndarray
    count: np.ndarray
    chunks: list[tuple[int, np.ndarray, np.ndarray]]


def _unpacked(part: pd.DataFrame, frequent: np.ndarray) -> _Pairs:
    word, context, chunks = [], [], []
    pairs = 0
    for row in part.itertuples():
        word.append(np.repeat(np.frombuffer(row.words, np.uint64), np.frombuffer(row.runs, "<u4")))
        context.append(
            _contexts(np.frombuffer(row.numbers, "<u2"), np.frombuffer(row.others, np.uint64), frequent)
        )
        times, texts = np.frombuffer(row.times, "<u4"), np.frombuffer(row.texts, np.uint16)
        train = np.unpackbits(np.frombuffer(row.held, np.uint8))[texts] == 0
        chunks.append((row.first, np.repeat(np.arange(pairs, pairs + len(times), dtype=np.int32), times), texts, train))
        pairs += len(times)
    word, context = np.concatenate(word), np.concatenate(context)
    order = np.lexsort((context, word))
    word, context = word[order], context[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(word) != 0) | (np.diff(context) != 0)
    number = np.empty(len(order), np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    word, context = word[new], context[new]
    count = np.zeros(len(word), np.int64)
    for _, pair, _, train in chunks:
        count += np.bincount(number[pair[train]], minlength=len(count))
    return _Pairs(word, context, count, [(first, number[pair], texts) for first, pair, texts, _ in chunks])


def count_pairs(packed: DataFrame, words: Unigrams, buckets: int) -> DataFrame:
    """The tables of `COUNTED`, from the pairs of each bucket.

    pair: words, runs, contexts, counts of the training pairs; n has how many were seen 1, 2,
    ... times. context: contexts, followers by count, mass of followers; then, of pairs not seen
    in training, the contexts, chunks and texts. text: per text pairs by count, sums of
    logarithms, and known tokens. texts: ids, lengths, held-out flags.
    """
    sent = packed.sparkSession.sparkContext.broadcast(words)

    def count(part: pd.DataFrame) -> pd.DataFrame:
        uni = sent.value
        told = part[part["ids"].notna()]
        out = [("texts", r.first, r.ids, r.tokens, r.held, None, None, None) for r in told.itertuples()]
        part = part[part["ids"].isna()]
        if len(part):
            out += _bucket(_unpacked(part, uni.frequent), uni, buckets)
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in COUNTED.split(", ")])

    return packed.groupBy("bucket").applyInPandas(count, COUNTED)


def _bucket(found: _Pairs, uni: Unigrams, buckets: int) -> list[tuple]:
    # Counts of the words: a frequent one may have pairs elsewhere, its count is known.
    starts = np.flatnonzero(np.concatenate([[True], np.diff(found.word) != 0]))
    totals = np.add.reduceat(found.count, starts)
    heads = found.word[starts]
    if len(uni.frequent):
        place = np.minimum(np.searchsorted(uni.frequent, heads), len(uni.frequent) - 1)
        totals = np.where(uni.frequent[place] == heads, uni.frequent_counts[place], totals)
    of_word = np.repeat(totals, np.diff(np.append(starts, len(found.word))))
    mass = uni.probability(of_word)
    out: list[tuple] = []

    seen = found.count > 0
    kinds = np.bincount(np.minimum(found.count[seen], LARGEST + 2), minlength=LARGEST + 3)[: LARGEST + 2]
    word, context, counts = found.word[seen], found.context[seen], found.count[seen]
    first = np.flatnonzero(np.concatenate([[True], np.diff(word) != 0])) if len(word) else np.zeros(0, np.int64)
    runs = np.diff(np.append(first, len(word))).astype("<u4")
    numbers, others = _numbered(context, uni.frequent)
    out.append(
        ("pair", 0, word[first].tobytes(), runs.tobytes(), numbers.tobytes(), others.tobytes(), _short(counts), kinds.tolist())
    )

    # Shares of contexts.
    keys, place = np.unique(context, return_inverse=True)
    followers = np.zeros((len(keys), LARGEST), np.int64)
    small = counts <= LARGEST
    np.add.at(followers, (place[small], counts[small] - 1), 1)
    weight = np.bincount(place, mass[seen], minlength=len(keys))
    # What an occurrence of each pair adds to its text.
    logs = np.where(found.count > LARGEST, np.log10(np.maximum(found.count, 1)), 0.0)
    unseen = ~seen
    logs[unseen] += np.log10(uni.probability(of_word[unseen]))
    logs -= np.where(found.word != END, np.log10(of_word + 1.0), 0.0)
    base = np.log10(of_word + ADDED)
    by_count = np.where(found.count <= LARGEST, found.count, 0).astype(np.int8)
    known = of_word > 0
    open_ = []
    for chunk, pair, text in found.chunks:
        texts, place = np.unique(text, return_inverse=True)
        size = len(texts)
        kinds = np.bincount(place * (LARGEST + 1) + by_count[pair], minlength=size * (LARGEST + 1))
        kinds = kinds.reshape(size, LARGEST + 1)[:, 1:]
        sums = np.stack([np.bincount(place, x[pair], minlength=size) for x in (logs, base)])
        told = np.bincount(place, known[pair], minlength=size).astype(np.int64)
        out.append(("text", chunk, texts.tobytes(), _small(kinds), sums.tobytes(), _small(told), None, None))
        missing = np.flatnonzero(unseen[pair])
        open_.append((found.context[pair[missing]], np.full(len(missing), chunk, np.int64), text[missing]))

    # Contexts, and pairs that training has not seen with the texts they stand in.
    asked, chunks, texts = (np.concatenate(x) for x in zip(*open_))
    of_home, asked_of_home = dict(_split(keys, buckets)), dict(_split(asked, buckets))
    none = np.zeros(0, np.int64)
    for home in sorted(of_home.keys() | asked_of_home.keys()):
        at, open_at = of_home.get(home, none), asked_of_home.get(home, none)
        places = chunks[open_at].tobytes() + texts[open_at].tobytes()
        told = (keys[at].tobytes(), _small(followers[at]), weight[at].tobytes(), asked[open_at].tobytes(), places)
        out.append(("context", home, *told, None))
    return out


def _small(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 up in as few bytes each as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _large(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // count}" if count else "<u1").astype(np.int64)


def _short(counts: np.ndarray) -> bytes:
    """Counts in one byte each, all ones standing for larger ones that follow in eight."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _split(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of keys by bucket."""
    if len(keys):
        home = (mixed(keys) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
            yield int(home[part[0]]), part


# Contexts and texts ------------------------------------------------------------------------


def backoff(counted: DataFrame, discount: np.ndarray) -> DataFrame:
    """Backoff weights of the contexts (kind `weight`: contexts, logarithms) and what unseen
    pairs add to texts (kind `backed`: chunk, texts, sums)."""

    def weigh(part: pd.DataFrame) -> pd.DataFrame:
        keys, place = np.unique(np.frombuffer(b"".join(part["a"]), np.uint64), return_inverse=True)
        sizes = [len(a) // 8 * LARGEST for a in part["a"]]
        parts = [_large(b, n) for b, n in zip(part["b"], sizes)]
        followers = np.concatenate([*parts, np.zeros(0, np.int64)]).reshape(-1, LARGEST)
        weight = np.frombuffer(b"".join(part["c"]), float)
        kinds = np.stack([np.bincount(place, f, minlength=len(keys)) for f in followers.T], axis=1)
        mass = np.bincount(place, weight, minlength=len(keys))
        logs = np.log10(left_over(kinds, discount)) - np.log10(1.0 - mass)
        out = [("weight", int(part["home"].iloc[0]), keys.tobytes(), logs.tobytes(), None)]
        contexts = np.frombuffer(b"".join(part["d"]), np.uint64)
        if len(contexts):
            chunk = np.frombuffer(b"".join(e[: len(d)] for d, e in zip(part["d"], part["e"])), np.int64)
            text = np.frombuffer(b"".join(e[len(d) :] for d, e in zip(part["d"], part["e"])), np.uint16)
            at = np.minimum(np.searchsorted(keys, contexts), max(len(keys) - 1, 0))
            # A context never seen has followers of no mass: its weight is 1.
            added = np.where(keys[at] == contexts, logs[at], 0.0) if len(keys) else np.zeros(len(contexts))
            for c in np.unique(chunk):
                here = chunk == c
                texts, place = np.unique(text[here], return_inverse=True)
                sums = np.bincount(place, added[here], minlength=len(texts))
                out.append(("backed", int(c), texts.tobytes(), sums.tobytes(), None))
        return pd.DataFrame(out, columns=["kind", "home", "a", "b", "c"])

    contexts = counted.filter("kind = 'context'").select("home", "a", "b", "c", "d", "e")
    return contexts.groupBy("home").applyInPandas(weigh, "kind string, home long, a binary, b binary, c binary")


def summed(parts: DataFrame, words: Unigrams, discount: np.ndarray) -> DataFrame:
    """Scores of the texts of each chunk."""
    totals = words._replace(frequent=words.frequent[:0], frequent_counts=words.frequent_counts[:0])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        told = part[part["kind"] == "texts"].iloc[0]
        lengths = np.frombuffer(told["b"], np.int64)
        size = len(lengths)
        ids = np.frombuffer(told["a"][: 8 * size], np.int64)
        missing = np.frombuffer(told["a"][8 * size :], np.uint8)
        held = np.unpackbits(np.frombuffer(told["c"], np.uint8))[:size] == 1
        by_count, known = np.zeros((size, LARGEST), np.int64), np.zeros(size, np.int64)
        logs, base = np.zeros(size), np.zeros(size)
        for row in part[part["kind"] == "text"].sort_values("a").itertuples():
            texts = np.frombuffer(row.a, np.uint16)
            by_count[texts] += _large(row.b, LARGEST * len(texts)).reshape(-1, LARGEST)
            sums = np.frombuffer(row.c, float).reshape(2, -1)
            logs[texts] += sums[0]
            base[texts] += sums[1]
            known[texts] += _large(row.d, len(texts))
        for row in part[part["kind"] == "backed"].itertuples():
            logs[np.frombuffer(row.a, np.uint16)] += np.frombuffer(row.b, float)
        r = np.arange(1, LARGEST + 1)
        score = logs + by_count @ np.log10(discount[1:] * r) - np.log10(totals.texts + 1.0)
        base -= lengths * np.log10(totals.tokens + ADDED * (totals.kinds + 1))
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.where(missing == 0, ids, 0), "Int64").copy(),
                "held_out": held,
                "n_tokens": lengths,
                "n_known": known,
                "base_score": base,
                "score": score,
            }
        ).assign(doc_id=lambda x: x["doc_id"].mask(missing == 1))

    return parts.groupBy("home").applyInPandas(add, SCORES)


def _stored(table: DataFrame, name: str) -> DataFrame:
    """Written with the denser compression: most of these arrays hold few different numbers."""
    path = fresh_path(table.sparkSession, name)
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def scored(docs: DataFrame, held_out: Column) -> DataFrame:
    """Train on the documents that are not held out, score all: see `SCORES`, and train_tokens."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select("doc_id", "text", held_out.alias("held")).withColumn("row", F.monotonically_increasing_id())
    words = count_words(texts, buckets)
    counted = _stored(count_pairs(pair_chunks(texts, words, buckets), words, buckets), "katz-pairs")
    seen = counted.filter("kind = 'pair'")
    sums = seen.agg(*[F.coalesce(F.sum(F.col("n")[i]), F.lit(0)) for i in range(LARGEST + 2)]).first()
    discount = discounts(np.array(sums, float))
    weights = _stored(backoff(counted, discount), "katz-weights")
    parts = (
        counted.filter("kind in ('text', 'texts')")
        .select("kind", "home", "a", "b", "c", "d")
        .unionByName(weights.filter("kind = 'backed'"), allowMissingColumns=True)
    )
    return summed(parts, words, discount).withColumn("train_tokens", F.lit(words.tokens).cast("long"))
