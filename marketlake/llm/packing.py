"""Packing documents into sequences of fixed length, as few as the search finds.

Documents become token ids with an end id; longer ones are cut into full pieces and a rest.
Pieces are spread over chunks of about `CHUNK_PIECES` by a hash. A chunk is packed best-fit,
longest piece first, then improved by local search: the emptiest sequence gives pieces to
others by a move, an exchange of one for one or of two for one, always so that tokens go from
the emptier to the fuller sequence and the sum of squared fills rises, until it is empty or
nothing more fits. Sequences that stay underfull are taken apart, dealt anew over fewer
chunks, and packed again.

Chunks are the unit of memory; their number follows the number of pieces, not a key. Null text
counts as empty: just the end id. Repeated rows are documents of their own. Empty tables give
empty results; extra columns are left out.
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize

CAPACITY = 2048
END_ID = 0
CHUNK_PIECES = 20_000
# Sequences with more room than this share are dealt anew in the second round.
LOOSE_SHARE = 0.01
REMEMBERED_WORDS = 400_000
LONGEST_REMEMBERED = 64
# Fixed value: what tokens at the end of a word end with.
WORD_END = "</w>"
# Words that go to the tokenizer in one call; bytes of texts whose words are looked up together.
WORDS_AT_ONCE = 50_000
BATCH_BYTES = 1 << 20
ID_BYTES = 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"row long, {PIECES}, sequence long, offset long"


# Tokens ------------------------------------------------------------------------------------


# Kinds of bytes: white space, ASCII letters, digits and marks; the apostrophe, which may begin
# a word such as "'s"; all others, which may be part of what stands beside them.
SPACE, LETTER, DIGIT, MARK, APOSTROPHE, OTHER = range(6)


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, np.uint8)
    for kind, characters in (
        (SPACE, string.whitespace),
        (LETTER, string.ascii_letters),
        (DIGIT, string.digits),
        (MARK, string.punctuation),
        (APOSTROPHE, "'"),
    ):
        kinds[list(characters.encode())] = kind
    return kinds


def _starts() -> np.ndarray:
    """Whether a word starts at the second of two neighbouring kinds, by 8 * first + second."""
    starts = np.zeros((8, 8), bool)
    starts[SPACE, LETTER:] = True
    starts[DIGIT, LETTER:OTHER] = True
    starts[LETTER:OTHER, DIGIT] = True
    starts[LETTER, [MARK, APOSTROPHE]] = True
    starts[MARK, LETTER] = True
    return starts.ravel()


KINDS = _kinds()
STARTS = _starts()


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers, for a tokenizer that drops white
    space, lower-cases and takes letters, single digits and runs of marks apart: words are
    encoded on their own and remembered.

    Texts come in batches. Arrow finds the distinct words of a batch, so that only those are
    looked up, and puts their ids in the places of all words. The new words of letters of a
    batch are encoded in one call and cut where a token ends a word. Words are kept in two
    halves: when the younger one is full, it becomes the older one, and only words that still
    occur come back.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings that the tokenizer takes out of the raw text as one token.
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends_word[number] = token.endswith(WORD_END)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        words, ends = self._words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.young.get, distinct))
        gaps = [i for i, known in enumerate(ids) if known is None]
        new = {distinct[i] for i in gaps}
        self._learn(new)
        for i in gaps:
            ids[i] = self.young[distinct[i]]
        for word in new:
            if len(word) > LONGEST_REMEMBERED:
                del self.young[word]
        if len(self.young) > REMEMBERED_WORDS // 2:
            self.old, self.young = self.young, {}
        found = pa.array(ids, pa.large_binary()).take(coded.indices)
        _, offsets, data = found.buffers()
        at = np.frombuffer(offsets, np.int64)[ends].tolist()
        for first, end in zip([0, *at], at):
            yield data[first:end].to_pybytes() if end > first else b""

    def _words(self, texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and for each text the number of words up to its end."""
        # Lower case saves memory; special strings count only as they are written.
        lowered = [text.lower() for text in texts]
        whole = [i for i, text in enumerate(lowered) if any(s in text for s in self.special)]
        for i in whole:
            lowered[i] = texts[i]
        data = np.frombuffer(b" " + b" ".join(lowered), np.uint8)
        ends = np.cumsum([1 + len(text) for text in lowered])
        kinds = KINDS[data]
        for i in whole:
            part = kinds[ends[i] - len(texts[i]) : ends[i]]
            part[part != SPACE] = OTHER
        starts = np.zeros(len(data), bool)
        starts[1:] = STARTS[kinds[:-1] * 8 + kinds[1:]]
        kept = kinds != SPACE
        letters = data[kept]
        offsets = np.append(np.flatnonzero(starts[kept]), len(letters))
        words = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        )
        return words, np.searchsorted(np.flatnonzero(starts), ends)

    def _learn(self, words: set[bytes]) -> None:
        young, old = self.young, self.old
        known = old.keys() & words
        young.update((word, old[word]) for word in known)
        new = words - known
        letters = [w for w in new if w.isalpha() or (not w.isascii() and self._spelled(w.decode()))]
        for some, ids_of in ((letters, self._together), (list(new.difference(letters)), self._apart)):
            for first in range(0, len(some), WORDS_AT_ONCE):
                part = some[first : first + WORDS_AT_ONCE]
                young.update(zip(part, ids_of(part)))

    @staticmethod
    def _spelled(word: str) -> bool:
        """Whether a word is of letters, also in lower case, which may split a letter in two."""
        return word.isalpha() and word.lower().isalpha()

    def _together(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of letters, encoded as one text and cut where a token ends a word."""
        text = b" ".join(words).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
        return _sliced(ids, [0, *ends]) if len(ends) == len(words) else self._apart(words)

    def _apart(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of any kind, which the tokenizer takes one by one."""
        found = self.tokenizer.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        of = np.array(found.word_ids, np.int64)
        return _sliced(np.array(found.ids, "<u4"), np.searchsorted(of, np.arange(len(words) + 1)).tolist())


def _sliced(ids: np.ndarray, ends: list[int]) -> list[bytes]:
    data = ids.tobytes()
    return [data[a * ID_BYTES : b * ID_BYTES] for a, b in zip(ends, ends[1:])]


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """Pieces of a document: number, start, length, crc32 of the ids."""
    step = capacity * ID_BYTES
    for piece, at in enumerate(range(0, len(ids), step)):
        part = ids[at : at + step]
        yield piece, at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part)


def _grouped(texts: list[bytes], most: int) -> Iterator[list[bytes]]:
    """Texts in groups of a bounded number of bytes, or one longer text alone."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


_ENCODERS: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = Encoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            texts = [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]
            ids_of = (ids for some in _grouped(texts, BATCH_BYTES) for ids in encoder.encode(some))
            rows = [
                (doc_id, *part)
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), ids_of)
                for part in cut(ids + end, capacity)
            ]
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(encode, PIECES)


# Packing a chunk ---------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            place = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[place].append(item)
        else:
            room, place = capacity, len(bins)
            bins.append([item])
        left = room - length
        if left:
            by_room[left].append(place)
            rooms |= 1 << left
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Fewer bins by moves and exchanges between underfull ones.

    One bin after the other, the emptiest first, is drained. A piece `a` of it leaves for a bin
    with room for it, or in exchange for a shorter piece, or for two neighbours by length that
    are shorter together; or two pieces leave for one. The gain in tokens must fit the room of
    the other bin, and the largest is taken. A bin that cannot be emptied stays as it has
    become, and each exchange has raised the sum of squared fills, so the search ends.
    """
    fills = np.array([lengths[b].sum() for b in bins], np.int64)
    open_ = [i for i in range(len(bins)) if fills[i] < capacity]
    fewest = -(-int(fills[open_].sum()) // capacity) if open_ else 0
    count = len(open_)
    for drained in sorted(open_, key=lambda i: fills[i]):
        if count <= fewest:
            break
        while bins[drained] and _exchange(bins, fills, lengths, capacity, drained, open_):
            pass
        if not bins[drained]:
            count -= 1
            open_.remove(drained)
    return [b for b in bins if b]


def _exchange(bins, fills, lengths, capacity, drained, open_) -> bool:
    """The largest gain that one step takes out of the drained bin; False if there is none."""
    others = [i for i in open_ if i != drained and fills[drained] <= fills[i] < capacity]
    if not others:
        return False
    room = capacity - fills
    items = np.array([x for i in others for x in bins[i]])
    owner = np.repeat(others, [len(bins[i]) for i in others])
    given = lengths[items]
    space = room[owner]
    places = np.array(others)
    best = (0, None)

    def offer(gains: np.ndarray, limit: np.ndarray, step) -> None:
        nonlocal best
        fitting = np.where((gains > 0) & (gains <= limit), gains, 0)
        if len(fitting):
            top = int(fitting.argmax())
            if fitting[top] > best[0]:
                best = (int(fitting[top]), step(top))

    # Neighbours by length within one bin.
    order = np.lexsort((given, owner))
    left, right = order[:-1], order[1:]
    pair = owner[left] == owner[right]
    left, right = left[pair], right[pair]
    mine = sorted(bins[drained], key=lambda x: -lengths[x])
    for a in mine:
        size = int(lengths[a])
        offer(np.full(len(places), size), room[places], lambda t, a=a: (places[t], [a], []))
        offer(size - given, space, lambda t, a=a: (owner[t], [a], [items[t]]))
        offer(
            size - given[left] - given[right],
            space[left],
            lambda t, a=a: (owner[left[t]], [a], [items[left[t]], items[right[t]]]),
        )
    for a, b in zip(mine, mine[1:]):
        size = int(lengths[a] + lengths[b])
        offer(size - given, space, lambda t, a=a, b=b: (owner[t], [a, b], [items[t]]))
    gain, step = best
    if step is None:
        return False
    to, leave, come = step
    for x in leave:
        bins[drained].remove(x)
        bins[to].append(x)
    for x in come:
        bins[to].remove(x)
        bins[drained].append(x)
    fills[drained] -= gain
    fills[to] += gain
    return True


def pack(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


# Packing a table ---------------------------------------------------------------------------


def _packed_round(rows: DataFrame, count: int, chunk_pieces: int, capacity: int, number: int) -> DataFrame:
    """Pack all rows in chunks; sequence numbers are unique within a round and even over rounds."""
    chunks = max(1, math.ceil(count / chunk_pieces))
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("row", "doc_id", "piece", F.lit(number)), F.lit(chunks)))

    def fill(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True])
        chunk = chunk.reset_index(drop=True)
        lengths = chunk["length"].to_numpy()
        bins = pack(lengths, capacity)
        order = np.array([x for b in bins for x in b])
        place = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        packed = chunk.iloc[order].copy()
        running = packed["length"].cumsum() - packed["length"]
        packed["offset"] = running - running.groupby(place).transform("first").to_numpy()
        packed["sequence"] = ((place * chunks + packed["chunk"].to_numpy()) * 2 + number).astype(np.int64)
        return packed[[c.split(" ")[0] for c in PACKED.split(", ")]]

    return dealt.groupBy("chunk").applyInPandas(fill, PACKED)


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, chunk_pieces: int = CHUNK_PIECES
) -> DataFrame:
    """Pieces with sequence_id and offset, the place in the sequence."""
    cut_ = pieces(docs, tokenizer, capacity).withColumn("row", F.monotonically_increasing_id())
    return packed_pieces(materialize(cut_, "pieces"), capacity, chunk_pieces)


def packed_pieces(cut_: DataFrame, capacity: int = CAPACITY, chunk_pieces: int = CHUNK_PIECES) -> DataFrame:
    # A full piece is a sequence; it takes the odd numbers' place of a third round.
    full = cut_.filter(F.col("length") == capacity)
    rest = cut_.filter(F.col("length") < capacity)
    n = rest.count()
    first = materialize(_packed_round(rest, n, chunk_pieces, capacity, 0), "packed-once")
    fills = first.groupBy("sequence").agg(F.sum("length").alias("fill"))
    loose = fills.filter(F.col("fill") < capacity * (1 - LOOSE_SHARE)).select("sequence")
    columns = [c for c in first.columns if c not in ("sequence", "offset")]
    if n <= chunk_pieces:
        both = first
    else:
        again = materialize(first.join(loose, "sequence", "left_semi").select(*columns), "loose-pieces")
        second = _packed_round(again, again.count(), chunk_pieces, capacity, 1)
        both = first.join(loose, "sequence", "left_anti").unionByName(second)
    numbered = both.withColumnRenamed("sequence", "sequence_id")
    alone = full.withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    return numbered.unionByName(alone).drop("row")
