"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton names every vocabulary piece that ends at a character; dynamic
programming carries the best score up to there and the number of pieces on the way. Ties and
unknown characters follow the unigram tokenizer: of equal scores the path whose last piece
starts first stays; a character that is no piece of its own may be taken as unknown at the
lowest score less 10; runs of unknown characters are one unknown piece, or one piece per byte
where the vocabulary has all 256 byte pieces.

Texts are cut at spaces as the tokenizer cuts them: every space opens a segment that begins
with the word mark, and a text that does not begin with a space gets one. Segments are scored
on their own, so a worker remembers the counts of those it has seen, within a fixed size.

The vocabulary is a fixed table of a tokenizer file, sent to the tasks whole. Byte, control
and unknown pieces never match text. Null counts as empty: no token. Very long
segments take time and memory in proportion to their length. Repeated rows get a row each;
empty tables give empty results; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Segments a worker remembers, and the longest of them in characters.
REMEMBERED_SEGMENTS = 500_000
LONGEST_REMEMBERED = 64
SCHEMA = "doc_id long, n_tokens long, n_segments long"


class Vocabulary(NamedTuple):
    """Pieces with their scores, the lowest score of all, and whether bytes stand in for the
    unknown."""

    pieces: tuple[tuple[str, float], ...]
    lowest: float
    bytes_known: bool


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces and scores of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.vocab_size())
    plain = [n for n in numbers if not (model.is_byte(n) or model.is_control(n) or model.is_unknown(n))]
    pieces = tuple((model.id_to_piece(n), model.get_score(n)) for n in plain)
    lowest = min(model.get_score(n) for n in numbers)
    return Vocabulary(pieces, lowest, sum(map(model.is_byte, numbers)) == 256)


class Counter(dict):
    """Pieces on the best path of each segment; segments asked for are remembered."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown = vocabulary.lowest - UNKNOWN_PENALTY
        self.bytes_known = vocabulary.bytes_known

    def __missing__(self, segment: str) -> int:
        count = self.pieces(segment if segment[:1] == MARK else MARK + segment)
        if len(segment) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED_SEGMENTS:
                self.clear()
            self[segment] = count
        return count

    def pieces(self, text: str) -> int:
        """Pieces on the best path through a segment, its mark included."""
        n = len(text)
        scores: list = [None] * (n + 1)
        counts = [0] * (n + 1)
        scores[0] = 0.0
        unknown_last: set[int] = set()
        done, alone = 0, True
        for last, (length, score) in self.matches.iter(text):
            end = last + 1
            if end != done:
                # All matches up to `done` have been seen; unknown characters close the gaps.
                if not alone:
                    self._unknown(text, done, scores, counts, unknown_last)
                for gap in range(done + 1, end):
                    self._unknown(text, gap, scores, counts, unknown_last)
                done, alone = end, False
            # Longer pieces come first, and they start earlier: only a better score replaces them.
            start = end - length
            candidate = score + scores[start]
            if scores[end] is None or candidate > scores[end]:
                scores[end] = candidate
                counts[end] = counts[start] + 1
            if length == 1:
                alone = True
        if not alone:
            self._unknown(text, done, scores, counts, unknown_last)
        for gap in range(done + 1, n + 1):
            self._unknown(text, gap, scores, counts, unknown_last)
        return counts[n]

    def _unknown(self, text: str, end: int, scores: list, counts: list, unknown_last: set[int]) -> None:
        """The character before `end` as an unknown one."""
        start = end - 1
        candidate = self.unknown + scores[start]
        if scores[end] is None or candidate > scores[end]:
            scores[end] = candidate
            if self.bytes_known:
                counts[end] = counts[start] + len(text[start].encode())
            else:
                counts[end] = counts[start] + (start not in unknown_last)
            unknown_last.add(end)

    def text(self, text: str) -> tuple[int, int]:
        """Pieces and segments of a text."""
        if not text:
            return 0, 0
        segments = text.split(" ")
        if text[0] == " ":
            del segments[0]
        return sum(map(self.__getitem__, segments)), len(segments)


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and n_segments of every document, under the vocabulary of a file."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker that runs several tasks keeps its automaton and what it remembers.
        if path not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[path] = Counter(vocabulary.value)
        counter = _COUNTERS[path]
        for batch in batches:
            counted = [counter.text(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([tokens for tokens, _ in counted], pa.int64()),
                    pa.array([segments for _, segments in counted], pa.int64()),
                ],
                names=["doc_id", "n_tokens", "n_segments"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, SCHEMA)
