import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketlake.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_give_the_ids_of_the_whole_text(tokenizer):
    draw = random.Random(2)
    parts = ["a", "B", " ", "é", "É", "é", "́", "it's", "'", "<|endoftext|>", "<|ENDOFTEXT|>", " ", "\n", "1", "23", ".", "梦", "𝄞", "\x1c", "\x85", "　", "ΑΣ", "İ"]
    encoder = packing.Encoder(PATH)
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 20))) for _ in range(1500)] + ["x" * 5000]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_marks_and_digits_are_no_part_of_words(tokenizer):
    """Only the parts of a text are remembered, however they are put together; marks that begin
    a word with letters or that a letter beside them may change stay."""
    texts = ["tea. (tea) tea,*** tea### 2tea-22", "it's", "O''s", "é. tea", "\u0301", ".\u0301a", "", " \n", "a<|endoftext|>b. B."]
    encoder = packing.Encoder(PATH)
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    parts = ["tea", ".", "(", ")", ",***", "###", "2", "-", "it", "'s", "o", "''s", "é.", "\u0301", ".\u0301a", "a<|endoftext|>b.", "B."]
    assert set(encoder.young) == {p.encode() for p in parts}


@pytest.mark.parametrize("texts", [[], [""], ["", ""], ["", "a", "", "b"]])
def test_texts_without_words(tokenizer, texts):
    found = [np.frombuffer(ids, "<u4").tolist() for ids in packing.Encoder(PATH).encode([t.encode() for t in texts])]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_parts_of_words_give_the_ids_of_the_whole_text(tokenizer):
    draw = random.Random(3)
    beside = ["\u0301", "\u0338", "\u20e3", "\u037e", "\u1fef", "\u212a", "\u0663", "\u00bd", "\u00e9"]
    parts = [chr(i) for i in range(128)] + ["'s", "'re", "<|startoftext|>", *beside]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(2000)]
    for text, ids in zip(texts, packing.Encoder(PATH).encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, texts, tokenizer, capacity):
    """Every document is there once, whole and in order; sequences have no gap and no excess."""
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in texts}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        parts.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in parts] == list(range(0, len(ids[i]), capacity))
        for r in parts:
            part = ids[i][r["start"] : r["start"] + capacity]
            assert (r["length"], r["ids_crc32"]) == (len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence), sum(map(len, ids.values()))


def test_documents_in_sequences(documents, tokenizer):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    count, tokens = check(packing.packed(documents, PATH).collect(), texts, tokenizer, packing.CAPACITY)
    assert count <= -(-tokens // packing.CAPACITY) + 1


def test_many_chunks(documents, tokenizer):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    count, tokens = check(packing.packed(documents, PATH, 256, chunk_pieces=40).collect(), texts, tokenizer, 256)
    assert count <= 1.03 * tokens / 256


def test_odd_texts(make, tokenizer):
    docs = make((1, None), (2, ""), (3, "a " * 5000), (4, "a " * 2047), (5, "a " * 2048), (6, "x"))
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(packing.packed(docs, PATH).collect(), texts, tokenizer, packing.CAPACITY)
    repeated = packing.packed(make((1, "x y"), (1, "x y"), (None, "z")), PATH).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in repeated) == [("1", 3), ("1", 3), ("None", 2)]
    assert sorted(r["offset"] for r in repeated) in ([0, 2, 5], [0, 3, 6], [0, 3, 5])


def squared(bins, lengths):
    return sum(int(lengths[b].sum()) ** 2 for b in bins)


@pytest.mark.parametrize("seed", range(8))
def test_local_search_raises_the_squared_fill(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(20, 60, 120)
    start = packing.best_fit(lengths, 100)
    before, count = squared(start, lengths), len(start)
    found = packing.local_search([list(b) for b in start], lengths, 100)
    assert sorted(x for b in found for x in b) == list(range(120))
    assert all(lengths[b].sum() <= 100 for b in found)
    assert squared(found, lengths) >= before and len(found) <= count


def test_exchanges_empty_a_sequence():
    """18 changes places with 10, and 10 finds room."""
    lengths = np.array([60, 30, 78, 10, 18])
    bins = [[0, 1], [2, 3], [4]]
    assert len(packing.local_search(bins, lengths, 100)) == 2


def test_empty_table(make):
    assert packing.packed(make((1, "a")).limit(0), PATH).count() == 0
