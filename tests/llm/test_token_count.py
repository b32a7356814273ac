import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from marketlake.llm import token_count

PATH = public_tokenizers.path("piece_bpe_32k.model")


def tokenizer(vocabulary, byte_fallback):
    found = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    found.pre_tokenizer = pre_tokenizers.Metaspace()
    return found


@pytest.fixture(scope="module")
def exact():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return tokenizer([(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())], True)


def test_documents(documents, exact):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = {r["doc_id"]: r["n_tokens"] for r in token_count.token_counts(documents, PATH).collect()}
    assert found == {i: len(exact.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_odd_texts(exact):
    counter = token_count.Counter(token_count.read_vocabulary(PATH))
    draw = random.Random(1)
    parts = ["a", "b", " ", "é", "𝄞", "ing", "\n", "梦", "the", "́", "0", "\x00"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(2000)] + ["x" * 20_000, "𝄞" * 300]
    for text in texts:
        assert counter.text(text)[0] == len(exact.encode(text, add_special_tokens=False).ids), text


def test_ties_and_runs_of_unknown_characters():
    vocabulary = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("▁", -1.0), ("▁a", -2.0), ("aba", -3.0)]
    exact = tokenizer(vocabulary, False)
    counter = token_count.Counter(token_count.Vocabulary(tuple(vocabulary[1:]), -3.0, False))
    draw = random.Random(4)
    for _ in range(3000):
        text = "".join(draw.choices("aab xy", k=draw.randint(0, 14)))
        assert counter.text(text)[0] == len(exact.encode(text, add_special_tokens=False).ids), text


def test_forgetting_changes_nothing(documents, monkeypatch):
    texts = [r["text"] for r in documents.limit(20).collect()]
    vocabulary = token_count.read_vocabulary(PATH)
    whole = [token_count.Counter(vocabulary).text(t) for t in texts]
    monkeypatch.setattr(token_count, "REMEMBERED_SEGMENTS", 5)
    small = token_count.Counter(vocabulary)
    assert [small.text(t) for t in texts] == whole


def test_null_empty_and_repeated(make, rows):
    docs = make((1, None), (2, ""), (3, " "), (3, " "), (None, "a"))
    found = rows(token_count.token_counts(docs, PATH), "doc_id", "n_tokens", "n_segments")
    assert found == [(None, 1, 1), (1, 0, 0), (2, 0, 0), (3, 1, 1), (3, 1, 1)]
    assert token_count.token_counts(docs.limit(0), PATH).count() == 0
