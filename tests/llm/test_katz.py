import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlake.llm import katz
from marketlake.llm.text import remainder
from pyspark.sql import functions as F

START, END = "<s>", "</s>"


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


class Brute:
    def __init__(self, texts):
        self.words, self.pairs, self.contexts = Counter(), Counter(), Counter()
        for tokens in texts:
            self.words.update(tokens)
            before = [START, *tokens[:-1]]
            self.pairs.update(zip(before, tokens))
            self.contexts.update(before)
        self.n = sum(self.words.values())
        self.of_word = katz.discounts(self.kinds(self.words))
        self.of_pair = katz.discounts(self.kinds(self.pairs))
        self.unknown = (self.taken(self.words.values(), self.of_word) + 1) / (self.n + 1)
        self.followers = defaultdict(list)
        for (h, w), c in self.pairs.items():
            self.followers[h].append((w, c))

    @staticmethod
    def kinds(counts):
        of = Counter(counts.values())
        return np.array([0] + [of[r] for r in range(1, katz.LARGEST + 2)], float)

    @staticmethod
    def taken(counts, discount):
        return sum((1 - discount[c]) * c for c in counts if c <= katz.LARGEST)

    def unigram(self, w):
        c = self.words[w]
        return c * (self.of_word[c] if c <= katz.LARGEST else 1) / (self.n + 1) if c else self.unknown

    def alpha(self, h):
        if h not in self.followers:
            return 1.0
        left = self.taken([c for _, c in self.followers[h]], self.of_pair) + 1
        return left / (self.contexts[h] + 1) / (1 - sum(self.unigram(w) for w, _ in self.followers[h]))

    def p(self, h, w):
        c = self.pairs.get((h, w), 0)
        if c:
            return c * (self.of_pair[c] if c <= katz.LARGEST else 1) / (self.contexts[h] + 1)
        return self.alpha(h) * self.unigram(w)


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def check(docs):
    texts = [(r["doc_id"], tokens(r["text"])) for r in docs.collect()]
    model = Brute([t for i, t in texts if not held(i)])
    kinds = len(model.words)
    found = sorted(katz.scored(docs, remainder(F.col("doc_id"), 10) == 0).collect(), key=lambda r: (str(r["doc_id"]), r["score"]))
    expected = []
    for i, t in texts:
        score = sum(math.log10(model.p(h, w)) for h, w in zip([START, *t], t))
        base = sum(math.log10((model.words[w] + 0.1) / (model.n + 0.1 * (kinds + 1))) for w in t)
        expected.append((i, held(i), len(t), sum(model.words[w] > 0 for w in t), base, score))
    expected.sort(key=lambda r: (str(r[0]), r[5]))
    assert len(found) == len(expected)
    for row, want in zip(found, expected):
        assert (row["doc_id"], row["held_out"], row["n_tokens"], row["n_known"]) == want[:4]
        assert row["base_score"] == pytest.approx(want[4], rel=1e-9)
        assert row["score"] == pytest.approx(want[5], rel=1e-8, abs=1e-8)
        assert row["train_tokens"] == model.n
    return model


def test_scores_against_brute_force(documents):
    model = check(documents)
    for h in (START, b"the", b"of", b"never seen"):
        total = sum(model.p(h, w) for w in model.words) + model.alpha(h) * model.unknown
        assert total == pytest.approx(1.0, abs=1e-9)


def test_small_chunks_and_spread_words(documents, monkeypatch):
    monkeypatch.setattr(katz, "SPREAD_SHARE", 0.001)
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 3000)
    check(documents.limit(60))


def test_odd_texts(make):
    check(make((1, None), (2, ""), (None, "a b"), (3, "A b a B"), (3, "A b a B"), (10, "z z z"), (11, "a " * 3000), (12, "  \x1c")))


def test_nothing_to_train_on(make):
    # crc32 of these ids leaves no remainder: all are held out.
    ids = [i for i in range(200) if held(i)][:3]
    rows = katz.scored(make(*[(i, "a b") for i in ids]), remainder(F.col("doc_id"), 10) == 0).collect()
    assert [(r["train_tokens"], r["n_known"], r["score"]) for r in rows] == [(0, 0, 0.0)] * 3


def test_held_out_scores_beat_the_base(documents):
    rows = katz.scored(documents, remainder(F.col("doc_id"), 10) == 0).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


@pytest.mark.parametrize("kinds", ([0, 100, 40, 20, 12, 8, 6], [0, 5, 50, 5, 5, 5, 5], [0, 1, 1, 1, 1, 1, 1], [0] * 7))
def test_discounts_lie_between_0_and_1(kinds):
    found = katz.discounts(np.array(kinds, float))[1:]
    assert (found > 0).all() and (found < 1).all()


def test_empty_table(make):
    assert katz.scored(make((1, "a")).limit(0), F.lit(False)).count() == 0
