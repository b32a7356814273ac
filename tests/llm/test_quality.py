import math
import re
from collections import Counter

import pytest

from marketlake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    found = WORD.findall(text)
    triples = Counter(zip(found, found[1:], found[2:]))
    covered = set()
    for at in range(len(found) - 2):
        if triples[tuple(found[at : at + 3])] > 1:
            covered |= {at, at + 1, at + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in quality.SYMBOLS for c in text)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


def test_base_counts(make):
    texts = [
        None,
        "",
        " \t\n\x0b\x0c\r ",
        "one",
        "a b c a b c a b",
        "a a a a",
        "x y\nx y\n\n \nx y\nz",
        "é b   #*$%&|<> \x00",
        "a b c d a b c e b c d",
        "w " * 5000,
    ]
    docs = make(*enumerate(texts))
    found = {r["doc_id"]: tuple(r[c] for c in quality.BASE_COLUMNS) for r in quality.judged(docs).collect()}
    assert found == {i: counted(text) for i, text in enumerate(texts)}


def js(p, q):
    keys = set(p) | set(q)
    total = 0.0
    for k in keys:
        a, b = p.get(k, 0.0), q.get(k, 0.0)
        m = (a + b) / 2
        total += sum(x * math.log2(x / m) for x in (a, b) if x > 0) / 2
    return math.sqrt(max(total, 0.0))


def test_distances_against_brute_force(documents):
    docs = documents.limit(80)
    texts = {r["doc_id"]: (r["text"], r["lang"]) for r in docs.collect()}
    counts, sizes = {}, Counter()
    for text, lang in texts.values():
        found = WORD.findall(text)
        counts.setdefault(lang, Counter()).update(found)
        sizes[lang] += len(found)
    shares = {}
    for lang, counter in counts.items():
        top = sorted(counter.items(), key=lambda x: (-x[1], x[0].encode()))[: quality.COMMON_WORDS]
        shares[lang] = {w: n / sizes[lang] for w, n in top}
    for row in quality.judged(docs).collect():
        found = WORD.findall(texts[row["doc_id"]][0])
        best = []
        for lang, share in shares.items():
            mine = Counter(w if w in share else None for w in found)
            p = {k: n / len(found) for k, n in mine.items()}
            best.append((set(p) <= {None}, js(p, {**share, None: 1 - sum(share.values())})))
        assert row["word_distance"] == pytest.approx(min(best)[1], abs=1e-6)


def test_verdict_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = quality.judged(spark.read.parquet(f"{folder}/documents.parquet")).filter("not base_failed")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    pairs = found.join(labels, "doc_id").select("quality", "kept").collect()
    good, bad = [k for q, k in pairs if q == 1], [k for q, k in pairs if q == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.15 * len(bad)


def test_without_languages_the_base_rules_decide(make, rows):
    docs = make((1, " ".join(f"w{i}" for i in range(60))), (2, "short"), (2, "short"), (3, "~ " * 10 + "§" * 80))
    assert rows(quality.judged(docs), "doc_id", "base_failed", "kept") == [
        (1, False, True),
        (2, True, False),
        (2, True, False),
        (3, True, False),
    ]


def test_empty_table(make):
    assert quality.judged(make((1, "a", "en")).limit(0)).count() == 0


def test_languages_that_were_not_learned(make, monkeypatch):
    monkeypatch.setattr(quality.common_words, "__defaults__", (quality.COMMON_WORDS, 1))
    own = " ".join(f"a{i * i % 41}b{i // 60}" for i in range(200))
    foreign = "a0b0 " + " ".join(f"z{i}y" for i in range(90))
    docs = make((1, own, "aa"), (2, own, "aa"), (3, foreign, "zz"), (4, foreign, "aa"), (5, foreign))
    found = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.judged(docs).collect()}
    assert found[3] == (False, True)
    assert found[4] == found[5] == (False, False)


def test_texts_without_a_common_word_are_furthest(make):
    own = " ".join(f"a{i * i % 41}b{i // 60}" for i in range(200))
    bare = " ".join(f"z{i}y" for i in range(90))
    docs = make((1, own, "aa"), (2, own, "aa"), (3, bare), (4, "a0b0 " + bare), (5, bare, "aa"))
    found = {r["doc_id"]: r for r in quality.judged(docs).collect()}
    assert found[1]["nearest"] == found[3]["nearest"] == "aa"
    assert not found[3]["base_failed"] and not found[3]["kept"]
    assert found[3]["word_distance"] > found[4]["word_distance"] > 0.5
    assert not found[5]["kept"]
