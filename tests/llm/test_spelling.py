import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm import spelling
from marketlake.llm.catalog import registered

FOLDER = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [o for k in (-1, 0, 1) for o in by_length.get(len(w) + k, ()) if one_edit(w, o)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            forms[w] = best
    found = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        found.append((w, form, root, n, len(near[w]), words.get(form)))
    return sorted(found, key=lambda r: r[0])


def read(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abÀ\U0001f600", max_size=7), min_size=1, max_size=8), st.lists(st.text("abÀ\U0001f600", max_size=7), min_size=1, max_size=8))
def test_tiles_find_single_edits(left, right):
    i, j = spelling.single_edits(left, right)
    expected = {(x, y) for x, a in enumerate(left) for y, b in enumerate(right) if one_edit(a, b)}
    assert set(zip(i.tolist(), j.tolist())) == expected


def test_query_against_brute_force(spark):
    found = registered()["op11_spelling_variants"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    expected = brute([tuple(r) for r in docs])
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert read(found) == expected
    assert any(form for _, form, *_ in expected)


def test_chains_ties_and_accents(make):
    counts = {
        "étrange": 700, "etrange": 100, "etranges": 10, "etrangez": 10, "xetrangez": 5,
        "colour": 30, "colours": 150, "colourz": 150, "short": 900, "shorts": 4, "a" * 300: 6, "a" * 299: 40,
    }
    text = " ".join(word for word, n in counts.items() for _ in range(n))
    rows = [(1, text.replace("etrange ", "ETRANGE ")), (2, None), (None, "ÉTRANGE, étrangè9" * 6), (3, ""), (3, "12 .")]
    assert read(spelling.variants(make(*rows))) == brute(rows)


def test_large_bins_are_cut_in_blocks(spark, monkeypatch):
    import itertools

    words = ["".join(w) + "xyzw" for w in itertools.product("abcdefgh", repeat=3)]
    counts = [(w, 5 + i % 7 * (i % 11)) for i, w in enumerate(words)]
    frame = spark.createDataFrame(counts, "word string, n long")
    found = {(r["word"], r["other"]) for r in spelling.near_words(frame, tile=16, stretch=3).collect()}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_empty(make):
    assert spelling.variants(make((1, "nothing long")).limit(0)).count() == 0
    assert spelling.variants(make((1, "too few words"), (2, None))).count() == 0
