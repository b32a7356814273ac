import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm import suffix_dedup
from marketlake.llm.catalog import registered

FOLDER = "/root/testdata/sf0.001"


def brute(rows, length=200):
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    seen = Counter(data[i : i + length] for _, data in texts for i in range(len(data) - length + 1))
    out = []
    for doc_id, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def read(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_brute_force(spark):
    found = registered()["op13_suffix_dedup"](spark, FOLDER)
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert read(found) == brute(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=12), min_size=1, max_size=6))
def test_loser_tree(runs):
    runs = [sorted(run) for run in runs]
    sources = [suffix_dedup.decoded(*suffix_dedup.front_coded(run)) for run in runs]
    found = list(suffix_dedup.merged(sources))
    assert [s for _, _, s in found] == sorted(s for run in runs for s in run)
    for (_, _, a), (n, _, b) in zip(found, found[1:]):
        assert n == suffix_dedup.shared(a, b)
    for run in range(len(runs)):
        assert [s for _, r, s in found if r == run] == runs[run]


def test_known_prefixes_are_not_compared_again(monkeypatch):
    looked = 0

    def counted(a, b, known=0):
        nonlocal looked
        n = suffix_dedup_shared(a, b, known)
        looked += n - known + 1
        return n

    suffix_dedup_shared = suffix_dedup.shared
    runs = [[b"x" * 150 + bytes([i, r]) for i in range(40)] for r in range(16)]
    coded = [suffix_dedup.front_coded(run) for run in runs]
    monkeypatch.setattr(suffix_dedup, "shared", counted)
    assert len(list(suffix_dedup.merged([suffix_dedup.decoded(*c) for c in coded]))) == 640
    # 16 first strings meet on 150 bytes; afterwards two bytes a comparison are left.
    assert looked < 16 * 152 + 640 * 4 * 3


def test_anchors_own_all_windows_and_move_with_their_text():
    chance = random.Random(1)
    text = bytes(chance.choice(b"ab c") for _ in range(3000))
    codes = np.frombuffer(text, np.uint8)
    anchors, first, last, cores = suffix_dedup.anchors_of(codes, 200)
    assert first[0] == 0 and last[-1] == len(text) - 200 and (first[1:] == last[:-1] + 1).all()
    assert ((anchors - first) <= suffix_dedup.reach(200)).all() and (anchors >= last).all()
    moved = suffix_dedup.anchors_of(np.frombuffer(b"xyz" * 5 + text, np.uint8), 200)
    assert set(zip((moved[0] - 15).tolist(), moved[3].tolist())) >= set(zip(anchors.tolist()[1:], cores.tolist()[1:]))


def passages(chance, n):
    """Texts that share passages with different neighbours, of lengths around the limit."""
    shared = ["".join(chance.choice("abcd ") for _ in range(chance.choice([39, 40, 41, 60, 150]))) for _ in range(8)]
    texts = []
    for i in range(n):
        parts = []
        for _ in range(chance.randrange(1, 6)):
            parts.append(chance.choice(shared)[chance.randrange(3) :])
            parts.append("".join(chance.choice("abcdé") for _ in range(chance.randrange(30))))
        texts.append((i, "".join(parts)))
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_passages_against_brute_force(make, seed):
    rows = passages(random.Random(seed), 60)
    rows += [(None, rows[0][1]), (0, rows[0][1]), (70, None), (71, ""), (72, "ab" * 300), (73, "z" * 39), (74, "y" * 41)]
    docs = make(*rows).repartition(3)
    found = suffix_dedup.without_repeats(docs, length=40, run_bytes=700, bucket_bytes=900)
    assert read(found) == brute(rows, 40)


def test_long_texts_in_blocks_and_parts(make, monkeypatch):
    chance = random.Random(4)
    long = "".join(chance.choice("abcdefgh é") for _ in range(40_000))
    rows = [(1, long), (2, long[1000:9000] + "!" + long[20_000:20_400]), (3, "q" * 5000), (4, long[30_000:30_199]), (5, long[30_000:30_200])]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(suffix_dedup, "SORTED_SUFFIXES", 50)
    assert read(suffix_dedup.without_repeats(make(*rows))) == brute(rows)


def test_empty(make):
    assert suffix_dedup.without_repeats(make((1, "a")).limit(0)).count() == 0
