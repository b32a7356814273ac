from collections import defaultdict

import numpy as np
import pytest

from marketlake.llm import ngram_join
from marketlake.llm.components import components


def sets_of(docs, n=4):
    found = []
    for r in docs.select("doc_id", "text").collect():
        words = (r["text"] or "").encode().lower().split()
        grams = frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()
        found.append((r["doc_id"], grams))
    return found


def brute(docs, threshold=85, n=4):
    found = sets_of(docs, n)
    root = list(range(len(found)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(found):
        for j in range(i):
            b = found[j][1]
            if a and b and 100 * len(a & b) >= threshold * len(a | b):
                root[top(i)] = top(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(found):
        ids[top(i)].append(doc_id)
    smallest = {r: min((x for x in members if x is not None), default=None) for r, members in ids.items()}
    return sorted((str(d), len(s), smallest[top(i)] if s else d) for i, (d, s) in enumerate(found))


def joined(docs, **settings):
    return sorted((str(r["doc_id"]), r["size"], r["component_id"]) for r in ngram_join.joined(docs, **settings).collect())


def test_components_against_brute_force(documents):
    assert joined(documents) == brute(documents)


def near_copies(n=60):
    """One text with other words here and there: neighbours link, distant ones do not."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        words[(7 * i) % 120] = f"x{i}"
        if i % 3 == 0:
            words[(11 * i) % 120] = f"y{i}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("all_pairs, part_rows", ((12, 2000), (2, 2000), (2, 5)))
def test_columns_that_many_share(make, monkeypatch, all_pairs, part_rows):
    monkeypatch.setattr(ngram_join, "ALL_PAIRS", all_pairs)
    monkeypatch.setattr(ngram_join.later_turn, "__defaults__", (part_rows,))
    docs = make(*near_copies())
    assert joined(docs) == brute(docs)


def test_exactly_at_the_threshold(make):
    words = [f"w{i}" for i in range(23)]
    # 20 shingles each, 17 of 20 and 17 of 23 in common.
    docs = make((1, " ".join(words)), (2, " ".join(words[:20])), (3, " ".join(words[:19])), (4, " ".join(words[3:] + ["a", "b", "c"])))
    assert joined(docs) == brute(docs)
    assert dict((i, c) for i, _, c in joined(docs))["2"] == 1


def test_odd_texts(make):
    docs = make(
        (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, "a b c d"), (8, "a b"),
        (None, "p q r s t"), (9, "p q r s t"), (9, "p q r s t"), (None, "lone one"), (10, " "), (11, "z " * 30_000), (12, "z z z z"),
    )
    assert joined(docs) == brute(docs)


def test_null_ids_link_with_other_texts(make):
    words = [f"w{i}" for i in range(60)]
    named, unnamed = " ".join(words), " ".join(w + "x" for w in words)
    docs = make((1, named), (None, named + " one end"), (None, unnamed), (None, unnamed + " end"), (None, unnamed + " end"), (2, "z"))
    assert joined(docs) == brute(docs)
    assert [c for i, _, c in joined(docs) if i == "None"].count(1) == 1
    kept = {r["text"] for r in ngram_join.representatives(docs).collect()}
    assert named in kept and "z" in kept and len(kept) == 3


def test_one_of_each_group_stays(make):
    docs = make(*near_copies(20), (50, None), (51, "other words"), (52, "other words"))
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    expected = {c for _, _, c in brute(docs)}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(expected)


def test_same_id_with_different_texts(make):
    long = " ".join(f"w{i}" for i in range(30))
    docs = make((1, long), (2, long), (2, "something else altogether"), (3, long + " end"))
    kept = sorted((r["doc_id"], len(r["text"])) for r in ngram_join.representatives(docs).collect())
    assert kept == [(1, len(long)), (2, 25)]


def test_bounds_keep_every_link():
    draw = np.random.default_rng(5)
    for _ in range(300):
        a = np.unique(draw.integers(0, 60, 40).astype(np.uint64))
        b = np.unique(np.concatenate([a[draw.random(len(a)) > 0.07], draw.integers(0, 60, 2).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 85 * (len(a) + len(b) - common):
            continue
        pa_, pb = ngram_join.prefix_length(len(a), 85), ngram_join.prefix_length(len(b), 85)
        shared = np.intersect1d(a[:pa_], b[:pb])
        assert len(shared)
        first = shared[0]
        assert ngram_join.possible(len(a), np.searchsorted(a, first), len(b), np.searchsorted(b, first), 85)
        folds = ngram_join.overlaps([ngram_join.folded(a), ngram_join.folded(b)])[0, 1]
        assert folds >= common >= ngram_join.needed(len(a), len(b), 85)


def test_blocked_product(monkeypatch):
    draw = np.random.default_rng(6)
    rows = [np.sort(draw.integers(0, 400, draw.integers(0, 90)).astype("<u2")) for _ in range(25)]
    expected = [[sum(min((a == v).sum(), (b == v).sum()) for v in np.unique(a)) for b in rows] for a in rows]
    whole = ngram_join.overlaps(rows)
    monkeypatch.setattr(ngram_join, "PRODUCT_COLUMNS", 7)
    for found in (whole, ngram_join.overlaps(rows)):
        off = ~np.eye(25, dtype=bool)
        assert (found[off] == np.array(expected)[off]).all()


def test_connected_components(spark):
    draw = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in draw.integers(0, 120, (90, 2))] + [(500 + i, 501 + i) for i in range(40)] + [(1000, 2000 + i) for i in range(50)]
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    expected = {i: top(i) for i in root if any(i in p for p in pairs if p[0] != p[1])}
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == expected


def test_empty_table(make):
    empty = make((1, "a")).limit(0)
    assert ngram_join.joined(empty).count() == 0 and ngram_join.representatives(empty).count() == 0
