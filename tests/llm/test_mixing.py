import pytest
from pyspark.sql import functions as F

from marketlake.llm import mixing


def shared(sizes):
    """Targets by the rule itself: share by weight, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total = mixing.BUDGET * sum(sizes.values())
    capped = {}
    while True:
        open_ = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > mixing.CAP * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: float(mixing.CAP * sizes[s]) for s in over}


@pytest.fixture(scope="module")
def mixed(documents):
    return mixing.mixed(documents).collect()


def test_targets(make, rows):
    docs = make(*[(i, "w " * n, None, s) for i, (s, n) in enumerate([("b", 9), ("a", 1), (None, 40), ("é", 30), ("", 2), ("z", 100)])])
    sizes = {"b": 9, "a": 1, None: 40, "é": 30, "": 2, "z": 100}
    found = {r["source"]: r["target"] for r in mixing.targets(mixing.sizes(docs)).collect()}
    assert found == pytest.approx(shared(sizes))


def test_taken_words_come_near_the_targets(mixed):
    taken, target, largest = {}, {}, {}
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * len(r["positions"])
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
        assert len(r["positions"]) <= mixing.CAP
    for source, words in taken.items():
        assert abs(words - target[source]) <= largest[source] / 2 + 1


@pytest.mark.parametrize("schedule", mixing.SCHEDULES)
def test_inverse_of_the_demand(spark, schedule):
    shares = [i / 50 for i in range(51)]
    frame = spark.createDataFrame([(s,) for s in shares], "share double")
    times = [r[0] for r in frame.select(mixing.time_due(F.col("share"), schedule)).collect()]
    assert times == sorted(times) and 0 <= times[0] and times[-1] <= 1
    for share, time in zip(shares, times):
        assert mixing.due(time, schedule) == pytest.approx(share, abs=1e-9)


def test_positions_follow_the_schedules(mixed):
    """Half-way through training, each source has given what its schedule says."""
    sources = sorted({r["source"] for r in mixed}, key=str.encode)
    for place, source in enumerate(sources):
        rows = [r for r in mixed if r["source"] == source]
        due = mixing.due(0.5, mixing.SCHEDULES[place % 3]) * rows[0]["target"]
        given = sum(r["size"] for r in rows for p in r["positions"] if p <= 0.5)
        assert abs(given - due) <= max(r["size"] for r in rows)


def test_runs_agree_whatever_the_partitions(documents, rows):
    columns = ("doc_id", "positions")
    once = rows(mixing.mixed(documents), *columns)
    assert rows(mixing.mixed(documents.repartition(7, "source")), *columns) == once


def test_mixture_repeats_whole_documents_in_order(make):
    docs = make((1, "a b c", None, "s"), (2, None, None, "s"), (3, "d " * 50, None, None), (3, "d " * 50, None, None), (4, "", "en", "t"))
    mix = mixing.mixture(docs)
    assert mix.columns == docs.columns
    taken = sum(r["size"] * len(r["positions"]) for r in mixing.mixed(docs).collect())
    assert sum(len((r["text"] or "").split()) for r in mix.collect()) == taken


def test_sources_without_words(make):
    docs = make((1, None, None, "s"), (2, "", None, None))
    assert {(r["target"], tuple(r["positions"])) for r in mixing.mixed(docs).collect()} == {(0.0, ())}


def test_empty_table(make):
    empty = make((1, "a")).limit(0)
    assert mixing.mixed(empty).count() == 0 and mixing.mixture(empty).count() == 0
