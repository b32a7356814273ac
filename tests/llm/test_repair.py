import hashlib
import itertools
import random
import re
import zlib

import pytest

from marketlake.llm import repair
from marketlake.llm.catalog import registered

FOLDER = "/root/testdata/sf0.001"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def damage(rows):
    """Rows of one conversation, in order, after damage."""
    out = []
    nulls_first = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{' ' if r[2] is None else r[2]}\n{' ' if r[3] is None else r[3]}".encode()).hexdigest()))
    for conv, turn, role, text in nulls_first:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        body = text.strip(BLANKS)
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def best_audit(rows, wrong):
    """Cheapest, then least audit with its lines: whole strings, all states, no sharing."""
    moves = {"": {"u": "u", "s": "s"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    long = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for new in moves[state]:
                    if new != "s":
                        offer = (cost + 3, audit + "I", (*lines, f"{long[new]}:"))
                        best[new] = min(best.get(new, offer), offer)
        return best

    for (_, role, text), fault in zip(rows, wrong):
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offers = [(state, (cost + 4, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role[:1] in moves[state]:
                    offers.append((role[:1], (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
                for new in moves[state]:
                    if new != "s":
                        offers.append((new, (cost + 3 + extra, audit + "R", (*lines, f"{long[new]}:{text}"))))
            for new, offer in offers:
                after[new] = min(after.get(new, offer), offer)
        best = after
    return min(v for s, v in inserted(best).items() if s in ("", "a"))


def brute(table):
    groups = {}
    for row in table:
        groups.setdefault(row[0], []).append(row)
    out = []
    for conv, rows in groups.items():
        rows = damage(rows)
        wrong = faults(rows)
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = best_audit(rows, wrong)
        counts = [wrong.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def read(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = registered()["op12_conversation_repair"](spark, FOLDER)
    assert found.columns == COLUMNS
    assert read(found) == brute(rows)


def every_audit(rows):
    """All audits with at most two insertions in a row, with their costs."""
    letters = {repair.SOUND: "KRD", repair.BROKEN_OFF: "KRD", repair.UNUSABLE: "D"}
    for plan in itertools.product(*[letters[q] for _, q in rows]):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            yield plan, inserts


def exhaustive(rows):
    found = []
    for plan, inserts in every_audit(rows):
        state, cost, audit, good = "", 0, "", True

        def turn():
            return "a" if state == "u" else "u"

        for at in range(len(rows) + 1):
            for _ in range(inserts[at]):
                state, cost, audit = turn(), cost + 3, audit + "I"
            if at == len(rows):
                break
            initial, quality = rows[at]
            audit += plan[at]
            if plan[at] == "D":
                cost += 4
                continue
            cost += 3 * (quality == repair.BROKEN_OFF) + 3 * (plan[at] == "R")
            if plan[at] == "R":
                state = turn()
            elif initial == "s" and state == "" or initial == turn():
                state = initial
            else:
                good = False
                break
        if good and state in ("", "a"):
            found.append((cost, audit))
    return min(found)


def test_search_against_all_audits():
    chance = random.Random(3)
    for _ in range(150):
        rows = [(chance.choice("suax"), chance.choice([0, 0, 1, 2])) for _ in range(chance.randrange(1, 5))]
        cost, audit, _ = repair.ended(repair.search(rows, repair.NOTHING))
        assert (cost, audit) == exhaustive(rows)


def test_hash_collisions_do_not_matter(monkeypatch):
    chance = random.Random(5)
    cases = [[(chance.choice("suax"), chance.choice([0, 0, 1, 2])) for _ in range(60)] for _ in range(30)]
    expected = [repair.search(rows, repair.NOTHING) for rows in cases]
    for prime in (1, 3, 7):
        monkeypatch.setattr(repair.Audits, "PRIME", prime)
        assert [repair.search(rows, repair.NOTHING) for rows in cases] == expected


def test_segments_join_to_the_same_audit():
    chance = random.Random(9)
    for _ in range(60):
        rows = [(chance.choice("suax"), chance.choice([0, 0, 0, 1, 2])) for _ in range(40)]
        cuts = [0, *sorted(chance.sample(range(1, 40), 4)), 40]
        parts = []
        for a, b in zip(cuts, cuts[1:]):
            paths = [{"entry": p, "exit": q, "cost": c, "audit": t} for p in repair.STATES for q, (c, t) in repair.search(rows[a:b], p).items()]
            parts.append({"paths": paths})
        cost, found = repair.joined(parts)
        assert (cost, "".join(audit for _, audit in found)) == repair.ended(repair.search(rows, repair.NOTHING))[:2]


@pytest.mark.parametrize("segment", [1024, 3])
def test_odd_conversations(spark, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    chance = random.Random(11)
    rows = [
        (chance.choice([1, 2, 3, 50, None]), chance.choice([None, *range(9)]), chance.choice(["user", "assistant", "system", "tool", "", None, "usher"]),
         chance.choice([None, "", " \t", "Yes.", "No", "No ", "What?\n", "Süß! 😀", "word " * 5000 + "."]))
        for _ in range(160)
    ]
    rows += [(100 + i, i % 3, "user", "Hello.") for i in range(120)]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, at string").repartition(5)
    assert read(repair.repaired_conversations(frame)) == brute(rows)


def test_empty(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repaired_conversations(frame).count() == 0
