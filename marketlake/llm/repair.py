"""Repairing the structure of conversations at least cost, with an audit of the edits.

A conversation is well formed when its roles' initials read `(s?(ua)+)?`. Rows are kept,
deleted or given the role that fits, empty turns are inserted; a blank or repeated row has to
be deleted, and a row that breaks off costs more unless it is deleted. The audit is the initials
of the edits in order: Delete, Insert, Keep, Rerole. Of the cheapest audits the least one counts.
An audit tells the roles of what is inserted and reroled, since users and assistants take turns.

The search runs over four states: nothing yet, after a system turn, after a user, after an
assistant. For each it holds the best audit so far as a node that points at its prefix, so
prefixes are shared. Nodes know their ancestors at powers of two and a rolling hash of their
audit; audits of one cost are compared at the end of their longest common prefix, which is
found by the ancestors' hashes, and the prefixes are then compared letter by letter.

Rows are put in order by range partitions and numbered, so a conversation may lie in many
tasks. A task searches segments of at most `SEGMENT_ROWS` rows, from every state that the segment
may be entered in; what it gives back is one audit per pair of states. Segments of one conversation
are then joined in order. Texts are read once more, in order, to hash the repaired lines; that
hash is a single one and has to be taken in order, but holds no more than a batch.

Nulls: a null text or role is one space (a text of one space is blank, such a role fits nowhere);
a null conversation is one of its own; null turns come first. Rows with the same turn go by role
and text before damage; equal rows are rows of their own, and all but the first are duplicates.
Conversations without rows have zeros, an empty audit and the hash of the empty text. Empty tables
give empty results; extra columns are left out; texts may be as long as a row can hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST = 3
DELETE_COST = 4
INSERT_COST = 3
TRUNCATED_COST = 3
SEGMENT_ROWS = 1024

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# The state after a further turn that is not a system turn.
TURNED = (USER, USER, ASSISTANT, USER)
ROLE_OF_STATE = {USER: "user", ASSISTANT: "assistant"}
# Insertions that make a conversation well formed which ends in a state.
MISSING = (0, 2, 1, 0)
# What a row is, as searched: must it go, and what does it cost not to delete it.
SOUND, BROKEN_OFF, UNUSABLE = range(3)

NOT_BLANK = r"[^\x20\x09-\x0D]"
LAWFUL = ("su", "ua", "au")

PATH = "entry int, exit int, cost long, audit string"
SEGMENT = f"conv_id long, at long, whole boolean, illegal long, first string, last string, paths array<struct<{PATH.replace(' ', ':').replace(',:', ',')}>>"
CHOSEN = "conv_id long, at long, entry int, audit string, cost long, illegal long"


# Damage ------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversations after damage by the hash of id and turn, with
    `tie` and `copy`, which order rows of one turn."""
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.col("_kind")
    hit = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("_kind"),
    ).filter(kind != 0)
    return hit.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("tie"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


# Audits as linked nodes --------------------------------------------------------------------


class Audits:
    """Audits of one segment; node 0 is the empty one."""

    BASE, PRIME = 0x9E3779B97F4A7C1, (1 << 61) - 1

    def __init__(self):
        self.letters, self.depths, self.hashes = [""], [0], [0]
        # Ancestors 1, 2, 4, ... letters up.
        self.ancestors: list[tuple[int, ...]] = [()]

    def longer(self, node: int, letter: str) -> int:
        above, up, k = node, [node], 0
        while k < len(self.ancestors[above]):
            above = self.ancestors[above][k]
            up.append(above)
            k += 1
        self.letters.append(letter)
        self.depths.append(self.depths[node] + 1)
        self.hashes.append((self.hashes[node] * self.BASE + ord(letter)) % self.PRIME)
        self.ancestors.append(tuple(up))
        return len(self.letters) - 1

    def text(self, node: int) -> str:
        found = []
        while node:
            found.append(self.letters[node])
            node = self.ancestors[node][0]
        return "".join(reversed(found))

    def lifted(self, node: int, depth: int) -> int:
        over = self.depths[node] - depth
        while over:
            k = over.bit_length() - 1
            node = self.ancestors[node][k]
            over -= 1 << k
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal, letter by letter up to a shared node."""
        while a != b:
            if self.letters[a] != self.letters[b]:
                return False
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether audit a comes before audit b."""
        depth = min(self.depths[a], self.depths[b])
        x, y = self.lifted(a, depth), self.lifted(b, depth)
        if self.hashes[x] == self.hashes[y]:
            if self.same(x, y):
                return self.depths[a] < self.depths[b]
            return self.text(a) < self.text(b)
        for k in reversed(range(len(self.ancestors[x]))):
            if k < len(self.ancestors[x]):
                up, across = self.ancestors[x][k], self.ancestors[y][k]
                if self.hashes[up] != self.hashes[across]:
                    x, y = up, across
        if not self.same(self.ancestors[x][0], self.ancestors[y][0]):
            return self.text(a) < self.text(b)
        return self.letters[x] < self.letters[y]


class Best(NamedTuple):
    cost: int
    node: int


def _offer(audits: Audits, best: dict[int, Best], state: int, cost: int, node: int, letter: str) -> bool:
    """Take an audit and a further letter as the state's best if it is."""
    held = best.get(state)
    if held is not None and held.cost < cost:
        return False
    offered = audits.longer(node, letter)
    if held is None or cost < held.cost or audits.less(offered, held.node):
        best[state] = Best(cost, offered)
        return True
    return False


def search(rows: list[tuple[str, int]], entry: int) -> dict[int, tuple[int, str]]:
    """Cheapest cost and least audit of rows (initial, what it is) for each state they can end in.

    Of two audits for the same rows with one cost neither is the beginning of the other: the
    longer one would have insertions more, and cost more. So what is less stays so whatever
    follows, and one audit per state is enough.
    """
    audits = Audits()
    best = {entry: Best(0, 0)}
    for initial, quality in rows:
        changed = True
        while changed:
            changed = False
            for state in STATES:
                if state in best:
                    cost, node = best[state]
                    changed |= _offer(audits, best, TURNED[state], cost + INSERT_COST, node, INSERT)
        after: dict[int, Best] = {}
        extra = TRUNCATED_COST if quality == BROKEN_OFF else 0
        for state, (cost, node) in best.items():
            _offer(audits, after, state, cost + DELETE_COST, node, DELETE)
            if quality == UNUSABLE:
                continue
            _offer(audits, after, TURNED[state], cost + REROLE_COST + extra, node, REROLE)
            if initial == "s" and state == NOTHING:
                _offer(audits, after, SYSTEM, cost + extra, node, KEEP)
            elif (initial == "u" and state != USER) or (initial == "a" and state == USER):
                _offer(audits, after, TURNED[state], cost + extra, node, KEEP)
        best = after
    return {state: (cost, audits.text(node)) for state, (cost, node) in best.items()}


def ended(paths: dict[int, tuple[int, str]]) -> tuple[int, str, int]:
    """The best way to end: cost, audit with what is still inserted, and state."""
    return min((cost + INSERT_COST * MISSING[s], audit + INSERT * MISSING[s], s) for s, (cost, audit) in paths.items())


# Segments ----------------------------------------------------------------------------------


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """All rows in order of conversation and turn, with their number `at`, as a written table."""
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(ranged.withColumn("at", F.monotonically_increasing_id()), "turns")


def _judged(rows: DataFrame) -> DataFrame:
    """at, conv_id, turn, initial and the first fault of every row."""
    last = F.regexp_extract("text", rf"(?s)({NOT_BLANK})[\x20\x09-\x0D]*\z", 1)
    facts = rows.select(
        "at", "conv_id", "turn", "role", F.substring("role", 1, 1).alias("initial"), F.sha2("text", 256).alias("digest"),
        F.col("text").rlike(NOT_BLANK).alias("spoken"), last.rlike("[.!?]").alias("complete"),
    )
    key = [F.col("facts." + c).eqNullSafe(F.col("firsts." + c)) for c in ("conv_id", "role", "digest")]
    firsts = facts.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("first"))
    met = facts.alias("facts").join(firsts.alias("firsts"), key)
    fault = F.when(~F.col("spoken"), "blank").when(F.col("at") > F.col("first"), "duplicate").when(~F.col("complete"), "truncated")
    return materialize(met.select("at", "facts.conv_id", "turn", "initial", fault.alias("fault")), "judged-turns")


def _segments(facts: DataFrame) -> DataFrame:
    """One row per segment with its searched paths. `whole` says that it is a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int]] = []
        conv = start = before = None
        # Whether the held rows are the first of their conversation.
        opening = False

        def segment(closing: bool) -> dict:
            whole = opening and closing
            entries = [NOTHING] if opening else STATES
            paths = [
                {"entry": p, "exit": q, "cost": cost, "audit": audit}
                for p in entries for q, (cost, audit) in search(held, p).items()
            ]
            initials = [initial for initial, _ in held]
            illegal = sum(a + b not in LAWFUL for a, b in zip(initials, initials[1:]))
            return {"conv_id": conv, "at": start, "whole": whole, "illegal": illegal, "first": initials[0], "last": initials[-1], "paths": paths}

        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in ("at", "conv_id", "initial", "fault")]
            for at, of, initial, fault in zip(*columns):
                follows = before is not None and at == before + 1
                if held and (of != conv or not follows or len(held) >= SEGMENT_ROWS):
                    found.append(segment(follows and of != conv))
                    opening = follows and of != conv
                    held = []
                elif not held:
                    opening = False
                if not held:
                    conv, start = of, at
                held.append((initial, {None: SOUND, "truncated": BROKEN_OFF}.get(fault, UNUSABLE)))
                before = at
            if found:
                yield _arrow(found)
        if held:
            yield _arrow([segment(False)])

    ordered = facts.select("at", "conv_id", "initial", "fault").repartitionByRange("at").sortWithinPartitions("at")
    return materialize(ordered.mapInArrow(run, SEGMENT), "segments")


_PATH_ARROW = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_SEGMENT_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()), ("illegal", pa.int64()), ("first", pa.string()),
    ("last", pa.string()), ("paths", pa.list_(_PATH_ARROW)),
])


def _arrow(segments: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(segments, schema=_SEGMENT_ARROW)


class Chain(NamedTuple):
    """Best audit up to a segment, as the segment's part and what leads to it."""

    cost: int
    before: Chain | None
    entry: int
    audit: str

    def since(self, other: Chain) -> tuple[str, str]:
        """What both chains, of as many segments, have behind their last common one."""
        a, b, mine, theirs = self, other, [], []
        while a is not b:
            mine.append(a.audit)
            theirs.append(b.audit)
            a, b = a.before, b.before
        return "".join(reversed(mine)), "".join(reversed(theirs))


def joined(segments: list[dict]) -> tuple[int, list[tuple[int, str]]]:
    """Cost of a conversation, and the entry state and audit of each of its segments in order."""
    best: dict[int, Chain] = {NOTHING: Chain(0, None, NOTHING, "")}

    def offer(after: dict[int, Chain], state: int, chain: Chain) -> None:
        held = after.get(state)
        if held is None or chain.cost < held.cost:
            after[state] = chain
        elif chain.cost == held.cost:
            new, old = chain.since(held)
            if new < old:
                after[state] = chain

    for segment in segments:
        after: dict[int, Chain] = {}
        for path in segment["paths"]:
            held = best.get(path["entry"])
            if held is not None:
                offer(after, path["exit"], Chain(held.cost + path["cost"], held, path["entry"], path["audit"]))
        best = after
    final: dict[int, Chain] = {}
    for state, chain in best.items():
        more = MISSING[state]
        offer(final, NOTHING, chain._replace(cost=chain.cost + INSERT_COST * more, audit=chain.audit + INSERT * more))
    chain, parts = final[NOTHING], []
    cost = chain.cost
    while chain.before is not None:
        parts.append((chain.entry, chain.audit))
        chain = chain.before
    return cost, parts[::-1]


def _chosen(segments: DataFrame) -> DataFrame:
    """Entry state and audit of every segment. `cost` and `illegal` stand in the first of each
    conversation."""
    ends = F.filter("paths", lambda p: p["entry"] == NOTHING)
    more = F.array(*map(F.lit, MISSING))

    def end(path: Column) -> Column:
        missing = F.element_at(more, path["exit"] + 1)
        return F.struct(
            (path["cost"] + INSERT_COST * missing).alias("cost"),
            F.concat(path["audit"], F.repeat(F.lit(INSERT), missing)).alias("audit"),
        )

    alone = segments.filter("whole").withColumn("best", F.array_min(F.transform(ends, end)))
    alone = alone.select("conv_id", "at", F.lit(NOTHING).alias("entry"), "best.audit", "best.cost", "illegal")

    def join(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("at").to_dict("records")
        cost, parts = joined(rows)
        seams = sum(a["last"] + b["first"] not in LAWFUL for a, b in zip(rows, rows[1:]))
        illegal = sum(r["illegal"] for r in rows) + seams
        return pd.DataFrame([
            (None if pd.isna(r["conv_id"]) else r["conv_id"], r["at"], entry, audit, 0 if i else cost, 0 if i else illegal)
            for i, (r, (entry, audit)) in enumerate(zip(rows, parts))
        ], columns=[c.split(" ")[0] for c in CHOSEN.split(", ")]).astype({"conv_id": "Int64"})

    parted = segments.filter("not whole").groupBy("conv_id").applyInPandas(join, CHOSEN)
    return materialize(alone.unionByName(parted), "chosen-edits")


# Repaired lines ----------------------------------------------------------------------------


class Writer:
    """Lines of one conversation, as its rows and audits come in."""

    def __init__(self):
        self.state, self.edits, self.lines, self.digest = NOTHING, iter(""), 0, hashlib.sha256()

    def line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def turn(self, text: str = "") -> None:
        self.state = TURNED[self.state]
        self.line(ROLE_OF_STATE[self.state], text)

    def audit(self, edits: str) -> None:
        self.rest()
        self.edits = iter(edits)

    def rest(self) -> None:
        for _ in self.edits:
            self.turn()

    def row(self, role: str, text: str) -> None:
        for edit in self.edits:
            if edit == INSERT:
                self.turn()
                continue
            if edit == REROLE:
                self.turn(text)
            elif edit == KEEP:
                self.state = SYSTEM if role[:1] == "s" else TURNED[self.state]
                self.line(role, text)
            return


def _hashes(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256; audits come right before the first row of their segment."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, conv = None, None

        def out(done: list[tuple]) -> pa.RecordBatch:
            ids, hashes = zip(*done)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])

        for batch in batches:
            done = []
            for of, audit, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]):
                if writer is None or of != conv:
                    if writer is not None:
                        writer.rest()
                        done.append((conv, writer.digest.hexdigest()))
                    writer, conv = Writer(), of
                if audit is not None:
                    writer.audit(audit)
                else:
                    writer.row(role, text)
            if done:
                yield out(done)
        if writer is not None:
            writer.rest()
            yield out([(conv, writer.digest.hexdigest())])

    lines = rows.select("conv_id", "at", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "role", "text")
    edits = chosen.select("conv_id", "at", F.lit(0).alias("kind"), "audit", *[F.lit(None).cast("string").alias(c) for c in ("role", "text")])
    both = lines.unionByName(edits).repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    return both.mapInArrow(write, "conv_id long, repaired_sha256 string")


# Conversations -----------------------------------------------------------------------------


def repaired(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text, and what orders rows of one
    turn): faults, cost, audit and hash of the repaired lines."""
    numbered = _numbered(rows, order)
    facts = _judged(numbered)
    chosen = _chosen(_segments(facts))
    turns = facts.groupBy("conv_id", "turn").agg(*[
        F.count(F.when(F.col("fault") == fault, 1)).alias(fault) for fault in ("blank", "duplicate", "truncated")
    ])
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    counts = turns.groupBy("conv_id").agg(gaps, *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    parts = F.sort_array(F.collect_list(F.struct("at", "audit")))
    audits = chosen.groupBy("conv_id").agg(
        F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit"),
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
    )
    found = [counts, audits, _hashes(numbered, chosen)]
    columns = [c for part in found for c in part.columns if c != "conv_id"]
    both = found[0]
    for part in found[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in columns])


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """Every conversation after damage and repair, those that lost all rows included."""
    found = repaired(damaged(rows), ["tie", "copy", "role", "text"])
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    every = ids.unionByName(found, allowMissingColumns=True)
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
