"""Removing passages that occur twice, by a sparse suffix array sorted in runs and merged.

A byte goes when a string of `LENGTH` bytes that covers it also starts anywhere else. All windows
of `LENGTH` bytes are judged, each by its anchor: the place in its first half with the smallest
hash of `GRAM` bytes, the first of equal ones. Equal windows have their anchors at the same
offset, and every window holds `LENGTH - reach` bytes from its anchor on, the core.

1. Texts are dealt to runs of about `RUN_BYTES`, which are kept compressed. Every run sends the hashes of its anchors' cores
   once each, sorted, and hears which of them other runs have, or hold twice itself. That leaves
   anchors whose suffixes may share a window; a wrong positive costs work only.
2. For those the run sorts the suffixes that start at the anchors, cut to what the anchor's
   windows reach, and sends them front-coded: the length shared with the suffix before, and
   the rest. Equal suffixes with equal left contexts are sent once, with their places.
3. A bucket of cores merges its sorted runs with a loser tree. Every waiting suffix knows how much
   it shares with the one put out last, so a comparison starts behind what is known to be equal,
   and the merged sequence comes with the common prefix lengths of neighbours. They say which
   suffixes agree on any number of bytes; the left contexts are ranked likewise, and a window of
   offset o occurs twice when two places agree on o bytes to the left and `LENGTH` - o to the right.
   This is exact; hashes decide nothing here.
4. Each anchor's repeated windows overlap, so they cover one stretch. Stretches go back to their
   runs, where texts are cut.

A run or bucket holds a bounded number of bytes (or one longer text, whose suffixes go in several
sorted runs): buckets follow the bytes of the texts, and a core that very many places share comes
once per run and distinct context. Null texts are empty. Repeated rows are texts of their own, and
repeat each other. Texts below `LENGTH` bytes stay. Empty tables give empty results; extra columns
are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import materialize

LENGTH = 200
GRAM = 8
RUN_BYTES = 4 << 20
# Bytes of text whose anchors are found together; bytes of text per bucket.
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 32 << 20
# Suffixes of a run that are sorted and sent together.
SORTED_SUFFIXES = 20_000

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
# Type of lengths of suffixes.
SIZE = np.uint16
_NONE = np.zeros(0, np.int64)


# Anchors -----------------------------------------------------------------------------------


def reach(length: int) -> int:
    """How far behind a window's start its anchor may be."""
    return length // 2 - GRAM


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the `GRAM` bytes from each place on."""
    words = np.ndarray(len(codes) - GRAM + 1, "<u8", codes, strides=(1,)).copy()
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(32)
    words *= np.uint64(0xD6E8FEB86659FD93)
    return words


def _block_anchors(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes = gram_hashes(codes)
    windows = len(codes) - length + 1
    # Hash above, place below: the smallest is the first of the smallest hashes.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width, span = reach(length) + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    chosen = (least[:windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
    last = np.concatenate([first[1:], [windows]]) - 1
    anchors = chosen[first]
    core = length - reach(length)
    cores = np.zeros(len(anchors), np.uint64)
    for at in [*range(0, core - GRAM, GRAM), core - GRAM]:
        cores = (cores ^ hashes[anchors + at]) * np.uint64(0x9FB21C651E98DF25)
        cores ^= cores >> np.uint64(29)
    return anchors, first, last, cores


def anchors_of(codes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text, first and last start of the windows of each, and hashes of their cores.

    The text is read in blocks; an anchor whose windows lie in two blocks comes twice.
    """
    found = []
    for start in range(0, len(codes) - length + 1, BLOCK_BYTES):
        block = codes[start : start + BLOCK_BYTES + length - 1]
        anchors, first, last, cores = _block_anchors(block, length)
        found.append((anchors + start, first + start, last + start, cores))
    if not found:
        return _NONE, _NONE, _NONE, np.zeros(0, np.uint64)
    return tuple(np.concatenate(parts) for parts in zip(*found))


# Sorted runs -------------------------------------------------------------------------------


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings that agree on `known` bytes."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    differ = int.from_bytes(a[known:n], "little") ^ int.from_bytes(b[known:n], "little")
    return known + ((differ & -differ).bit_length() - 1) // 8


def front_coded(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Sorted strings as lengths shared with the one before, lengths of the rest, and the rests."""
    common = np.zeros(len(suffixes), SIZE)
    rests = []
    before = b""
    for i, suffix in enumerate(suffixes):
        common[i] = n = shared(before, suffix)
        rests.append(suffix[n:])
        before = suffix
    sizes = np.fromiter(map(len, rests), SIZE, len(rests))
    return common, sizes, b"".join(rests)


def decoded(common: np.ndarray, sizes: np.ndarray, rests: bytes) -> Iterator[tuple[int, bytes]]:
    """Each string with the length it shares with the one before."""
    at, before = 0, b""
    for n, size in zip(common.tolist(), sizes.tolist()):
        before = before[:n] + rests[at : at + size]
        at += size
        yield n, before


def merged(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """Strings of sorted runs in order: common prefix length with the one before, run, string.

    A loser tree. Every run's next string is kept with the length it shares with the string put
    out last: of two strings the one that shares more is smaller; when both share the same, they
    are compared from there on, and the loser then knows what it shares with the winner.
    """
    players = len(runs)
    if players == 0:
        return
    strings: list[bytes | None] = [None] * players
    common = [0] * players
    for run, source in enumerate(runs):
        step = next(source, None)
        strings[run] = None if step is None else step[1]

    def beats(a: int, b: int) -> bool:
        """Whether run a's string comes before run b's. The loser learns what it shares."""
        x, y = strings[a], strings[b]
        if y is None:
            return True
        if x is None:
            return False
        if common[a] != common[b]:
            return common[a] > common[b]
        n = shared(x, y, common[a])
        wins = x[n:] < y[n:] if x[n : n + 1] != y[n : n + 1] else a < b
        common[b if wins else a] = n
        return wins

    losers = [-1] * players

    def play(node: int) -> int:
        """The winner below a node; leaves are the runs."""
        if node >= players:
            return node - players
        a, b = play(2 * node), play(2 * node + 1)
        winner, losers[node] = (a, b) if beats(a, b) else (b, a)
        return winner

    winner = play(1) if players > 1 else 0
    while strings[winner] is not None:
        yield common[winner], winner, strings[winner]
        step = next(runs[winner], None)
        common[winner], strings[winner] = (0, None) if step is None else step
        node = (winner + players) // 2
        while node:
            if not beats(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node //= 2


# Repeated windows --------------------------------------------------------------------------


def _ranked(lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Left contexts, read from the anchor outwards, in order; lengths shared with the one before."""
    turned = [left[::-1] for left in lefts]
    order = sorted(range(len(turned)), key=turned.__getitem__)
    common = [0] * len(order)
    for i in range(1, len(order)):
        common[i] = shared(turned[order[i - 1]], turned[order[i]])
    return np.array(order, np.int64), np.array(common, np.int64)


def repeated_offsets(
    right_common: np.ndarray, lefts: list[bytes], nearest: np.ndarray, furthest: np.ndarray, places: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest offset of a repeated window of every suffix, -1 where there is none.

    Suffixes are in order, `right_common` being what each shares with the one before. A suffix's
    windows start from `nearest` to `furthest` bytes before it; it occurs at so many `places`.
    """
    count = len(lefts)
    low, high = np.full(count, -1), np.full(count, -1)
    order, left_common = _ranked(lefts)
    left_class = np.empty(count, np.int64)
    for offset in range(int(nearest.min(initial=0)), int(furthest.max(initial=-1)) + 1):
        there = np.flatnonzero((nearest <= offset) & (offset <= furthest))
        if not len(there):
            continue
        right_class = np.cumsum(right_common < length - offset)
        left_class[order] = np.cumsum(left_common < offset)
        keys = right_class[there] * (count + 1) + left_class[there]
        turn = np.argsort(keys, kind="stable")
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys[turn])) + 1])
        sums = np.add.reduceat(places[there][turn], starts)
        sizes = np.diff(np.concatenate([starts, [len(turn)]]))
        twice = there[turn[np.repeat(sums > 1, sizes)]]
        low[twice] = np.where(low[twice] < 0, offset, low[twice])
        high[twice] = offset
    return low, high


# Spark ------------------------------------------------------------------------------------


_RUNS = "run long, doc_ids array<long>, sizes array<int>, data binary"


def texts_in_runs(docs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """All texts, a run a row: ids, sizes, and the compressed bytes of its texts one after the
    other. Runs end at a bound of bytes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, size = TaskContext.get().partitionId() << 32, 0
        ids: list[int | None] = []
        parts: list[bytes] = []

        def row() -> pa.RecordBatch:
            data = pa.compress(b"".join(parts), codec="zstd", asbytes=True)
            columns = [[run], [ids], [[len(p) for p in parts]], [data]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["run", "doc_ids", "sizes", "data"])

        for batch in batches:
            for doc_id, part in zip(batch.column("doc_id").to_pylist(), batch.column("data").to_pylist()):
                if parts and size + len(part) > run_bytes:
                    yield row()
                    run, size, ids, parts = run + 1, 0, [], []
                ids.append(doc_id)
                parts.append(part)
                size += len(part)
        if parts:
            yield row()

    data = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), data)
    return materialize(chosen.mapInArrow(deal, _RUNS), "texts")


def _unpacked(sizes: list[int], data: bytes) -> list[np.ndarray]:
    """The bytes of each text of a run."""
    ends = np.cumsum([0, *sizes])
    whole = np.frombuffer(pa.decompress(data, int(ends[-1]), codec="zstd"), np.uint8) if ends[-1] else np.zeros(0, np.uint8)
    return [whole[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def _run_anchors(sizes: list[int], data: bytes, length: int) -> Iterator[tuple[int, np.ndarray, tuple]]:
    """Number, bytes and anchors of every text of a run that has a window."""
    for row, codes in enumerate(_unpacked(sizes, data)):
        if len(codes) >= length:
            yield row, codes, anchors_of(codes, length)


def _by_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys % np.uint64(buckets)).astype(np.int64)


_CORES = "run long, bucket long, cores binary, twice binary"


def _cores(texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """Per run and bucket, the hashes of the run's cores in order, and whether it has them twice.
    Texts are read in place."""

    def sent(run: int, parts: list[np.ndarray]) -> pa.RecordBatch:
        cores, counts = np.unique(np.concatenate(parts), return_counts=True)
        bucket = _by_bucket(cores, buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        rows = [
            (run, int(bucket[part[0]]), cores[part].tobytes(), (counts[part] > 1).tobytes())
            for part in np.split(order, cuts) if len(part)
        ]
        columns = list(zip(*rows)) if rows else [()] * 4
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["run", "bucket", "cores", "twice"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, sizes, data in zip(*[batch.column(c) for c in ("run", "sizes", "data")]):
                parts = [found[3] for _, _, found in _run_anchors(sizes.as_py(), data.as_py(), length)]
                if parts:
                    yield sent(run.as_py(), parts)

    return texts.select("run", "sizes", "data").mapInArrow(send, _CORES)


def _repeated_cores(cores: DataFrame) -> DataFrame:
    """Per run, the hashes of its cores that occur twice or more anywhere."""

    def meet(table: pa.Table) -> pa.Table:
        runs = table.column("run").to_pylist()
        each = [np.frombuffer(x, np.uint64) for x in table.column("cores").to_pylist()]
        twice = np.concatenate([np.frombuffer(x, bool) for x in table.column("twice").to_pylist()])
        values, place, counts = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        more = counts > 1
        more[place[twice]] = True
        ends = np.cumsum([len(x) for x in each])
        known = more[place]
        found = [(run, x[known[end - len(x) : end]].tobytes()) for run, x, end in zip(runs, each, ends)]
        found = [(run, x) for run, x in found if x]
        columns = list(zip(*found)) if found else [(), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary())], names=["run", "repeated"])

    return cores.groupBy("bucket").applyInArrow(meet, "run long, repeated binary")


_SUFFIXES = "bucket long, run long, common binary, sizes binary, rests binary, lefts binary, facts binary, rows binary, ends binary"
_SUFFIX_COLUMNS = [c.split(" ")[0] for c in _SUFFIXES.split(", ")]


def _small(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _whole(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, codec="zstd", asbytes=True) if size else b""


def _packed_suffixes(bucket: int, run: int, suffixes: dict[tuple[bytes, bytes], list[tuple[int, int]]], length: int) -> tuple:
    """A sorted run of one bucket: front-coded suffixes, left contexts, numbers of places, places."""
    order = sorted(suffixes)
    common, sizes, rests = front_coded([right for right, _ in order])
    places = [suffixes[key] for key in order]
    facts = np.array([(len(right), len(left), len(p)) for (right, left), p in zip(order, places)], np.int32)
    flat = np.array([x for p in places for x in p], np.int64).reshape(-1, 2)
    return (
        bucket, run, common.tobytes(), sizes.tobytes(), _small(rests), _small(b"".join(left for _, left in order)),
        facts.tobytes(), flat[:, 0].astype(np.int32).tobytes(), flat[:, 1].astype(np.int64).tobytes(),
    )


def _suffixes(texts: DataFrame, repeated: DataFrame, buckets: int, length: int) -> DataFrame:
    """Per run and bucket, sorted runs of the suffixes at anchors whose core occurs twice."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in right.column("repeated").to_pylist()]
        rows: list[tuple] = []
        if left.num_rows and parts:
            wanted = np.sort(np.concatenate(parts))
            run = left.column("run")[0].as_py()
            held: dict[int, dict] = {}
            size = 0
            texts_of = (left.column(c)[0].as_py() for c in ("sizes", "data"))
            for row, codes, (anchors, first, last, cores) in _run_anchors(*texts_of, length):
                at = np.minimum(np.searchsorted(wanted, cores), len(wanted) - 1)
                hit = wanted[at] == cores
                buffer = codes.tobytes()
                chosen = zip(anchors[hit].tolist(), first[hit].tolist(), last[hit].tolist(), _by_bucket(cores[hit], buckets).tolist())
                for anchor, start, end, bucket in chosen:
                    key = (buffer[anchor : end + length], buffer[start:anchor])
                    held.setdefault(bucket, {}).setdefault(key, []).append((row, anchor))
                    size += 1
                    if size == SORTED_SUFFIXES:
                        rows += [_packed_suffixes(b, run, found, length) for b, found in held.items()]
                        held, size = {}, 0
            rows += [_packed_suffixes(b, run, found, length) for b, found in held.items()]
        columns = list(zip(*rows)) if rows else [()] * len(_SUFFIX_COLUMNS)
        types = [pa.int64(), pa.int64()] + [pa.binary()] * 7
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=_SUFFIX_COLUMNS)

    texts = texts.select("run", "sizes", "data")
    return texts.groupBy("run").cogroup(repeated.groupBy("run")).applyInArrow(send, _SUFFIXES)


def _covered(suffixes: DataFrame, length: int) -> DataFrame:
    """Per run, rows and the stretches that repeated windows cover there."""
    def merge(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in _SUFFIX_COLUMNS}
        numbers = {c: [np.frombuffer(x, t) for x in columns[c]] for c, t in (("common", SIZE), ("sizes", SIZE), ("rows", np.int32), ("ends", np.int64))}
        facts = [np.frombuffer(x, np.int32).reshape(-1, 3) for x in columns["facts"]]
        lefts = [iter(_cut(_whole(x, int(f[:, 1].sum())), f[:, 1])) for x, f in zip(columns["lefts"], facts)]
        sources = [
            decoded(common, sizes, _whole(rests, int(sizes.sum(dtype=np.int64))))
            for common, sizes, rests in zip(numbers["common"], numbers["sizes"], columns["rests"])
        ]
        common, which, contexts = [], [], []
        for n, run, _ in merged(sources):
            common.append(n)
            which.append(run)
            contexts.append(next(lefts[run]))
        common, which = np.array(common, np.int64), np.array(which, np.int64)
        # Suffixes of a run come in their order: the merged order is a stable one of the runs.
        firsts = np.cumsum([0, *[len(f) for f in facts]])
        back = np.empty(len(which), np.int64)
        back[np.argsort(which, kind="stable")] = np.arange(len(which))
        flat = np.concatenate(facts)[back]
        low, high = repeated_offsets(common, contexts, length - flat[:, 0], flat[:, 1].copy(), flat[:, 2].copy(), length)
        lows, highs = np.empty_like(low), np.empty_like(high)
        lows[back], highs[back] = low, high
        found = []
        for i, run in enumerate(columns["run"]):
            at = slice(firsts[i], firsts[i + 1])
            each = np.repeat(np.arange(len(facts[i])), facts[i][:, 2])
            begin, end = numbers["ends"][i] - highs[at][each], numbers["ends"][i] - lows[at][each] + length
            hit = lows[at][each] >= 0
            if hit.any():
                found.append((run, numbers["rows"][i][hit].tobytes(), begin[hit].tobytes(), end[hit].tobytes()))
        out = list(zip(*found)) if found else [()] * 4
        return pa.table([pa.array(out[0], pa.int64()), *[pa.array(c, pa.binary()) for c in out[1:]]], names=["run", "rows", "begins", "ends"])

    return suffixes.groupBy("bucket").applyInArrow(merge, "run long, rows binary, begins binary, ends binary")


def _cut(data: bytes, sizes: np.ndarray) -> Iterator[bytes]:
    at = 0
    for size in sizes.tolist():
        yield data[at : at + size]
        at += size


def united(begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that overlap or touch, as one."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > ends[:-1]])
    starts = np.flatnonzero(new)
    return list(zip(begins[starts].tolist(), ends[np.concatenate([starts[1:], [len(ends)]]) - 1].tolist()))


def _results(texts: DataFrame, covered: DataFrame) -> DataFrame:
    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            ids, sizes, packed = (left.column(c)[0].as_py() for c in ("doc_ids", "sizes", "data"))
            rows, begins, ends = (
                np.concatenate([np.frombuffer(x, t) for x in right.column(c).to_pylist()] or [_NONE])
                for c, t in (("rows", np.int32), ("begins", np.int64), ("ends", np.int64))
            )
            order = np.argsort(rows, kind="stable")
            rows, begins, ends = rows[order], begins[order], ends[order]
            bounds = np.searchsorted(rows, np.arange(len(ids) + 1))
            for row, (doc_id, codes) in enumerate(zip(ids, _unpacked(sizes, packed))):
                data = memoryview(codes)
                mine = slice(bounds[row], bounds[row + 1])
                spans = united(begins[mine], ends[mine]) if bounds[row] < bounds[row + 1] else []
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out.append((doc_id, len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest()))
        columns = list(zip(*out)) if out else [()] * 5
        types = [pa.int64()] * 4 + [pa.string()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return texts.groupBy("run").cogroup(covered.groupBy("run")).applyInArrow(cut, RESULT)


def without_repeats(docs: DataFrame, length: int = LENGTH, run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: bytes, bytes and maximal stretches removed, and the hash of what stays."""
    texts = texts_in_runs(docs, run_bytes)
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, n: total + n)
    size = texts.agg(F.sum(sizes)).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    repeated = materialize(_repeated_cores(_cores(texts, buckets, length)), "repeated-cores")
    covered = materialize(_covered(_suffixes(texts, repeated, buckets, length), length), "covered")
    return _results(texts, covered)
