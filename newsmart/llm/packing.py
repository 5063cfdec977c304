"""Best-fit packing with swap-based local search (operator 3).

Pieces of the same length are interchangeable, so the packing is computed on the
histogram of lengths: at most ``capacity`` rows whatever the size of the corpus. Bins
that hold the same lengths are one *class* with a count. A best-fit-decreasing pass
fills the classes, then the local search works on the underfull ones: it moves a piece,
exchanges one for one or two for one whenever that increases the sum of squared fills,
so that the emptiest bins run empty and vanish. A step on a class acts on all its bins
at once. The number of steps would still grow with that of the pieces, so many pieces are
packed level by level: every other one, twice, and the search goes on (``pack_histogram``).

On Spark: tokens are counted where the text is read; the pieces are numbered within
their length from counts per partition (no task sees a whole length); a piece's number
then tells its place through a table of class slots, which is as bounded as the classes.

Cases: a null text is empty and still has its separator, so every row gives one piece
at least; equal rows are packed each; a text over ``capacity`` ids is cut, no other is;
an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.common import map_arrow, store
from newsmart.llm.tokenize import ids_as_bytes

CAPACITY = 2048
#: So many pieces are packed without halving their number first.
FEW = 512
SEPARATOR = (0).to_bytes(4, "little")


class Bins:
    """Classes of equal bins: a sorted tuple of piece lengths and how many bins hold it."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count: dict[tuple[int, ...], int] = defaultdict(int)

    def add(self, pattern: tuple[int, ...], n: int) -> None:
        if n and pattern:
            self.count[pattern] += n
            if not self.count[pattern]:
                del self.count[pattern]

    def bins(self) -> int:
        return sum(self.count.values())


def best_fit_decreasing(sizes: dict[int, int], capacity: int) -> Bins:
    """Each length in turn, longest first, goes where the least room is left over."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # room left -> open classes
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], left: int, n: int) -> None:
        if left not in room or not room[left]:
            if left not in room:
                insort(rooms, left)
        room[left][pattern] = room[left].get(pattern, 0) + n

    for length in sorted(sizes, reverse=True):
        n = sizes[length]
        while n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                pattern, k = next(iter(room[left].items()))
                k = min(k, n)
                room[left][pattern] -= k
                if not room[left][pattern]:
                    del room[left][pattern]
                if not room[left]:
                    del room[left]
                    rooms.pop(at)
                put((*pattern, length), left - length, k)
                n -= k
            else:  # as many equal pieces as fit make new bins
                per = capacity // length
                k, rest = divmod(n, per)
                if k:
                    put((length,) * per, capacity - per * length, k)
                if rest:
                    put((length,) * rest, capacity - rest * length, 1)
                n = 0
    out = Bins(capacity)
    for classes in room.values():
        for pattern, k in classes.items():
            out.add(tuple(sorted(pattern)), k)
    return out


def _take(pattern: tuple[int, ...], out: tuple[int, ...], into: tuple[int, ...]) -> tuple[int, ...]:
    left = list(pattern)
    for x in out:
        left.remove(x)
    return tuple(sorted((*left, *into)))


def _best_step(a: tuple[int, ...], b: tuple[int, ...], capacity: int):
    """The step between a bin ``a`` and a fuller or equal bin ``b`` that raises the sum of
    squared fills most: ``b`` gains ``g``, with ``sum(b) + g <= capacity``."""
    fa, fb = sum(a), sum(b)
    room = capacity - fb
    best, step = 0, None
    ones, twos = sorted(set(a)), []
    for x in ones:
        if x <= room and x > best:  # move
            best, step = x, ((x,), ())
    for x in ones:  # one for one, one for two
        for y in sorted(set(b)):
            if best < x - y <= room:
                best, step = x - y, ((x,), (y,))
        for i, y in enumerate(b):
            for z in b[i + 1 :]:
                if best < x - y - z <= room:
                    best, step = x - y - z, ((x,), (y, z))
    for i, x in enumerate(a):  # two for one
        twos += [(x, z) for z in a[i + 1 :]]
    for x, z in twos:
        for y in set(b):
            if best < x + z - y <= room:
                best, step = x + z - y, ((x, z), (y,))
    gain = 2 * best * (fb - fa + best)
    return (gain, best, *step) if step and gain > 0 else None


class _Partners:
    """The underfull classes by what they can give back and how full they are. Row ``t`` of
    ``fullest[k]`` has, for each fill, the fullest class up to it that holds ``k + 1`` pieces
    of ``t`` tokens together (row 0 of the first: any class). So the best partner for a step
    that gives ``o`` and gets ``t`` is one lookup, ``fullest[k][t, capacity - (o - t)]``. The
    tables have ``capacity`` squared entries, whatever the number of classes."""

    def __init__(self, capacity: int):
        self.capacity, self.none = capacity, -4 * capacity
        shape = (2, capacity + 1, capacity + 1)
        self.fullest = np.full(shape, self.none, np.int32)
        self.holders: dict[tuple[int, int, int], dict[tuple[int, ...], None]] = defaultdict(dict)
        self.down = np.arange(capacity, 0, -1, dtype=np.int64)

    def add(self, pattern: tuple[int, ...]) -> None:
        fill = sum(pattern)
        for k, t in _gives(pattern, True):
            held = self.holders[k, t, fill]
            if not held:
                row = self.fullest[k, t, fill:]
                np.maximum(row, fill, out=row)
            held[pattern] = None

    def remove(self, pattern: tuple[int, ...]) -> None:
        fill = sum(pattern)
        for k, t in _gives(pattern, True):
            held = self.holders[k, t, fill]
            del held[pattern]
            if not held:
                del self.holders[k, t, fill]
                row = self.fullest[k, t]
                row[fill:][row[fill:] == fill] = row[fill - 1]

    def best(self, a: tuple[int, ...]) -> tuple[int, ...] | None:
        """The class with which ``a`` has the step that raises the sum of squared fills most."""
        fa, top, found = sum(a), 0, None
        for kind, o in _gives(a, False):
            for k in (0,) if kind else (0, 1):
                first = 1 if kind or k else 0  # a piece alone may go without another in return
                fills = self.fullest[k].diagonal(self.capacity - o)[first:o]
                if not len(fills):
                    continue
                g = self.down[len(self.down) - o + first :]
                gains = g * (fills + (g - fa))
                at = int(gains.argmax())
                if gains[at] > top:
                    top, found = int(gains[at]), (k, at + first, int(fills[at]))
        return next(iter(self.holders[found])) if found else None


def _gives(pattern: tuple[int, ...], partner: bool) -> set[tuple[int, int]]:
    """``(0, x)`` of single pieces and ``(1, x + y)`` of pairs; ``(0, 0)`` for a partner."""
    ones, pairs = sorted(set(pattern)), set()
    for i, x in enumerate(ones):
        pairs.update((1, x + y) for y in ones[i + 1 :])
        if pattern.count(x) > 1:
            pairs.add((1, 2 * x))
    return pairs | {(0, x) for x in ones} | ({(0, 0)} if partner else set())


class _Stuck:
    """The classes without a step. ``least[k][o]`` is the lowest fill of those that can give
    ``o`` tokens in ``k + 1`` pieces, so a new partner finds those that it wakes by lookup."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.least = np.full((2, capacity + 1), 4 * capacity, np.int64)
        self.by: dict[tuple[int, int], list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
        self.all: set[tuple[int, ...]] = set()

    def add(self, pattern: tuple[int, ...]) -> None:
        self.all.add(pattern)
        for key in _gives(pattern, False):
            insort(self.by[key], (sum(pattern), pattern))
            self.least[key] = self.by[key][0][0]

    def remove(self, pattern: tuple[int, ...]) -> None:
        self.all.discard(pattern)
        for key in _gives(pattern, False):
            held = self.by[key]
            held.pop(bisect_left(held, (sum(pattern), pattern)))
            self.least[key] = held[0][0] if held else 4 * self.capacity

    def woken(self, partner: tuple[int, ...]) -> set[tuple[int, ...]]:
        """Those that have a step with ``partner``."""
        out: set[tuple[int, ...]] = set()
        fill = sum(partner)
        gain = fill + np.arange(1, self.capacity - fill + 1)  # the partner's fill after the step
        for k, t in _gives(partner, True):
            for kind in (0,) if k or not t else (0, 1):
                least = self.least[kind, t + 1 : t + 1 + len(gain)]
                for at in np.flatnonzero(least < gain[: len(least)]).tolist():
                    held = self.by[kind, t + 1 + at]
                    out.update(p for _, p in held[: bisect_left(held, (int(gain[at]),))])
        return out


def local_search(bins: Bins) -> Bins:
    """Improve until no step between any two underfull classes raises the sum of squared
    fills, or until no packing has fewer bins. The emptiest class that is not stuck makes its
    best step over all partners; a class that appears wakes the stuck ones that have a step
    with it. Every step raises a sum of whole numbers that has a bound, so the search ends."""
    capacity = bins.capacity
    partners, stuck = _Partners(capacity), _Stuck(capacity)
    under = {p for p in bins.count if sum(p) < capacity}
    for p in under:
        partners.add(p)
    queue = sorted((sum(p), p) for p in under)
    fewest = -(-sum(sum(p) * n for p, n in bins.count.items()) // capacity)
    now_bins = bins.bins()
    while queue and now_bins > fewest:
        _, a = heappop(queue)
        if a not in under or a in stuck.all:
            continue
        alone = bins.count[a] == 1
        if alone:  # it is no partner of its own
            partners.remove(a)
        b = partners.best(a)
        if alone:
            partners.add(a)
        if b is None:
            stuck.add(a)
            continue
        _, _, out, into = _best_step(a, b, capacity)
        k = bins.count[a] // 2 if a == b else min(bins.count[a], bins.count[b])
        made = (_take(a, out, into), _take(b, into, out))
        now_bins -= 0 if made[0] else k
        was = {p: bins.count.get(p, 0) for p in (a, b, *made)}
        for pattern, n in ((a, -k), (b, -k), (made[0], k), (made[1], k)):
            bins.add(pattern, n)
        for pattern, n in was.items():
            now = bins.count.get(pattern, 0)
            if not pattern or sum(pattern) >= capacity:
                continue
            if n and not now:
                under.discard(pattern)
                partners.remove(pattern)
                if pattern in stuck.all:
                    stuck.remove(pattern)
            elif now and not n:
                under.add(pattern)
                partners.add(pattern)
                for p in stuck.woken(pattern):
                    stuck.remove(p)
                    heappush(queue, (sum(p), p))
            elif n == 1 and now > 1 and pattern in stuck.all:  # now it has itself for a partner
                stuck.remove(pattern)
            if now and pattern not in stuck.all:
                heappush(queue, (sum(pattern), pattern))
    return bins


def halve(sizes: dict[int, int]) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Every other piece, longest first, and where the piece behind it is shorter: ``(length, the
    shorter one's)``, at most one a length; 0 where there is none behind the last."""
    half: dict[int, int] = {}
    shorter, waiting = [], 0
    for length in sorted(sizes, reverse=True):
        n = sizes[length]
        if waiting:
            shorter.append((waiting, length))
            waiting, n = 0, n - 1
        if n:
            half[length] = (n + 1) // 2
            waiting = length if n % 2 else 0
    return half, shorter + ([(waiting, 0)] if waiting else [])


def double(bins: Bins, shorter: list[tuple[int, int]]) -> Bins:
    """Every bin twice; then one piece of each length in ``shorter`` makes way for the shorter one."""
    out = Bins(bins.capacity)
    for pattern, n in bins.count.items():
        out.add(pattern, 2 * n)
    holders: dict[int, set[tuple[int, ...]]] = defaultdict(set)
    for pattern in out.count:
        for x in pattern:
            holders[x].add(pattern)
    for length, other in shorter:
        pattern = min(p for p in holders[length] if p in out.count)
        made = _take(pattern, (length,), (other,) if other else ())
        out.add(pattern, -1)
        out.add(made, 1)
        for x in made:
            holders[x].add(made)
    return out


def pack_histogram(sizes: dict[int, int], capacity: int = CAPACITY, few: int = FEW) -> Bins:
    """Classes of bins that hold exactly the pieces of the histogram, none of which has a step left.

    ``few`` pieces are packed by best fit and the local search. More are halved: every other piece in
    order of length is packed so, every bin is doubled, and the search goes on from there. The
    doubled packing has no step left but by the odd pieces and by classes that were one bin, so a level
    costs few steps, and there are as many levels as the number of pieces has binary digits."""
    if sum(sizes.values()) <= few:
        return local_search(best_fit_decreasing(sizes, capacity))
    half, shorter = halve(sizes)
    return local_search(double(pack_histogram(half, capacity, few), shorter))


def slots(bins: Bins) -> list[tuple[int, int, int, int]]:
    """Rows ``(length, first, sequence, offset)``: the pieces of a length whose number is from
    ``first`` up to the next row's lie in consecutive sequences, at that offset."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, n in sorted(bins.count.items()):
        offset = 0
        for length in pattern:
            rows.append((length, used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return sorted(rows)


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, part, nth)``: the pieces of every row, each
    with its partition and its number among that partition's pieces of the same length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        encode = ids_as_bytes()
        for batch in batches:
            docs_of, rows = [], []
            for i, text in enumerate(batch.column(1)):
                ids = encode(text.as_py()) + SEPARATOR
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    n = len(cut) // 4
                    docs_of.append(i)
                    rows.append((k, at // 4, n, zlib.crc32(cut), part, int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(docs_of, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    kept = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        kept, run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    )


def pack(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = store(pieces(docs, capacity), "pieces")
    per_part = store(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    sizes = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = np.array(slots(pack_histogram(sizes, capacity)), np.int64).reshape(-1, 4)
    so_far = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.sum("n").over(so_far) - F.col("n")
    base = per_part.select("part", "length", before.alias("base"))
    placed = cut.join(base, ["part", "length"]).withColumn("nth", F.col("base") + F.col("nth"))
    shared = spark.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        rows = shared.value
        first = {int(x): int(np.searchsorted(rows[:, 0], x)) for x in np.unique(rows[:, 0])}
        last = {int(x): int(np.searchsorted(rows[:, 0], x, "right")) for x in np.unique(rows[:, 0])}
        for batch in batches:
            length, nth = np.asarray(batch.column(3)), np.asarray(batch.column(5))
            sequence, offset = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            for x in np.unique(length).tolist():
                own = np.flatnonzero(length == x)
                at = first[x] + np.searchsorted(rows[first[x] : last[x], 1], nth[own], "right") - 1
                sequence[own] = rows[at, 2] + nth[own] - rows[at, 1]
                offset[own] = rows[at, 3]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = cut.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        placed.select("doc_id", "piece", "start", "length", "ids_crc32", "nth"),
        place,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )

