"""Benchmark decontamination with training suffix arrays (operator 6).

Each run of some MB of documents that a task reads is one shard. Its words become numbers, documents
separated by a zero, and the suffixes of that sequence are sorted: the shard's suffix
array. Every suffix of every benchmark item is then binary-searched in it. The two
neighbours of its place give its longest verbatim match; the range of suffixes that begin
with its first ``window`` words gives every occurrence, and so the words that are hit.

The array is kept sparse without losing a match: a suffix is left out when no benchmark
window begins with its first two words (its first, for a window of one word). Sorting
looks ``DEPTH`` words deep; a longer match is followed word by word from there.

No text is shuffled. The benchmark is sent to the tasks in blocks of at most
``block_chars`` characters, a stated bound, each block a pass of its own within the same
stage, so a benchmark of any size works.

Cases: null, empty and wordless texts have no words and no hits; an item without words is
never found, a null item_id counts as the empty string; equal rows count each, rows of one
item_id are one item; an empty benchmark leaves every document clean."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.common import slices

WINDOW = 10
#: Words that the sort of suffixes compares; a power of two keeps the keys aligned.
DEPTH = 16
BLOCK_CHARS = 16_000_000

#: Bytes of words: a-z after lowering, 0-9 and all that is not ASCII. Others become spaces.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class Items:
    """The suffixes of a block of benchmark items, as numbers of words."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.names = [name for name, _ in items]
        self.number: dict[bytes, int] = {}
        rows, owner, sizes, starts = [], [], [], []
        for k, (_, text) in enumerate(items):
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for at in range(len(ids)):
                rows.append(ids[at : at + DEPTH] + [0] * (DEPTH - len(ids[at : at + DEPTH])))
                owner.append(k)
                starts.append(at)
                sizes.append(size if at + size <= len(ids) else 0)  # 0: a suffix too short to be a window
        self.ids = np.array(rows, ">u4").reshape(-1, DEPTH)
        self.owner, self.size, self.start = (np.array(x, np.int64) for x in (owner, sizes, starts))
        self.base = np.int64(len(self.number) + 1)
        whole = self.size > 0
        one = self.size == 1
        self.firsts = np.unique(self.ids[whole & one, 0].astype(np.int64))
        two = self.ids[whole & ~one]
        self.pairs = np.unique(two[:, 0].astype(np.int64) * self.base + two[:, 1].astype(np.int64))


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, which compare like the rows."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()


class Shard:
    """The sparse suffix array of one sequence of words (0 between documents)."""

    def __init__(self, seq: np.ndarray, items: Items):
        self.seq = np.concatenate((seq, np.zeros(DEPTH, np.int64)))
        first, second = self.seq[: len(seq)], self.seq[1 : len(seq) + 1]
        starts = np.zeros(len(seq), bool)
        if len(items.firsts):
            starts |= np.isin(first, items.firsts)
        both = np.flatnonzero((first > 0) & (second > 0))
        if len(items.pairs) and len(both):
            pair = first[both] * items.base + second[both]
            at = np.minimum(np.searchsorted(items.pairs, pair), len(items.pairs) - 1)
            starts[both[items.pairs[at] == pair]] = True
        places = np.flatnonzero(starts)
        rows = self.seq[places[:, None] + np.arange(DEPTH)]
        # Beyond a document's end only zeros count, so that no match reaches the next one.
        rows *= np.cumprod(rows > 0, axis=1)
        keys = _keys(rows)
        order = np.argsort(keys, kind="stable")
        self.places, self.keys, self.rows = places[order], keys[order], rows[order]

    def occurrences(self, items: Items) -> list[tuple[int, np.ndarray]]:
        """(row of the item suffix, places where its window occurs) for windows that occur."""
        out = []
        if not len(self.keys):
            return out
        for size in np.unique(items.size[items.size > 0]).tolist():
            own = np.flatnonzero(items.size == size)
            low = items.ids[own].astype(np.int64)
            low[:, size:] = 0
            high = low.copy()
            high[:, size:] = 0xFFFFFFFF
            lo = np.searchsorted(self.keys, _keys(low), "left")
            hi = np.searchsorted(self.keys, _keys(high), "right")
            out += [(int(own[k]), self.places[lo[k] : hi[k]]) for k in np.flatnonzero(hi > lo)]
        return out

    def longest(self, items: Items, suffix: int) -> tuple[int, int]:
        """(length, place) of the longest match of an item suffix, from its two neighbours."""
        if not len(self.keys):
            return 0, -1
        row = items.ids[suffix].astype(np.int64)
        at = int(np.searchsorted(self.keys, _keys(row[None, :])[0]))
        best = (0, -1)
        for k in (at - 1, at):
            if 0 <= k < len(self.keys):
                same = int(np.cumprod((self.rows[k] == row) & (row > 0)).sum())
                place = int(self.places[k])
                if same == DEPTH:  # equal this deep: follow the words
                    same += self._follow(items, suffix, place)
                best = max(best, (same, place))
        return best

    def _follow(self, items: Items, suffix: int, place: int) -> int:
        n, last = 0, len(items.ids)
        while (
            suffix + DEPTH + n < last
            and items.owner[suffix + DEPTH + n] == items.owner[suffix]
            and place + DEPTH + n < len(self.seq)
            and self.seq[place + DEPTH + n] == items.ids[suffix + DEPTH + n, 0]
        ):
            n += 1
        return n


def _sequence(texts: pa.Array, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text starts, its number of words, and all texts' words as numbers: 0 for a
    word no item has, and between texts."""
    get = items.number.get
    seq: list[int] = []
    lengths = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = words_of(text.as_py())
        lengths[i] = len(words)
        seq += [get(w, 0) for w in words]
        seq.append(0)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1].astype(np.int64)
    return starts, lengths, np.array(seq, np.int64)


def _search(items_of, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        items = items_of()
        for batch in slices(batches, -4):
            starts, lengths, seq = _sequence(batch.column(batch.num_columns - 4), items)
            shard = Shard(seq, items)
            marks = np.zeros(len(seq) + 1, np.int64)
            found: dict[int, set[int]] = {}
            for suffix, places in shard.occurrences(items):
                size, owner = int(items.size[suffix]), int(items.owner[suffix])
                np.add.at(marks, places, 1)
                np.add.at(marks, places + size, -1)
                for d in np.unique(np.searchsorted(starts, places, "right") - 1).tolist():
                    found.setdefault(d, set()).add(owner)
            hit = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
            of = np.searchsorted(starts, hit, "right") - 1
            old_hits, old_names = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            cut = np.searchsorted(of, np.arange(len(starts) + 1))
            new_hits, new_names = old_hits.to_pylist(), old_names.to_pylist()
            for d in found:
                own = (hit[cut[d] : cut[d + 1]] - starts[d]).tolist()
                new_hits[d] = sorted({*(new_hits[d] or []), *own}) if new_hits[d] else own
                new_names[d] = (new_names[d] or []) + [items.names[k] for k in sorted(found[d])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(lengths), pa.array(new_hits, pa.list_(pa.int64())), pa.array(new_names, pa.list_(pa.string()))],
                batch.schema.names,
            )

    return run


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items, read to the driver a block at a time; one empty block if there are none."""
    block, size, sent = [], 0, False
    for row in items.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("binary").alias("text")).toLocalIterator():
        if block and size + len(row["text"] or b"") > block_chars:
            yield block
            block, size, sent = [], 0, True
        block.append((row["name"] or "", bytes(row["text"] or b"")))
        size += len(row["text"] or b"")
    if block or not sent:
        yield block


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with its ``text`` as bytes and ``_words``, the count of words; ``_hits``, the numbers
    of the words that lie in an occurrence of a window, in order (null: none); ``_items``, the ids
    of the items found (null: none)."""
    spark = docs.sparkSession
    names = [c for c in docs.columns if c != "text"]
    out = docs.select(
        *names, F.col("text").cast("binary").alias("text"),
        F.lit(0).cast("bigint").alias("_words"),
        F.lit(None).cast("array<bigint>").alias("_hits"), F.lit(None).cast("array<string>").alias("_items"),
    )
    for block in _blocks(items, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def items_of(shared=shared) -> Items:
            return Items(shared.value, window)

        out = out.mapInArrow(_search(items_of, window), out.schema)
    return out


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs.select("doc_id", "text"), items, window, block_chars)
    names = F.coalesce(F.array_sort(F.array_distinct("_items")), F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.coalesce(F.size("_hits"), F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        F.col("_hits").isNotNull().alias("contaminated"),
    )


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_words: int = WINDOW) -> DataFrame:
    """The longest verbatim match of every item suffix in every shard, where it has ``min_words``
    words or more: ``(item_id, suffix, length, doc_id, word)``, both places counted in words. One row
    an item suffix and shard. The benchmark must fit one block."""
    block, *more = islice(_blocks(items, BLOCK_CHARS), 2)
    if more:
        raise ValueError(f"the benchmark has over {BLOCK_CHARS} characters: give it in parts")
    shared = docs.sparkSession.sparkContext.broadcast(block)
    kept = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        own = Items(shared.value, window)
        for batch in slices(batches, 1):
            starts, _, seq = _sequence(batch.column(1), own)
            shard, rows = Shard(seq, own), []
            for suffix in range(len(own.ids)):
                length, place = shard.longest(own, suffix)
                if length >= min_words:
                    d = int(np.searchsorted(starts, place, "right")) - 1
                    rows.append((own.names[own.owner[suffix]], int(own.start[suffix]), length, d, place - int(starts[d])))
            name, at, length, d, word = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(name, pa.string()), pa.array(at, pa.int64()), pa.array(length, pa.int64()),
                 batch.column(0).take(pa.array(d, pa.int64())), pa.array(word, pa.int64())],
                ["item_id", "suffix", "length", "doc_id", "word"],
            )

    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"item_id string, suffix bigint, length bigint, doc_id {kind}, word bigint")


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` less the contaminated ones, with the columns they came with."""
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), "text")
    return hits(whole, items, window).filter("_hits is null").select("_doc.*")
