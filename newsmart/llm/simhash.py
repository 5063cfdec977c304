"""SimHash near-duplicates through pivot distance tables (operator 2).

A fingerprint has one bit per hash bit of a document's word shingles: 1 where
over half the shingle hashes have it. Two fingerprints link at ``max_bits`` or
fewer differing bits. The search for links has the method's three steps:

1. *Tables.* The bits are cut into ``segments``. Within each segment the Hamming
   distances to a set of reference patterns are precomputed, and over all 64 bits
   the distances to ``N_PIVOTS`` reference fingerprints.
2. *Discard.* Two fingerprints within ``max_bits`` agree on at least ``segments -
   max_bits`` segments, so there all their segment distances are equal. The
   distance rows of each choice of that many segments are the join keys: a pair
   that shares no key is discarded unseen. Pairs that share one are discarded
   when any of their full-width pivot distances differs by over ``max_bits``.
3. *Verify.* Survivors are compared bit by bit.

Only distinct fingerprints take part, 16 bytes a key row; texts are read once.
A key with more than ``block`` fingerprints is cut into blocks, each pair of
blocks being a group of its own, so no task holds a whole hot key. A group gives
a spanning forest of its links, never all pairs; components keep every link.

Cases: a null or wordless text has fingerprint zero and links like any other;
repeated rows and ids stay separate rows; an empty table gives no rows; other
columns are not read, so their names can't clash."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.common import IDENTITY, identity, map_arrow, store
from newsmart.llm.components import connected_components

BITS = 64
SEED = 42
N_PIVOTS = 24
#: Shingle hashes taken at a time, so that a very long text needs little memory.
CHUNK = 65536


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text (UTF-8)."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        h = [digest(line[s:e], SEED) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)]
        votes += _bit_counts(np.array(h, np.uint64))
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set. Bytes are counted by value first, so the
    work is eight histograms and one small product."""
    by_byte = h.view(np.uint8).reshape(-1, 8)
    if len(h) < 512:
        return np.unpackbits(by_byte, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, _k1, _k2, fp)`` per row, ``fp`` the fingerprint's bits as a signed long."""
    kept = docs.select("doc_id", *identity(), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(3)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(fps, pa.int64())], ["doc_id", *IDENTITY, "fp"]
            )

    return map_arrow(kept, run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, _k1 bigint, _k2 bigint, fp bigint")


def pivots() -> np.ndarray:
    """Reference fingerprints: hashes of 0, 1, 2 ..., the same everywhere."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(N_PIVOTS)], np.uint64)


def pivot_distances(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """The table of Hamming distances, one row a fingerprint and one column a reference."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def segment_tables(fps: np.ndarray, segments: int) -> list[np.ndarray]:
    """Per segment, each fingerprint's distances to the segment's references, as one number.

    The references of a segment are zero and its single-bit patterns; the
    differences of their distances tell all its bits, so equal rows mean equal bits."""
    edges = np.linspace(0, BITS, segments + 1).astype(int)
    out = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        mask = np.uint64(((1 << int(hi)) - 1) ^ ((1 << int(lo)) - 1))
        part = fps & mask
        to_zero = np.bitwise_count(part).astype(np.int64)
        row = np.zeros(len(fps), np.int64)
        for k in range(int(lo), int(hi)):
            to_bit = np.bitwise_count(part ^ np.uint64(1 << k)).astype(np.int64)
            row = (row << 1) | ((to_bit - to_zero) < 0)
        out.append(row)
    return out


def _forest(fps: np.ndarray, side: np.ndarray, dist: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what all the pairs of one group connect. Of two blocks only
    pairs across them count: each block against itself is a group of its own."""
    n, root, links = len(fps), list(range(len(fps))), []
    across = bool((side != side[0]).any())

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(n - 1):
        js = np.arange(i + 1, n)
        if across:
            js = js[side[js] != side[i]]
        js = js[np.abs(dist[js] - dist[i]).max(axis=1, initial=0) <= max_bits]
        js = js[np.bitwise_count(fps[js] ^ fps[i]) <= max_bits]
        for j in js.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def _links_of_groups(cols: list[np.ndarray], refs: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """The links of whole groups, given as rows sorted by group."""
    g, p, fp, side = cols
    fp = fp.view(np.uint64)
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (p[1:] != p[:-1]))) if len(g) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate((starts, [len(g)])))
    dist = pivot_distances(fp, refs)
    first = starts[sizes == 2]  # most groups are pairs: all at once
    near = np.abs(dist[first] - dist[first + 1]).max(axis=1, initial=0) <= max_bits
    first = first[near]
    first = first[np.bitwise_count(fp[first] ^ fp[first + 1]) <= max_bits]
    a, b = [fp[first]], [fp[first + 1]]
    for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        own = slice(s, s + n)
        for i, j in _forest(fp[own], side[own], dist[own], max_bits):
            a.append(fp[s + i : s + i + 1])
            b.append(fp[s + j : s + j + 1])
    a, b = (np.concatenate(x).view(np.int64) for x in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _group_links(max_bits: int):
    refs = pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Rows come sorted by group; of an unfinished group the rows wait for the next batch."""
        rest = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            cols = [np.concatenate((x, np.asarray(y))) for x, y in zip(rest, batch.columns, strict=True)]
            g, p = cols[:2]
            cut = np.flatnonzero((g[1:] != g[:-1]) | (p[1:] != p[:-1])) + 1
            last = int(cut[-1]) if len(cut) else 0
            rest = [x[last:] for x in cols]
            if last:
                yield _links_of_groups([x[:last] for x in cols], refs, max_bits)
        if len(rest[0]):
            yield _links_of_groups(rest, refs, max_bits)

    return run


def near_links(fps: DataFrame, max_bits: int = 3, segments: int = 5, block: int = 512) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``fp`` that connect all those within
    ``max_bits``. More ``segments`` give longer keys, for more fingerprints."""
    if not 0 <= max_bits < segments:
        raise ValueError("max_bits must be smaller than the number of segments")
    choices = list(combinations(range(segments), segments - max_bits))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column(0))
            if not len(fp):
                continue
            tables = segment_tables(fp.view(np.uint64), segments)
            width = BITS // segments + 1
            for c, chosen in enumerate(choices):
                key = np.zeros(len(fp), object) if width * len(chosen) > 56 else np.zeros(len(fp), np.int64)
                for s in chosen:
                    key = (key << width) | tables[s]
                if key.dtype == object:
                    key = np.array([xxhash.xxh64_intdigest(str(k).encode()) >> 8 for k in key], np.int64)
                key = (key << 7) | c if len(choices) <= 128 else key * len(choices) + c
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], ["g", "fp"])

    keyed = map_arrow(fps.select("fp"), keys, "g bigint, fp bigint")
    sizes = keyed.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("bigint")
    mine = F.pmod(F.xxhash64("fp", F.lit("block")), blocks).cast("bigint")
    paired = (
        keyed.join(sizes, "g")
        .select("g", "fp", blocks.alias("k"), mine.alias("i"))
        .select("g", "fp", "k", "i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("j"))
        .select("g", (F.least("i", "j") * F.col("k") + F.greatest("i", "j")).alias("p"), "fp", F.col("i").alias("side"))
    )
    grouped = paired.repartition("g", "p").sortWithinPartitions("g", "p")
    return map_arrow(grouped, _group_links(max_bits), "a bigint, b bigint")


def components(docs: DataFrame, shingle: int = 3, max_bits: int = 3, segments: int = 5, block: int = 512) -> DataFrame:
    """Per row: ``doc_id``, the row's identity, ``fp`` and ``component_id``, the smallest
    doc_id that its fingerprint reaches (null only where all that it reaches are null)."""
    rows = store(fingerprints(docs, shingle), "simhash")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(near_links(least, max_bits, segments, block))
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")


def hex_digits(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` less all but one document of each group of near-duplicates: the one with
    the smallest ``doc_id`` stays (nulls last, then by text hash; of equal rows, one).
    All columns stay as they are."""
    found = components(docs, shingle, max_bits)
    rank = F.struct(F.isnull("doc_id"), "doc_id", *IDENTITY)
    winners = found.groupBy("root").agg(F.min(rank).alias("w")).select("w._k1", "w._k2")
    keyed = docs.select(F.struct(*docs.columns).alias("_doc"), *identity()).join(winners, IDENTITY)
    nth = F.row_number().over(W.partitionBy(*IDENTITY).orderBy(F.xxhash64("_doc")))
    return keyed.withColumn("_nth", nth).filter("_nth = 1").select("_doc.*")
