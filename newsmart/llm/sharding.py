"""Sharding by Karmarkar-Karp differencing (operator 10).

Groups that must not be divided (here: equal texts) are dealt to ``n`` shards of nearly
equal bytes. A partial partition is ``n`` sums. The two whose spread (largest sum less
smallest) is widest are combined, the largest of one with the smallest of the other,
until one is left.

At scale this runs in two levels. The large groups, over ``1 / (n * large_parts)`` of all
bytes each and so fewer than ``n * large_parts``, are differenced first. The others are
hashed to buckets of about ``bucket_groups``, and a task differences each bucket, with one
partial partition more: the large groups' sums, scaled to the bucket's share of the bytes.
Where its sums end names the shards, so every bucket leaves the room that the large groups
fill, and the buckets' small misfits add up to a few bytes. No text and no unbounded set
of groups meets in one place.

Cases: a null text is empty, so of size 1, and shares a group with empty ones; equal rows
are rows of one group; a group larger than a shard's share makes that shard larger, as it
may not be divided; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmart.llm.common import map_arrow, store

SHARDS = 16
BUCKET_GROUPS = 20_000
LARGE_PARTS = 64


def difference(parts: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions (``n`` sums each) by largest spread first. Returns the last
    one's sums, and for every part the slot each of its sums ended in."""
    n = len(parts[0])
    orders: list[list[int]] = []  # per node: its sums' order, descending, as slots before sorting
    heap, children = [], []
    for k, sums in enumerate(parts):
        order = sorted(range(n), key=sums.__getitem__, reverse=True)
        ordered = [sums[i] for i in order]
        orders.append(order)
        children.append(None)
        heap.append((ordered[-1] - ordered[0], k, ordered))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heap[0]
        sums = [p + q for p, q in zip(x, reversed(y), strict=True)]
        order = sorted(range(n), key=sums.__getitem__, reverse=True)
        ordered = [sums[i] for i in order]
        node = len(orders)
        orders.append(order)
        children.append((a, b))
        heapq.heapreplace(heap, (ordered[-1] - ordered[0], node, ordered))
    _, top, last = heap[0]
    # From the top down: where the sum at each sorted slot of a node ends.
    ends: list[list[int] | None] = [None] * len(orders)
    ends[top] = list(range(n))
    for node in range(len(orders) - 1, -1, -1):
        end = [0] * n
        for slot, was in enumerate(orders[node]):
            end[was] = ends[node][slot]
        if children[node] is None:
            ends[node] = end
        else:
            a, b = children[node]
            ends[a], ends[b] = end, end[::-1]
            ends[node] = None
    return last, [ends[k] for k in range(len(parts))]


def group_shards(
    groups: DataFrame, n: int = SHARDS, bucket_groups: int = BUCKET_GROUPS, large_parts: int = LARGE_PARTS
) -> DataFrame:
    """``groups(k1, k2, bytes)``, one row a group -> ``(k1, k2, shard)``."""
    groups = store(groups, "groups")
    total, count = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    is_large = F.col("bytes") * (n * large_parts) > total  # so there are fewer than n * large_parts
    large = sorted(((r["bytes"], r["k1"], r["k2"]) for r in groups.filter(is_large).collect()), reverse=True)
    base, ends = difference([[x[0], *[0] * (n - 1)] for x in large]) if large else ([0] * n, [])
    shards_of_large = pa.table(
        {"k1": pa.array([x[1] for x in large], pa.int64()), "k2": pa.array([x[2] for x in large], pa.int64()),
         "shard": pa.array([e[0] for e in ends], pa.int32())}
    )
    small = max(1, int(total) - sum(x[0] for x in large))
    buckets = max(1, math.ceil((count - len(large)) / bucket_groups))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", "k1", "k2"], ascending=False)
        sizes = [int(x) for x in pdf["bytes"]]
        taken = [x * sum(sizes) // small for x in base]  # this bucket's share of what the large ones fill
        _, ends = difference([taken, *([x, *[0] * (n - 1)] for x in sizes)])
        shard = {slot: k for k, slot in enumerate(ends[0])}
        return pd.DataFrame({"k1": pdf["k1"], "k2": pdf["k2"], "shard": [shard[e[0]] for e in ends[1:]]})

    bucket = F.pmod(F.xxhash64("k1", "k2", F.lit("bucket")), F.lit(buckets))
    dealt = groups.filter(~is_large).groupBy(bucket.alias("bucket")).applyInPandas(run, "k1 bigint, k2 bigint, shard int")
    return dealt.unionByName(groups.sparkSession.createDataFrame(shards_of_large))


def rows_with_keys(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32, k1, k2)``: 128 bits of the text, its length and its CRC tell
    groups apart; no text leaves the scan."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(text)
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint").alias("k1"),
        F.conv(F.substring(digest, 17, 16), 16, -10).cast("bigint").alias("k2"),
    )


def shard_by_bytes(docs: DataFrame, n: int = SHARDS, bucket_groups: int = BUCKET_GROUPS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: under this law a
    further shard would move rows between the others)."""
    rows = store(rows_with_keys(docs), "sizes")
    groups = rows.groupBy("k1", "k2").agg(F.sum("size").alias("bytes"))
    shards = group_shards(groups, n, bucket_groups)
    numbered = store(_number(rows.join(shards, ["k1", "k2"]).select("doc_id", "size", "text_crc32", "shard"), n), "shards")
    per_part = numbered.groupBy("shard", "part").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow))
    base = store(per_part.select("shard", "part", (so_far - F.col("n")).alias("base")), "bases")
    return numbered.join(base, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def _number(rows: DataFrame, n: int) -> DataFrame:
    """Each row with its partition and its number among the partition's rows of its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(n, np.int64)
        for batch in batches:
            shard = np.asarray(batch.column(3))
            nth = np.zeros(len(shard), np.int64)
            for k in np.unique(shard).tolist():
                own = np.flatnonzero(shard == k)
                nth[own] = seen[k] + np.arange(len(own))
                seen[k] += len(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(shard), part, np.int32)), pa.array(nth)],
                [*batch.schema.names, "part", "nth"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, size bigint, text_crc32 bigint, shard int, part int, nth bigint")
