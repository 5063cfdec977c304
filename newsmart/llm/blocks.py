"""Queries against rows that share a key, in blocks: no group holds a whole key."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.llm.common import store


def block_join(
    rows: DataFrame, queries: DataFrame, key: str, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str, block: int, query_block: int
) -> DataFrame:
    """``fn(rows, queries)`` of every pair of blocks of a key. A key's rows are dealt to blocks of
    about ``block`` by a hash of the whole row, its queries to blocks of about ``query_block``; each
    side goes to every block of the other, so each row of a key meets each query of it once."""
    parts = lambda n: F.ceil(F.count("*") / F.lit(n)).cast("bigint")
    sizes = rows.groupBy(key).agg(parts(block).alias("_is")).join(queries.groupBy(key).agg(parts(query_block).alias("_js")), key)
    sizes = store(sizes.coalesce(16), "sizes")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    one = rows.join(sizes, key).withColumn("_i", F.pmod(F.xxhash64(*rows.columns), "_is")).withColumn("_j", every("_js"))
    two = queries.join(sizes, key).withColumn("_j", F.pmod(F.xxhash64(*queries.columns), "_js")).withColumn("_i", every("_is"))
    group = [key, "_i", "_j"]
    one, two = (x.drop("_is", "_js").groupBy(*group) for x in (one, two))
    return one.cogroup(two).applyInArrow(fn, schema)


def matrix(column: pa.ChunkedArray | pa.Array, dtype, width: int = 0) -> np.ndarray:
    """Lists of numbers as one matrix, ``width`` columns at least; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, width), dtype)
    sizes = np.asarray(column.value_lengths())
    wide = max(width, int(sizes.max(initial=0)))
    flat = np.asarray(column.flatten()).astype(dtype, copy=False)
    if (sizes == wide).all():
        return flat.reshape(-1, wide)
    out = np.zeros((len(sizes), wide), dtype)
    out[np.arange(wide) < sizes[:, None]] = flat
    return out


def same_width(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = max(one.shape[1], two.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (one, two))
