"""Dense surrogate ids in value order, computed without a single-task window (KEY-1/2).

Distinct keys are range-partitioned and sorted inside each partition; the id is the
row's position inside its partition plus the number of keys in all earlier
partitions. The per-partition counts table has one row per range partition, so it is
the only thing broadcast and its size is bounded by the partition count we choose.
The ranged keys are checkpointed first: the counts and the ids must come from the same
partitioning, and a re-sampled range split after an executor loss would not be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.session import cut_lineage

_LOW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def number_rows(rows: DataFrame, order: list[Column], id_col: str, num_partitions: int | None = None) -> DataFrame:
    """``rows`` with ``id_col``, their position (from 0) in the total order ``order``."""
    n = num_partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        rows.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.spark_partition_id().alias("_pid"),
            (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).alias("_pos"),
        )
    )
    ranged = cut_lineage(ranged)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range partition: a bounded table, so an unpartitioned window is fine.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return ranged.join(F.broadcast(offsets), "_pid").select(
        (F.col("_off") + F.col("_pos")).cast("long").alias(id_col), *rows.columns
    )


def dense_ids(values: DataFrame, col: str, id_col: str, num_partitions: int | None = None) -> DataFrame:
    """``(id_col, col)`` for every distinct value of ``col``: ids 0..n-1 ascending,
    null last. Equals ``row_number() over (order by col nulls last) - 1``."""
    return number_rows(values.select(col).distinct(), [F.asc_nulls_last(col)], id_col, num_partitions)


def extend_ids(values: DataFrame, existing: DataFrame, col: str, id_col: str) -> DataFrame:
    """Stable ids: keep the ids already in ``existing`` and number
    new members after its maximum, in value order."""
    known = existing.select(id_col, col)
    cand = values.select(F.col(col).alias("_v")).distinct()
    fresh = cand.join(known, cand["_v"].eqNullSafe(known[col]), "left_anti").select(F.col("_v").alias(col))
    start = existing.select(F.coalesce(F.max(id_col) + 1, F.lit(0))).scalar()
    numbered = dense_ids(fresh, col, "_new_id").select((F.col("_new_id") + start).alias(id_col), col)
    return known.unionByName(numbered)
