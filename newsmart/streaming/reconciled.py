"""Windowed counts that lose no late row (RA-10).

``windowed_counts`` drops a row that comes once its window has been emitted. Here a micro-batch
writes what it adds to each window, and nothing else, in two kinds of rows:

* *on time*: the window was still open when the batch began;
* *late*: it had been closed by then, that is its end was not after the watermark (the newest
  event of all earlier batches less the delay). These are the side channel: a reader that acted on a
  closed window finds here what has to be corrected.

Counts are sums of these parts, so a batch costs its own rows, whatever came before; a replayed
batch overwrites its own part with the same rows, as its watermark comes from earlier batches
only. ``fold_counts`` adds the parts of many batches up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.session import delete_path
from newsmart.sources.tables import partition_values, read_table

SUMS = ["n", "late"]


def _instant(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """The parts that count: the newest fold, and the batches behind it."""
    fold = min((int(b) for b in partition_values(spark, path, "batch_id")), default=0)
    parts = read_table(spark, path)
    return parts.filter((F.col("batch_id") == fold) | (F.col("batch_id") >= -fold)) if fold < 0 else parts


def _write_parts(parts: DataFrame, path: str) -> None:
    sized = parts.hint("rebalance", "batch_id")
    sized.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def _newest_before(spark: SparkSession, path: str, batch_id: int):
    """The newest event of the batches before ``batch_id`` (one row a window is looked at, no event)."""
    if not any(int(b) < batch_id for b in partition_values(spark, path, "batch_id")):
        return None
    return _parts(spark, path).filter(F.col("batch_id") < batch_id).agg(F.max("newest").cast("string")).first()[0]


def count_writer(path: str, ts_col: str, keys: tuple[str, ...] = (), window: str = "1 hour", delay: str = "2 hours"):
    """``foreachBatch`` function: the batch's part of each window's count."""

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = _newest_before(batch.sparkSession, path, batch_id)
        rows = batch.select(_instant(ts_col).alias("_at"), *keys).filter(F.col("_at").isNotNull())
        parts = rows.groupBy(F.window("_at", window).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.max("_at").alias("newest"))
        closed = F.lit(False) if newest is None else F.col("_w.end") <= F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {delay}")
        parts = parts.select(
            _instant("_w.start").alias("window_start"), _instant("_w.end").alias("window_end"), *keys,
            "n", F.when(closed, F.col("n")).otherwise(F.lit(0)).cast("long").alias("late"), "newest",
        )
        _write_parts(parts.withColumn("batch_id", F.lit(batch_id)), path)

    return write


def _summed(parts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return parts.groupBy("window_start", "window_end", *keys).agg(*(F.sum(c).cast("long").alias(c) for c in SUMS), F.max("newest").alias("newest"))


def read_reconciled_counts(
    spark: SparkSession, path: str, keys: tuple[str, ...] = (), delay: str = "2 hours", closed_only: bool = True
) -> DataFrame:
    """``(window_start, window_end, *keys, n, late)``: all rows of each window, ``late`` of them after it
    was closed. ``closed_only`` leaves out windows that are open after the newest event of all."""
    parts = _parts(spark, path)
    out = _summed(parts, keys).drop("newest")
    if closed_only:
        mark = parts.select(F.max("newest") - F.expr(f"interval {delay}")).scalar()
        out = out.filter(F.col("window_end") <= mark)
    return out


def fold_counts(spark: SparkSession, path: str, before: int, keys: tuple[str, ...] = ()) -> None:
    """Add up the parts of all batches before ``before`` (the next batch's number), as one part that
    stands for them (``-1 - <last batch>``): readers leave the others out from the moment it is there,
    so their folders may go at any time after."""
    parts = _parts(spark, path)
    held = [int(b) for b in partition_values(spark, path, "batch_id") if 0 <= int(b) < before]
    if not held or parts.filter(F.col("batch_id") < before).select("batch_id").distinct().limit(2).count() < 2:
        return
    folded = _summed(parts.filter(F.col("batch_id") < before), keys).withColumn("batch_id", F.lit(-1 - max(held)))
    _write_parts(folded, path)
    for b in partition_values(spark, path, "batch_id"):
        if int(b) < before and int(b) != -1 - max(held):
            delete_path(spark, f"{path}/batch_id={b}")


def run_reconciled_counts(
    stream: DataFrame, path: str, checkpoint_location: str, ts_col: str, keys: tuple[str, ...] = (),
    window: str = "1 hour", delay: str = "2 hours",
) -> None:
    """Drain a stream into the parts under ``path``."""
    q = (
        stream.writeStream.foreachBatch(count_writer(path, ts_col, keys, window, delay))
        .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
