"""Incremental loading with Structured Streaming (RA-9, RA-10).

The reference polls: every hour it lands a window, once a day it rebuilds bronze from
everything landed and deletes the raw files. Here the landing folder is a file stream:

* ``start_incremental_bronze`` takes each new landing file exactly once (the stream's
  checkpoint records them) and appends the batch, deduplicated within itself, as its
  own ``(load_date, batch_id)`` partition. A replayed batch overwrites exactly that
  partition with the same rows: the load day is the landing day of the files (their
  ``ingest_date`` folder, else their modification day), not the clock. Nothing already stored is rewritten, so each micro-batch costs
  only its own rows.
* ``read_incremental_bronze`` is bronze as the batch path defines it: one row per
  (load day, title, publishedAt), the first by landing provenance (window, page,
  URL), whichever batch it arrived in. ``compact_bronze_day`` folds a closed day's
  batch partitions into one, once.
* ``append_new_articles`` is streaming dedup without loss: each micro-batch keeps the
  first of each (title, publishedAt) that no earlier batch has stored, however late it
  comes. The stored keys are the state, so it needs no watermark; a batch reads those of
  the very publication days it touches. ``fold_article_batches`` keeps the files of a day few.
* ``windowed_counts`` counts rows per event-time window with a watermark; a window is
  emitted once the watermark passes its end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsmart.functions import parse_timestamp, utc_date
from newsmart.operators.bronze import DEDUP_KEYS, DEDUP_ORDER, keep_first, tie_break
from newsmart.schemas import ARTICLE, ARTICLE_COLUMNS, LANDING_RECORD
from newsmart.session import cut_lineage
from newsmart.sources.landing import explode_articles, with_provenance
from newsmart.sources.tables import partition_values, read_table
from newsmart.sources.writers import PARQUET_OPTIONS, path_exists

# Landing files as our writer lays them out; the ``ingest_date`` partition column must
# be named in the schema for a file stream to fill it.
LANDING_STREAM_SCHEMA = T.StructType(LANDING_RECORD.fields + [T.StructField("ingest_date", T.DateType())])
INCREMENTAL_BRONZE_COLUMNS = ARTICLE_COLUMNS + ["window_start", "page", "load_date"]
BATCH_KEYS = ("load_date",) + DEDUP_KEYS
COMPACTED_BATCH = -1


def landing_stream(
    spark: SparkSession,
    landing_dir: str,
    multi_line: bool = False,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Envelopes of new landing files. ``clean_source='archive'|'delete'`` consumes the
    raw files once a later batch has committed (SNK-3 for the incremental path). A malformed
    file fails the stream, as it fails the batch reader: it is never read as nothing.
    ``multi_line`` reads the original layout, one indented document a file."""
    reader = spark.readStream.schema(LANDING_STREAM_SCHEMA).option("multiLine", multi_line).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if clean_source == "archive":
            if not archive_dir:
                raise ValueError("cleanSource=archive needs archive_dir")
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.json(landing_dir).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_file_mtime"),
    )


def _batch_articles(batch: DataFrame) -> DataFrame:
    arts = explode_articles(with_provenance(batch))
    # The load day is the landing day (or, for files outside our layout, the day the
    # file was written): fixed by the data, so a replayed batch lands in the same day.
    return arts.withColumn("load_date", F.coalesce(F.col("ingest_date"), utc_date(F.col("_file_mtime"))))


def _write_batches(df: DataFrame, bronze_path: str) -> None:
    (
        df.write.mode("overwrite").options(**PARQUET_OPTIONS)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_date", "batch_id")
        .parquet(bronze_path)
    )


def bronze_batch_writer(bronze_path: str):
    """``foreachBatch`` function: dedup the batch and write it as its own partition."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _batch_articles(batch).select(*INCREMENTAL_BRONZE_COLUMNS).withColumn("batch_id", F.lit(batch_id))
        _write_batches(keep_first(rows, BATCH_KEYS, DEDUP_ORDER, tie_break()), bronze_path)

    return write


def read_incremental_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Bronze rows across all stored batches, deduplicated per load day."""
    return first_deliveries(read_table(spark, bronze_path))


def first_deliveries(stored: DataFrame) -> DataFrame:
    """Rows stored in batches -> one per load day and key, without the batch column."""
    return keep_first(stored, BATCH_KEYS, DEDUP_ORDER, tie_break()).drop("batch_id")


def compact_bronze_day(spark: SparkSession, bronze_path: str, load_date: str) -> None:
    """Fold one closed load day's batch partitions into a single deduplicated one.
    Run it only for days the stream no longer writes to."""
    day = read_table(spark, bronze_path).filter(F.col("load_date") == F.lit(load_date).cast("date"))
    folded = keep_first(day, BATCH_KEYS, DEDUP_ORDER, tie_break()).withColumn("batch_id", F.lit(COMPACTED_BATCH))
    # The old partitions are removed only after the folded day is safely written.
    _write_batches(cut_lineage(folded), bronze_path)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    day_dir = jvm.org.apache.hadoop.fs.Path(f"{bronze_path.rstrip('/')}/load_date={load_date}")
    fs = day_dir.getFileSystem(conf)
    for status in fs.listStatus(day_dir):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and name != f"batch_id={COMPACTED_BATCH}":
            fs.delete(status.getPath(), True)


def start_incremental_bronze(
    spark: SparkSession,
    landing_dir: str,
    bronze_path: str,
    checkpoint_location: str,
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
    clean_source: str | None = None,
    archive_dir: str | None = None,
    multi_line: bool = False,
) -> StreamingQuery:
    """RA-9. ``trigger=None`` processes what is there now and stops
    (``availableNow``); ``trigger="1 hour"`` keeps polling every hour. Batches are numbered
    by the checkpoint, so a new checkpoint over stored batches is refused: it would number
    from 0 again and replace them."""
    if not path_exists(spark, f"{checkpoint_location.rstrip('/')}/commits") and partition_values(spark, bronze_path, "load_date"):
        raise ValueError(f"{bronze_path} holds batches, but {checkpoint_location} is not their checkpoint")
    stream = landing_stream(spark, landing_dir, multi_line, max_files_per_trigger, clean_source, archive_dir)
    writer = stream.writeStream.foreachBatch(bronze_batch_writer(bronze_path)).option(
        "checkpointLocation", checkpoint_location
    )
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def run_incremental_bronze(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint_location: str,
                           **kwargs) -> None:
    q = start_incremental_bronze(spark, landing_dir, bronze_path, checkpoint_location, **kwargs)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


PUBLISHED_DAY = "published_day"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _days_filter(days: list) -> Column:
    """The partitions of exactly these days (None: those of no day)."""
    day = F.col(PUBLISHED_DAY)
    known = [F.lit(d) for d in days if d is not None]
    return (day.isin(known) if known else F.lit(False)) | (day.isNull() if None in days else F.lit(False))


def already_stored(rows: DataFrame, path: str, batch_id: int, days: list) -> DataFrame:
    """The keys of ``rows`` that earlier batches stored, as ``_title`` and ``_publishedAt``. Of the store, the
    key columns of the days ``days`` are read; a semi join by 64-bit digests of the keys leaves those that the
    batch may hold (all that it holds, and one of equal digest), so that a small batch thins them out
    before anything is shuffled and only eight bytes of a key are sent round. Compare the keys themselves after it."""
    stored = read_table(rows.sparkSession, path).filter((F.col("batch_id") < batch_id) & _days_filter(days))
    digest = F.xxhash64(*DEDUP_KEYS).alias("_digest")
    known = stored.select(*(F.col(c).alias(f"_{c}") for c in DEDUP_KEYS), digest)
    return known.join(rows.select(digest), "_digest", "left_semi").drop("_digest")


def new_article_writer(path: str):
    """``foreachBatch`` function: the batch's articles whose (title, publishedAt) no earlier
    batch has stored, one each, as ``(published_day, batch_id)`` partitions, a file each unless a day
    is heavy. A replayed batch compares with earlier batches only, so it writes the same rows to the
    same place."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _finish_folds(spark, path)
        rows = explode_articles(with_provenance(batch))
        rows = rows.withColumn(PUBLISHED_DAY, utc_date(parse_timestamp("publishedAt", lenient=True)))
        rows = keep_first(rows, ties=tie_break()).select(*ARTICLE_COLUMNS, PUBLISHED_DAY).withColumn("batch_id", F.lit(batch_id))
        if partition_values(spark, path, PUBLISHED_DAY):
            rows = cut_lineage(rows)
            days = [r[0] for r in rows.select(PUBLISHED_DAY).distinct().collect()]  # days of the calendar
            known = already_stored(rows, path, batch_id, days)
            rows = rows.join(known, [rows[c].eqNullSafe(known[f"_{c}"]) for c in DEDUP_KEYS], "left_anti")
        sized = rows.hint("rebalance", PUBLISHED_DAY)
        sized.write.mode("overwrite").options(**PARQUET_OPTIONS).option("partitionOverwriteMode", "dynamic").partitionBy(PUBLISHED_DAY, "batch_id").parquet(path)

    return write


def _fold_paths(spark: SparkSession, path: str):
    """``path(name)`` and the file system that holds it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    made = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")
    return made, made("").getFileSystem(conf)


def _finish_folds(spark: SparkSession, path: str) -> None:
    """Put the days in place whose folding was decided (the log is there), however far it came."""
    of, fs = _fold_paths(spark, path)
    if not fs.exists(of("_folds")):
        return
    for status in fs.listStatus(of("_folds")):
        day, _, batches = status.getPath().getName().partition("@")
        folded = of(f"_folded/{PUBLISHED_DAY}={day}")
        if fs.exists(folded):
            for b in batches.split(","):
                fs.delete(of(f"{PUBLISHED_DAY}={day}/batch_id={b}"), True)
            if not fs.rename(folded, of(f"{PUBLISHED_DAY}={day}/batch_id={COMPACTED_BATCH}")):
                raise OSError(f"could not put the folded day {day} of {path} in place")
        fs.delete(status.getPath(), True)


def fold_article_batches(spark: SparkSession, path: str, before: int, at_least: int = 8) -> list[str]:
    """Fold, of each published day with ``at_least`` batches before batch ``before``, those batches into
    one. Call it between batches, with ``before`` the number of the next one, as a replayed batch must
    not be folded. A folded day is written aside, decided by a log, then put in place: what fails
    before the log changes nothing, and what fails after it is finished by the next batch or fold.
    Returns the days folded."""
    _finish_folds(spark, path)
    of, fs = _fold_paths(spark, path)
    fs.delete(of("_folded"), True)
    chosen: dict[str, list[int]] = {}
    for day in partition_values(spark, path, PUBLISHED_DAY):
        held = [int(b) for b in partition_values(spark, f"{path}/{PUBLISHED_DAY}={day}", "batch_id") if int(b) < before]
        if len(held) >= max(2, at_least):
            chosen[day] = held
    if not chosen:
        return []
    days = [None if d == _NO_DAY else dt.date.fromisoformat(d) for d in chosen]
    rows = read_table(spark, path).filter((F.col("batch_id") < before) & _days_filter(days)).drop("batch_id")
    rows.hint("rebalance", PUBLISHED_DAY).write.options(**PARQUET_OPTIONS).partitionBy(PUBLISHED_DAY).parquet(f"{path}/_folded")
    for day, batches in chosen.items():
        fs.create(of(f"_folds/{day}@{','.join(map(str, batches))}"), True).close()
    _finish_folds(spark, path)
    return sorted(chosen)


def append_new_articles(
    spark: SparkSession, landing_dir: str, path: str, checkpoint_location: str,
    max_files_per_trigger: int | None = None, multi_line: bool = False,
) -> DataFrame:
    """RA-10: streaming DST-1, exact over any number of micro-batches and any lateness. Drains
    the landing folder into ``path`` and returns what it holds: article columns, one row a key,
    the first to arrive (within a batch, the first by provenance)."""
    stream = landing_stream(spark, landing_dir, multi_line, max_files_per_trigger)
    q = (
        stream.writeStream.foreachBatch(new_article_writer(path))
        .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    if not partition_values(spark, path, PUBLISHED_DAY):
        return spark.createDataFrame([], ARTICLE)
    return read_table(spark, path).select(*ARTICLE_COLUMNS)


def windowed_counts(
    stream: DataFrame, ts_col: str, keys: tuple[str, ...] = (), window: str = "1 hour", delay: str = "2 hours"
) -> DataFrame:
    """RA-10: rows per (event-time window, keys); append mode emits a window once the
    watermark (max event time - ``delay``) passes its end. Window bounds are returned
    as TIMESTAMP_NTZ in UTC."""
    et = F.col(ts_col).cast("timestamp")
    agg = (
        stream.withColumn("_event_time", et)
        .withWatermark("_event_time", delay)
        .groupBy(F.window("_event_time", window), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return agg.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *keys, "n",
    )


def _start_with_partitions(writer, spark: SparkSession, state_partitions: int | None) -> StreamingQuery:
    """Start a query with ``state_partitions`` shuffle partitions. A stateful stream
    fixes this number at its first start (it is kept in the checkpoint), so it is set
    just for the start and the session value is restored."""
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, previous)


def run_to_parquet(df: DataFrame, path: str, checkpoint_location: str, state_partitions: int | None = None) -> None:
    """Drain a streaming DataFrame (availableNow) into a parquet sink in append mode."""
    writer = (
        df.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
    )
    q = _start_with_partitions(writer, df.sparkSession, state_partitions)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
