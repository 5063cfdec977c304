"""Sinks (SNK-1..6) and the staging-then-swap publisher.

File moves go through Hadoop's ``FileSystem`` so they work on any store Spark can
write; only file *names* pass through the driver, never rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath, _ = _fs(spark, path)
    return bool(fs.exists(hpath))


#: Stored tables hold whole texts: zstd takes about two thirds of what the default codec does.
PARQUET_OPTIONS = {"compression": "zstd"}


def write_landing(envelopes: DataFrame, path: str, compression: str | None = None, by_day: bool = False) -> None:
    """SNK-1: append envelopes (with ``window_start``, ``page`` and ``ingest_date``) as
    JSON Lines under ``ingest_date=<d>``; pages without articles are skipped.

    The rows are rebalanced on ``ingest_date`` (AQE sizes the files by volume and splits
    a heavy landing day), so file count follows data, never one file per page. ``by_day``:
    they are dealt by their landing day already and written as they come. ``compression``, as
    ``gzip``, is told by the files' names, so the readers need not know it."""
    pages = envelopes.filter(F.size("articles") > 0)
    if not by_day:
        pages = pages.hint("rebalance", "ingest_date")
    pages.write.mode("append").partitionBy("ingest_date").json(path, compression=compression)


def write_bronze(bronze: DataFrame, path: str) -> None:
    """SNK-2: replace only the load days present in ``bronze``."""
    (
        bronze.write.mode("overwrite").options(**PARQUET_OPTIONS)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_date")
        .parquet(path)
    )


def write_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace only the ``partition_col`` partitions present in ``df`` (dynamic
    partition overwrite); other partitions are untouched."""
    (
        df.write.mode("overwrite").options(**PARQUET_OPTIONS)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def archive_files(spark: SparkSession, files: list[str], archive_dir: str, root: str | None = None,
                  threads: int = 16) -> int:
    """SNK-3: move consumed landing files to ``archive_dir`` (call only after the
    bronze write committed). Paths below ``root`` keep their relative folders, so part
    files of different partitions never collide. The moves are independent metadata
    operations (a copy on object stores), so a few driver threads issue them; only
    file names pass through the driver. Returns the number moved."""
    from concurrent.futures import ThreadPoolExecutor

    root_uri = None
    if root is not None:
        fs_root, hroot, _ = _fs(spark, root)
        root_uri = fs_root.makeQualified(hroot).toUri().getPath().rstrip("/") + "/"

    def move(f: str) -> int:
        fs, src, jvm = _fs(spark, f)
        if not fs.exists(src):
            return 0
        src_path = fs.makeQualified(src).toUri().getPath()
        rel = src_path[len(root_uri):] if root_uri and src_path.startswith(root_uri) else src.getName()
        dst = jvm.org.apache.hadoop.fs.Path(archive_dir.rstrip("/") + "/" + rel)
        fs.mkdirs(dst.getParent())
        if fs.exists(dst):
            raise OSError(f"archive target exists: {dst}")
        if not fs.rename(src, dst):
            raise OSError(f"could not archive {f}")
        return 1

    if not files:
        return 0
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files)))) as pool:
        return sum(pool.map(move, files))


def loose_files(spark: SparkSession, folder: str) -> list[str]:
    """Landed files directly in a folder (the original layout), by listing."""
    fs, root, _ = _fs(spark, folder)
    if not fs.exists(root):
        return []
    return [s.getPath().toString() for s in fs.listStatus(root)
            if s.isFile() and s.getPath().getName().endswith(".json") and not s.getPath().getName().startswith(("_", "."))]


def claim_landing(spark: SparkSession, landing: str, inflight: str) -> None:
    """Move what has landed so far to ``inflight``: folders by one rename a day, loose files one
    by one. What a failed run left there stays and is joined by the new files."""
    fs, root, _ = _fs(spark, landing)
    if not fs.exists(root):
        return
    days = [s.getPath().getName()[len("ingest_date="):] for s in fs.listStatus(root)
            if s.isDirectory() and s.getPath().getName().startswith("ingest_date=")]
    archive_days(spark, landing, inflight, days)
    archive_files(spark, loose_files(spark, landing), inflight, root=landing)


def archive_days(spark: SparkSession, landing: str, archive: str, days: list[str]) -> int:
    """SNK-3 for our landing layout: move whole ``ingest_date=<day>`` folders, one rename a
    day however many files it holds. A day that is in the archive already gets the new files
    beside the old ones (``archive_files``). Returns the number of days moved."""
    moved = 0
    for day in days:
        fs, src, jvm = _fs(spark, f"{landing.rstrip('/')}/ingest_date={day}")
        if not fs.exists(src):
            continue
        dst = jvm.org.apache.hadoop.fs.Path(f"{archive.rstrip('/')}/ingest_date={day}")
        fs.mkdirs(dst.getParent())
        if fs.exists(dst):
            files = [s.getPath().toString() for s in fs.listStatus(src) if not s.getPath().getName().startswith(("_", "."))]
            archive_files(spark, files, archive, root=landing)
            fs.delete(src, True)
        elif not fs.rename(src, dst):
            raise OSError(f"could not archive {src}")
        moved += 1
    return moved


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """SNK-4/SNK-5: write to a sibling staging path, then swap it into place.

    Readers see the old or the new table. A static overwrite of a path that the plan
    itself reads would delete its own input, so silver merges must go through here."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("errorifexists").format(fmt).options(**(PARQUET_OPTIONS if fmt == "parquet" else {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(staging)
    fs, target, jvm = _fs(spark, path)
    staged = jvm.org.apache.hadoop.fs.Path(staging)
    old = None
    if fs.exists(target):
        old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
        if not fs.rename(target, old):
            raise OSError(f"could not move {path} aside")
    if not fs.rename(staged, target):
        if old is not None:
            fs.rename(old, target)
        raise OSError(f"could not publish {staging} to {path}")
    if old is not None:
        fs.delete(old, True)


CURRENT = "_CURRENT"


def publish_version(df: DataFrame, path: str, fmt: str = "parquet", keep: int = 2,
                    partition_by: list[str] | None = None) -> str:
    """SNK-4/SNK-5 for object stores, where a folder rename is a copy: write the table
    to ``<path>/v=<n>`` and then overwrite the one-line pointer ``<path>/_CURRENT``.
    A single small object write is atomic, so readers (``read_current``) see the old or
    the new version. Versions older than the ``keep`` newest are removed afterwards.
    Returns the new version's path."""
    spark = df.sparkSession
    fs, root, jvm = _fs(spark, path)
    versions = _versions(fs, root)
    version = (max(versions) + 1) if versions else 0
    target = f"{path.rstrip('/')}/v={version}"
    writer = df.write.mode("errorifexists").format(fmt).options(**(PARQUET_OPTIONS if fmt == "parquet" else {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(target)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{CURRENT}")
    out = fs.create(pointer, True)
    try:
        out.write(bytearray(f"v={version}\n".encode()))
    finally:
        out.close()
    for old in sorted(versions)[: max(0, len(versions) + 1 - keep)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/v={old}"), True)
    return target


def _versions(fs, root) -> list[int]:
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            out.append(int(name[2:]))
    return out


def current_version_path(spark: SparkSession, path: str) -> str:
    """The folder ``_CURRENT`` points at."""
    fs, root, jvm = _fs(spark, path)
    pointer = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{CURRENT}")
    stream = fs.open(pointer)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        name = reader.readLine().strip()
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name}"


def read_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read the version a ``publish_version`` table currently points at."""
    return spark.read.format(fmt).load(current_version_path(spark, path))


# Empty strings are written as "" and nulls as nothing, white space stays, and every
# text is read back as it was.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "multiLine": "true", "emptyValue": '""', "nullValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def export_csv(df: DataFrame, path: str) -> None:
    """SNK-6: spreadsheet export, re-aimed as headered CSV (one folder of parts).
    Fields with quotes or line breaks are quoted, so whole texts survive."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv_export(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an ``export_csv`` folder back with its schema. The reader takes an empty string for
    the null it is configured with, so quoted empty fields come as a NUL character first."""
    rows = spark.read.schema(schema).options(**CSV_OPTIONS | {"emptyValue": "\x00"}).csv(path)
    texts = {f.name for f in schema.fields if f.dataType.simpleString() == "string"}
    return rows.select(*(
        F.when(F.col(c) == "\x00", F.lit("")).otherwise(F.col(c)).alias(c) if c in texts else F.col(c) for c in rows.columns
    ))
