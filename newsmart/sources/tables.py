"""Parquet table readers (SRC-3, SRC-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.schemas import STRAY_INDEX_COLUMNS


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """SRC-4: a parquet table; a pandas index column left in old files is dropped.
    ``merge_schema`` reads columns that only some partitions have (it opens every footer)."""
    df = spark.read.option("pathGlobFilter", "*.parquet").option("mergeSchema", merge_schema).parquet(path)
    return df.drop(*[c for c in STRAY_INDEX_COLUMNS if c in df.columns])


def latest_partition(df: DataFrame, col: str = "load_date") -> DataFrame:
    """SRC-3: rows of the newest partition. ``max`` is a scalar subquery, so on a table
    partitioned by ``col`` the filter prunes partitions at run time."""
    newest = df.select(F.max(col)).scalar()
    return df.filter(F.col(col) == newest)


def partition_values(spark: SparkSession, path: str, col: str) -> list[str]:
    """Values of partition column ``col`` from the folder names under ``path``
    (``col=<value>``): a metadata listing, one entry per partition, no file opened."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    prefix = f"{col}="
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix):
            out.append(jvm.java.net.URLDecoder.decode(name[len(prefix):], "UTF-8"))
    return out


def latest_partition_value(spark: SparkSession, path: str, col: str = "load_date") -> str | None:
    """Newest value of partition column ``col`` by folder listing. Integer values
    compare as numbers; others (ISO dates) as text."""
    values = [v for v in partition_values(spark, path, col) if v != "__HIVE_DEFAULT_PARTITION__"]
    if not values:
        return None
    numeric = all(v.lstrip("-").isdigit() for v in values)
    return max(values, key=int) if numeric else max(values)


def read_partition(spark: SparkSession, path: str, col: str, value: str) -> DataFrame:
    """One partition of a stored table, by a literal filter (static pruning)."""
    df = read_table(spark, path)
    return df.filter(F.col(col) == F.lit(value).cast(df.schema[col].dataType))


def read_latest_partition(spark: SparkSession, path: str, col: str = "load_date") -> DataFrame:
    """SRC-3 for a stored table: the newest ``col`` partition, found by listing folder
    names and read with a literal filter, so only that partition's files are opened."""
    newest = latest_partition_value(spark, path, col)
    if newest is None:
        return read_table(spark, path).limit(0)
    return read_partition(spark, path, col, newest)



def read_latest_written(spark: SparkSession, path: str, col: str = "load_date") -> DataFrame:
    """SRC-3 by modification time: the ``col`` partition that holds the youngest file (ties by path),
    whatever its name. Files are listed by Spark's file source, of which no content is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    folder = F.regexp_extract("path", rf"/{col}=([^/]*)/", 1)
    files = listed.select(folder.alias("value"), "modificationTime", "path").filter("value != ''")
    newest = files.orderBy(F.desc("modificationTime"), F.desc("path")).limit(1).collect()
    if not newest:
        return read_table(spark, path).limit(0)
    value = spark.sparkContext._jvm.java.net.URLDecoder.decode(newest[0]["value"].replace("+", "%2B"), "UTF-8")
    return read_partition(spark, path, col, value)
