"""Shared pieces of the llm operators: tables, scratch storage, column checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.session import scratch_path

#: The white space that separates words in every contract: space and U+0009 to U+000D.
WORD_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    This cuts the lineage like a checkpoint does (any executor may be lost
    afterwards), but the copy is compressed and columnar, and the planner knows
    its size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete stored tables that nothing reads any more (their files, by Hadoop)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


#: Columns that tell documents apart when ids are null or repeated: 128 bits of id and text.
IDENTITY = ["_k1", "_k2"]


def identity(doc_id: str = "doc_id", text: str = "text") -> list:
    return [F.xxhash64(doc_id, text).alias("_k1"), F.xxhash64(text, doc_id, F.lit(1)).alias("_k2")]


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts have about ``most`` bytes (one row at
    least), so that what a task holds does not grow with the texts' lengths."""
    for batch in batches:
        sizes = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(text)], np.int64)
        of = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if e > s:
                yield batch.slice(s, e - s)
