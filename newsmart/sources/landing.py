"""Landing zone reader (SRC-1, SRC-2, SRC-5).

A landing record is one response envelope ``{status, totalResults, articles:[...]}``.
Two layouts are read:

* our writer's layout, ``<root>/ingest_date=<d>/part-*.json``: JSON Lines, one envelope
  per line carrying its own ``window_start`` and ``page``; a few files per landing day
  however many windows and pages were fetched;
* the original layout, ``<root>/<date>.json`` or ``<root>/<date> (Page <n>).json``, one
  indented envelope per file, where window and page come from the file name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsmart.schemas import ARTICLE_COLUMNS, landing_record

# Fixed value: the original landing file-name format, "<date>.json" or
# "<date> (Page <n>).json".
FILE_NAME_PATTERN = r"(\d{4}-\d{2}-\d{2})(?: \(Page (\d+)\))?\.json$"


def read_envelopes(
    spark: SparkSession, path: str, multi_line: bool = False, extra_fields: list[T.StructField] | None = None
) -> DataFrame:
    """Landing envelopes; an empty folder gives zero rows (explicit schema).

    ``multi_line=False`` reads JSON Lines (our writer: one envelope per line, files
    splittable); ``True`` reads one indented document per file (the original files).
    ``extra_fields`` are article keys beyond the schema; they pass through to silver."""
    return (
        spark.read.schema(landing_record(extra_fields))
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", False)
        .json(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )


def with_provenance(envelopes: DataFrame) -> DataFrame:
    """SRC-5: ``window_start`` and ``page`` from the record itself, or else from the
    (URL-encoded) original file name, whose window starts at midnight; a file without a
    page number is page 1."""
    name = F.url_decode(F.col("_file"))
    raw_date = F.regexp_extract(name, FILE_NAME_PATTERN, 1)
    raw_page = F.regexp_extract(name, FILE_NAME_PATTERN, 2)
    from_name_start = F.when(raw_date != "", F.to_date(raw_date).cast("timestamp_ntz"))
    from_name_page = F.when(raw_page != "", raw_page.cast("int")).otherwise(F.lit(1))
    out = envelopes
    if "window_start" in out.columns:
        out = out.withColumn("window_start", F.coalesce(F.col("window_start"), from_name_start))
    else:
        out = out.withColumn("window_start", from_name_start)
    if "page" in out.columns:
        out = out.withColumn("page", F.coalesce(F.col("page"), from_name_page))
    else:
        out = out.withColumn("page", from_name_page)
    return out


def explode_articles(envelopes: DataFrame) -> DataFrame:
    """SRC-1 / SET-1: one row per article; a missing or empty ``articles`` gives no rows.
    Envelope attributes ride along as columns."""
    keep = [c for c in envelopes.columns if c not in ("articles", "status")]
    further = [c for c in envelopes.schema["articles"].dataType.elementType.names if c not in ARTICLE_COLUMNS]
    return envelopes.select(*keep, F.inline("articles")).select(
        *ARTICLE_COLUMNS, *further, *[c for c in keep if c not in ARTICLE_COLUMNS]
    )


def read_landing(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Articles of every landing file under ``path`` with ``window_start``, ``page``,
    ``totalResults`` and ``_file``."""
    return explode_articles(with_provenance(read_envelopes(spark, path, multi_line)))

