"""Explicit schemas for every medallion layer (no inference: an empty landing
folder must read as zero rows, and unknown JSON keys must not change types)."""

from __future__ import annotations

from pyspark.sql import types as T

SOURCE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)

# One article as delivered by the search API. ``url``/``urlToImage``/``language``
# are optional pass-through keys.
ARTICLE = T.StructType(
    [
        T.StructField("source", SOURCE),
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("urlToImage", T.StringType()),
        T.StructField("publishedAt", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("language", T.StringType()),
    ]
)

# One landing page file: the response envelope.
ENVELOPE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("totalResults", T.LongType()),
        T.StructField("articles", T.ArrayType(ARTICLE)),
    ]
)

# A landing line as our writer stores it: the envelope plus its provenance (the start
# of the request window, so that the hourly windows of a day stay apart, and the page
# number). Files are partitioned by ``ingest_date``, the day they were landed.
LANDING_RECORD = T.StructType(
    ENVELOPE.fields
    + [T.StructField("window_start", T.TimestampNTZType()), T.StructField("page", T.IntegerType())]
)

ARTICLE_COLUMNS = [f.name for f in ARTICLE.fields]


def landing_record(extra_fields: list[T.StructField] | None = None) -> T.StructType:
    """The landing schema, with further article keys if the source delivers any: keys that no
    schema names are not read, so those to keep must be given."""
    if not extra_fields:
        return LANDING_RECORD
    article = T.ArrayType(T.StructType(ARTICLE.fields + list(extra_fields)))
    return T.StructType([T.StructField("articles", article) if f.name == "articles" else f for f in LANDING_RECORD.fields])


BRONZE = T.StructType(ARTICLE.fields + [T.StructField("load_date", T.DateType())])

SILVER = T.StructType(
    [
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("urlToImage", T.StringType()),
        T.StructField("publishedAt", T.DateType()),
        T.StructField("content", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("load_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("source_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
    ]
)

# Columns pandas leaves behind when a frame with a non-unique index is written.
STRAY_INDEX_COLUMNS = ("__index_level_0__",)
