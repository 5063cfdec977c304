"""Silver layer: clean, date-split and flatten bronze; merge with the existing table
(FLT-1, NUL-1, DAT-1..5, PRJ-2/3, SET-2, DST-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmart.functions import dates, fill_author
from newsmart.operators.bronze import PROVENANCE, keep_first

# Fixed value: the title the API puts on withdrawn articles.
REMOVED_TITLE = "[Removed]"

# So many digests of repeated rows are named in a filter; beyond them all rows are shuffled.
FEW_COPIES = 1000

_BRONZE_NAMED = {
    "source", "author", "title", "description", "url", "urlToImage", "publishedAt",
    "content", "load_date",
}


def drop_removed(df: DataFrame) -> DataFrame:
    """FLT-1: drop ``[Removed]`` titles; null titles stay (null-safe comparison)."""
    return df.filter(~F.col("title").eqNullSafe(F.lit(REMOVED_TITLE)))


def to_silver(bronze: DataFrame, lenient: bool = False) -> DataFrame:
    """Bronze -> silver.

    ``publishedAt`` becomes the UTC calendar date of the instant, with ``year``,
    ``month`` and ``day`` beside it; ``source`` is flattened to ``source_id`` and
    ``source_name``; a null author becomes ``'Não Informado'``. Malformed timestamps
    raise unless ``lenient`` (then they become null)."""
    df = drop_removed(bronze)
    published = dates.utc_date(dates.parse_timestamp("publishedAt", lenient))
    passthrough = [c for c in df.columns if c not in _BRONZE_NAMED and c not in PROVENANCE]
    staged = df.select(
        fill_author("author").alias("author"),
        "title", "description", "url", "urlToImage",
        published.alias("publishedAt"),
        "content", *passthrough, "load_date",
        F.col("source.id").alias("source_id"),
        F.col("source.name").alias("source_name"),
    )
    return staged.select(
        "author", "title", "description", "url", "urlToImage", "publishedAt", "content",
        *passthrough, "load_date",
        dates.year("publishedAt").alias("year"),
        dates.month("publishedAt").alias("month"),
        dates.day("publishedAt").alias("day"),
        "source_id", "source_name",
    )


def merge_silver(new: DataFrame, existing: DataFrame | None, dedup_keys: list[str] | None = None) -> DataFrame:
    """SET-2 + DST-2: union by name (missing columns -> null), then drop duplicates.

    Default: whole-row duplicates, ``load_date`` included (an article loaded on two
    days stays twice, as in the reference). Without an existing table the new rows are
    taken as they are (SURVEY Q6), which also saves shuffling every text. With
    ``dedup_keys`` one row per key is kept, the earliest ``load_date`` first."""
    merged = new if existing is None else new.unionByName(existing, allowMissingColumns=True).dropDuplicates()
    if dedup_keys:
        merged = keep_first(merged, keys=tuple(dedup_keys), order=("load_date", "url", *(c for c in merged.columns if c not in ("load_date", "url"))))
    return merged


def drop_copies(df: DataFrame) -> DataFrame:
    """DST-2 where copies are few: whole-row duplicates dropped, as ``dropDuplicates`` does. Rows are told
    apart by a 64-bit digest first; only those whose digest another row has too are compared, so that
    the other texts stay where they are. With more than ``FEW_COPIES`` such digests all rows are compared."""
    rows = df.withColumn("_digest", F.xxhash64(*df.columns))
    repeated = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    few = [r[0] for r in repeated.select("_digest").limit(FEW_COPIES + 1).collect()]
    if len(few) > FEW_COPIES:
        return df.dropDuplicates()
    if not few:
        return df
    copy = F.col("_digest").isin(few)
    return rows.filter(~copy).drop("_digest").unionByName(rows.filter(copy).drop("_digest").dropDuplicates())
