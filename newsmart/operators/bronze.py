"""Bronze layer: landing articles + load date, deduplicated (PRJ-1, DST-1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.schemas import ARTICLE_COLUMNS

DEDUP_KEYS = ("title", "publishedAt")
# Which copy of a duplicate is "first": earliest window, then page, then URL; equal ones
# by a digest of their other columns (``tie_break``), so the choice never depends on the
# input's order, and the shuffle carries 32 characters for it instead of the texts.
DEDUP_ORDER = ("window_start", "page", "url")
PROVENANCE = ("window_start", "page", "totalResults", "_file", "_file_mtime", "ingest_date", "batch_id")


def add_load_date(df: DataFrame, load_date: dt.date | str | Column | None = None) -> DataFrame:
    """PRJ-1: constant load date. An explicit date makes reruns repeatable; without
    one an existing ``load_date`` column is kept, else today is used."""
    if load_date is None:
        if "load_date" in df.columns:
            return df
        value = F.current_date()
    elif isinstance(load_date, Column):
        value = load_date.cast("date")
    else:
        value = F.lit(str(load_date)).cast("date")
    return df.withColumn("load_date", value)


def tie_break() -> Column:
    """A digest of an article's columns; nulls count as absent."""
    parts = [F.col("source.id"), F.col("source.name"), *(F.col(c) for c in ARTICLE_COLUMNS if c not in ("source", "url"))]
    return F.md5(F.concat_ws("\x1f", *parts).cast("binary"))


def keep_first(df: DataFrame, keys=DEDUP_KEYS, order=DEDUP_ORDER, ties: Column | None = None) -> DataFrame:
    """DST-1: one row per key, nulls compare equal, the first by ``order``, then ``ties``, kept.

    ``row_number() = 1`` plans as a partial ``WindowGroupLimit`` before the shuffle, so
    a hot key is cut to one row per map task before it is exchanged."""
    order_cols = [F.asc_nulls_last(c) for c in order if c in df.columns]
    columns = df.columns
    if ties is not None:
        df = df.withColumn("_tie", ties)
        order_cols.append(F.asc("_tie"))
    if not order_cols:
        raise ValueError("keep_first needs at least one ordering column present")
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).select(*columns)


def to_bronze(
    landing: DataFrame,
    load_date: dt.date | str | Column | None = None,
    keep_provenance: bool = False,
) -> DataFrame:
    """Landing articles -> bronze rows (article columns + ``load_date``)."""
    df = keep_first(add_load_date(landing, load_date), ties=tie_break())
    extra = [c for c in df.columns if c not in ARTICLE_COLUMNS and c != "load_date"]
    if not keep_provenance:
        extra = [c for c in extra if c not in PROVENANCE]
    return df.select(*ARTICLE_COLUMNS, *extra, "load_date")


def flatten_source(bronze: DataFrame) -> DataFrame:
    """Bronze with ``source`` as two flat columns (for display and oracle checks)."""
    cols = [c for c in bronze.columns if c != "source"]
    return bronze.select(
        F.col("source.id").alias("source_id"), F.col("source.name").alias("source_name"), *cols
    )
