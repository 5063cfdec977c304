"""Analyst queries over silver and gold: row counts, rankings, head, profile
(AGG-8..11, FLT-5, TOP-1, SRT-1, LIM-1, PRF-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, keys: list[str], name: str = "quantidade") -> DataFrame:
    """Rows per key tuple; rows with any null key are dropped first (FLT-5, the
    notebook's ``groupby(...).size()``)."""
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rows_by_date(silver: DataFrame) -> DataFrame:
    """AGG-8."""
    return count_rows(silver, ["day", "month", "year"])


def rows_by_month(silver: DataFrame) -> DataFrame:
    """AGG-9."""
    return count_rows(silver, ["month"])


def rows_by_year(silver: DataFrame) -> DataFrame:
    """AGG-10."""
    return count_rows(silver, ["year"])


def top_sources(silver: DataFrame, n: int = 10) -> DataFrame:
    """AGG-11 + TOP-1: the ``n`` sources with most rows, ties by name.
    Plans as ``TakeOrderedAndProject``: each task keeps its own top n."""
    counts = count_rows(silver, ["source_name"])
    return counts.orderBy(F.desc("quantidade"), F.asc("source_name")).limit(n)


def ranked(df: DataFrame, by: str, ties: list[str]) -> DataFrame:
    """SRT-1/SRT-2: descending by ``by``, ties ascending (nulls last) on ``ties``.
    A range-partitioned global sort, not a single task."""
    return df.orderBy(F.desc(by), *[F.asc_nulls_last(c) for c in ties])


def sorted_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """SRT-3: ascending by ``keys``, nulls last, as gold tables are read and shown."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in keys])


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """LIM-1: the first ``n`` rows in a stated order (a bare ``limit`` is arbitrary)."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def profile(df: DataFrame) -> DataFrame:
    """PRF-1: ``(position, column_name, data_type, non_null, row_count)`` per column,
    from one aggregate over the table (partial counts per task, one tiny final row)."""
    cols = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(cols)],
    )
    stacked = []
    for i, f in enumerate(df.schema.fields):
        stacked += [F.lit(i), F.lit(f.name), F.lit(f.dataType.simpleString()), F.col(f"_nn{i}")]
    return counts.select(F.stack(F.lit(len(cols)), *stacked), "_rows").toDF(
        "position", "column_name", "data_type", "non_null", "row_count"
    )
