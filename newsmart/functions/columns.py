"""Null, struct and math column helpers (NUL-1, STC-1, MTH-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label the reference writes for a missing author.
UNKNOWN_AUTHOR = "Não Informado"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_author(col: str | Column = "author") -> Column:
    """NUL-1: null author -> ``'Não Informado'``; the empty string stays."""
    return F.coalesce(as_col(col), F.lit(UNKNOWN_AUTHOR))


def field(struct_col: str | Column, name: str) -> Column:
    """STC-1: struct field access; a null struct yields null."""
    return as_col(struct_col).getField(name)


def page_count(total: str | Column, page_size: int = 100) -> Column:
    """MTH-1: ceiling(total / page_size); 0 for a total of 0."""
    t = as_col(total).cast("long")
    return ((t + F.lit(page_size - 1)) / F.lit(page_size)).cast("long")

