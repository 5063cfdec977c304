"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame`` with an
optional DuckDB oracle SQL over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: str | None
    operators: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def register(name: str, operators: tuple[str, ...] | str = (), oracle: str | None = None):
    ops = (operators,) if isinstance(operators, str) else tuple(operators)

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = Query(name, fn, oracle, ops)
        return fn

    return deco
