"""Registry of the named queries exposed through ``__spark_entry__``.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that computes the same rows from the same Parquet tables (or
``None`` where no SQL twin exists and a brute-force test covers it).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None, ops: tuple[str, ...] = ()):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn

    return wrap
