"""Call log: per-call enrichment and per-request summary (AGG-5, RPT-13, SCL-8, UDF-4).

A call record is ``(request, operation, duration_ms, hits, error, ops)``.
The summary is one group-by with algebraic aggregates (count, sum,
count_if), so a request with a huge number of calls is combined map-side.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docforge.sources.tables import small_frame

CALL_SCHEMA = ("request string, operation string, index string, duration_ms double, took_ms double, hits long, ops long, "
               "aggregations array<string>, error string")


class CallRecorder:
    """Records the calls made to a store (UDF-4, RPT-13): one row each, with the whole duration, the time of the
    Spark job in it (``took_ms``), hits of a search, operations of a bulk write, aggregation names and the error.

    A store takes a recorder and reports its own actions; searches run through :meth:`search`. Rows are kept until
    ``save`` appends them to the call log and starts anew.
    """

    def __init__(self, spark: SparkSession, request: str) -> None:
        self.spark, self.request = spark, request
        self.rows: list[dict] = []

    @contextmanager
    def call(self, operation: str, index: str, aggregations: tuple[str, ...] = ()) -> Iterator[dict]:
        row = {"request": self.request, "operation": operation, "index": index, "aggregations": list(aggregations)}
        start = time.perf_counter()
        try:
            yield row
        except Exception as exc:
            row["error"] = type(exc).__name__
            raise
        finally:
            row["duration_ms"] = (time.perf_counter() - start) * 1000
            self.rows.append(row)

    def search(self, index: str, found: DataFrame, aggregations: tuple[str, ...] = ()) -> list:
        """Run a search and return its rows (a page or aggregation, bounded by the request); hits are observed in its one job."""
        observation = Observation(f"{index}_hits_{len(self.rows)}")
        with self.call("search", index, aggregations) as row:
            start = time.perf_counter()
            out = found.observe(observation, F.count(F.lit(1)).alias("hits")).collect()
            row["took_ms"] = (time.perf_counter() - start) * 1000
            row["hits"] = int(observation.get.get("hits", 0))
        return out

    def frame(self) -> DataFrame:
        names = [part.split()[0] for part in CALL_SCHEMA.split(", ")]
        return small_frame(self.spark, [tuple(r.get(n) for n in names) for r in self.rows], CALL_SCHEMA)

    def save(self, path: str) -> None:
        """Append the rows to the call log under ``path`` (a folder of the shared storage)."""
        self.frame().write.mode("append").parquet(path)
        self.rows = []


def bulk_op_count(body_lines: Column, deletes: Column) -> Column:
    """RPT-13: operations in a bulk body. Index/update actions take two lines
    (action + source), deletes one -- so ``(lines - deletes) / 2 + deletes``."""
    return ((body_lines - deletes) / 2 + deletes).cast("bigint")


def summarize(calls: DataFrame, by: list[str]) -> DataFrame:
    """AGG-5: calls, total duration, errors, zero-hit searches (null hits do
    not count) and the status ladder: red on errors, yellow on empty
    searches, else none."""
    errors = F.count_if(F.col("error").isNotNull())
    empty = F.count_if((F.col("operation") == "search") & (F.col("hits") == 0))
    out = calls.groupBy(*by).agg(
        F.count("*").alias("calls"),
        F.sum(F.col("duration_ms").cast("decimal(20,6)")).cast("decimal(20,2)").alias("duration_ms"),
        errors.alias("errors"), empty.alias("empty_searches"))
    status = F.when(F.col("errors") > 0, "red").when(F.col("empty_searches") > 0, "yellow").otherwise("none")
    return out.withColumn("status", status)
