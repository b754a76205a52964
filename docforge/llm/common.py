"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.session import scratch

#: Rows in one Arrow batch handed to a Python task. Texts can be long, so the row count is kept small; the
#: functions below gather batches up to a number of characters of their own.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the Arrow batch size of the session, so that a batch of long texts fits in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_keys(spark: SparkSession, count: int) -> list[int]:
    """``count`` longs whose Spark hash deals them over ``count`` partitions, one each.

    Rows that carry key ``k`` of the list land in hash partition ``k``, so groups of about equal size
    become tasks of about equal size. Only a matter of balance: any distinct keys would be right.
    """
    # about count * ln(count) draws hit every partition; take four times as many
    draws = max(64, int(4 * count * (np.log(count + 1) + 1)))
    rows = (spark.range(draws).select("id", F.pmod(F.hash(F.col("id")), F.lit(count)).alias("part"))
            .groupBy("part").agg(F.min("id").alias("id")).collect())  # one row a partition
    keys = {r["part"]: r["id"] for r in rows}
    spare = iter(range(draws, draws + count))
    return [keys[i] if i in keys else next(spare) for i in range(count)]


@lru_cache(maxsize=1)
def _trim():
    """The C library's call that gives freed memory back to the system, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: None


#: What a worker keeps from task to task: name -> cached function. Filled by the modules that have such tables.
KEPT: dict[str, Callable] = {}


def begin(uses: tuple[str, ...]) -> None:
    """Give up the tables that earlier tasks of other operators left in this worker."""
    for name, cached in KEPT.items():
        if name not in uses:
            cached.cache_clear()


def tidy(task: Callable, uses: tuple[str, ...] = ()) -> Callable:
    """A task function before which the worker gives up tables it doesn't use (all but ``uses``), and after which it gives its
    freed memory back: workers live on between tasks and stages, and what they hold counts against the executor."""
    def start() -> None:
        from docforge.llm import common  # the worker's own module, not a copy sent with the task

        common.begin(uses)

    def release() -> None:
        pa.default_memory_pool().release_unused()
        _trim()(0)

    if inspect.isgeneratorfunction(task):
        def run(*args):
            start()
            try:
                yield from task(*args)
            finally:
                release()
    elif len(inspect.signature(task).parameters) == 2:
        def run(left, right):
            start()
            try:
                return task(left, right)
            finally:
                release()
    else:
        def run(table):
            start()
            try:
                return task(table)
            finally:
                release()
    return run


def text_batches(batches: Iterable[pa.RecordBatch], chars: int, text: str = "text") -> Iterator[pa.Table]:
    """Arrow batches joined, or cut, so that each holds about ``chars`` characters of ``text`` (one row at least)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        lens = np.fromiter((len(x) if x is not None else 0 for x in col.to_pylist()), np.int64, batch.num_rows)
        start = 0
        for i, n in enumerate(lens):
            size += int(n)
            if size >= chars:
                held.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(held)
                held, size, start = [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixing of each value."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def splitmix(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


class WordHash:
    """64-bit hashes of spans of a symbol array that don't overlap: sums of mixed (symbol, place in the span) and the length.

    Symbol and place go through one non-linear mix, so no exchange of symbols cancels out, as it does in a polynomial modulo 2**64."""

    #: a fixed pseudo-random number for each place in a span; the same for all hashes of a worker
    places = np.zeros(0, np.uint64)

    def __init__(self, seed: int, symbols: int) -> None:
        self.table = splitmix(seed, symbols)

    def spans(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the ascending spans [start, end), none of them empty."""
        if not len(start):
            return np.zeros(0, np.uint64)
        length = end - start
        longest = int(length.max())
        if len(WordHash.places) < longest:
            WordHash.places = splitmix(0x9E37, longest + longest // 16 + 64)
        begin = np.cumsum(length) - length
        if int(length.sum()) == len(symbols):  # no gaps
            own, place = symbols, np.arange(len(symbols)) - np.repeat(start, length)
        else:
            at = gather(start, length)
            own, place = symbols[at], at - np.repeat(start, length)
        x = self.table[own]
        x += WordHash.places[place]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        return mix64(np.add.reduceat(x, begin) + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class SpanHash:
    """64-bit hashes of short spans of a symbol array that overlap, from prefix sums of symbol * base**position.

    For spans of some dozen symbols alone: over 1024 places and more a polynomial modulo 2**64 has exchanges of symbols that cancel out."""

    BASE = 0xD6E8FEB86659FD93

    #: base**k and its inverse for k up to the longest array so far; the same for all hashes of a worker
    power = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, seed: int, symbols: int) -> None:
        self.table = splitmix(seed, symbols)

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        n = len(symbols)
        if len(self.power) <= n:
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                values = np.full(n + n // 16 + 1, base, np.uint64)
                values[0] = 1
                setattr(SpanHash, name, np.cumprod(values, out=values))
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[symbols] * self.power[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((prefix[end] - prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def gather(offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indexes of the concatenation of the slices [offset, offset + length)."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(offset - (ends - length), length) + np.arange(total, dtype=np.int64)
