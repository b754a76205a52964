"""Token totals by source, language and tokenizer version, maintained by deltas.

A change is a signed row: an insert counts +1 document and its tokens, a delete -1 and minus the tokens that were counted, a
revised count (or a move to another source, language or tokenizer version) is one of each. Totals are sums of signed rows,
so they are the same in any order of batches, and a batch is one small aggregate, combined in every task before its shuffle:
a source that has a third of all rows is one row a task.

A batch is committed under its number. Committing a number again replaces that batch, so a batch that is repeated after a
failure, or delivered twice, counts once; a reader sees a batch when its write is finished. ``compact`` sums the batches up to a
number into a snapshot; later commits of those numbers are refused, as they would count twice.

Defined results: a null source, language or version is a group of its own. A null token count counts as 0. Groups whose documents
and tokens are both 0 are left out. Without batches there are no rows.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Counted documents (``KEYS`` and ``n_tokens``) as inserts (+1) or deletes (-1)."""
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("n_docs"), (sign * F.coalesce("n_tokens", F.lit(0))).cast("long").alias("n_tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return signed(counts, 1)


def deletes(counts: DataFrame) -> DataFrame:
    return signed(counts, -1)


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Documents counted anew: what was counted goes, what is counted now comes."""
    return signed(old, -1).unionByName(signed(new, 1))


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _folders(spark: SparkSession, path: str) -> dict[int, str]:
    """Finished folders under ``path`` by number (names only are listed; a folder is finished with its _SUCCESS file). A batch
    that was delivered again is ``<number>.<try>``; the latest try counts."""
    fs, place = _fs(spark, path)
    if not fs.exists(place):
        return {}
    found: dict[int, tuple[int, str]] = {}
    for name in (s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()):
        number, _, again = name.partition(".")
        if number.isdigit() and (not again or again.isdigit()) and fs.exists(_fs(spark, f"{path}/{name}/_SUCCESS")[1]):
            found[int(number)] = max(found.get(int(number), (-1, "")), (int(again or 0), name))
    return {n: name for n, (_, name) in sorted(found.items())}


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return list(_folders(spark, path))


def _parts(spark: SparkSession, path: str, after: int, up_to: float = float("inf")) -> list[str]:
    """Folders of the finished batches in (after, up_to]."""
    return [f"{path}/batches/{name}" for n, name in _folders(spark, f"{path}/batches").items() if after < n <= up_to]


def _sum(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


def commit(changes: DataFrame, path: str, batch: int) -> None:
    """Add the signed rows ``changes`` as batch ``batch`` (0 or more) of the rollup under ``path``; idempotent.

    The batch is written aside and renamed when it is whole. A batch delivered again takes the place of the one that is there only
    then, so whenever the job dies the totals have one of the two. One writer a batch number at a time."""
    spark = changes.sparkSession
    snapshots = _numbers(spark, f"{path}/snapshots")
    if batch < 0 or (snapshots and batch <= snapshots[-1]):
        raise ValueError(f"batch {batch} is already part of a snapshot" if batch >= 0 else "a batch has a number of 0 or more")
    aside = f"{path}/aside/{uuid.uuid4().hex}"
    _sum(changes).write.parquet(aside)
    _put(spark, aside, f"{path}/batches", batch)


def _put(spark: SparkSession, aside: str, folder: str, batch: int) -> None:
    fs, place = _fs(spark, folder)
    fs.mkdirs(place)
    own = [s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName().partition(".")[0] == str(batch)]
    tries = [int(name.partition(".")[2] or 0) for name in own]
    target = f"{folder}/{batch}.{max(tries) + 1}" if own else f"{folder}/{batch}"
    if not fs.rename(_fs(spark, aside)[1], _fs(spark, target)[1]):
        raise OSError(f"{aside} could not be moved to {target}")
    for name in own:
        fs.delete(_fs(spark, f"{folder}/{name}")[1], True)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``KEYS``, ``n_docs`` and ``n_tokens``: the newest snapshot and all finished batches after it."""
    snapshots = _numbers(spark, f"{path}/snapshots")
    last = snapshots[-1] if snapshots else -1
    parts = [f"{path}/snapshots/{last}"] * (last >= 0) + _parts(spark, path, last)
    rows = spark.read.schema(_SCHEMA).parquet(*parts) if parts else spark.createDataFrame([], _SCHEMA)
    return _sum(rows).where("n_docs <> 0 or n_tokens <> 0")


def compact(spark: SparkSession, path: str, up_to: int) -> None:
    """Sum the newest snapshot and the batches up to ``up_to`` into a snapshot. Batches stay on disk but are read no more."""
    snapshots = _numbers(spark, f"{path}/snapshots")
    last = snapshots[-1] if snapshots else -1
    if up_to <= last:
        return
    parts = [f"{path}/snapshots/{last}"] * (last >= 0) + _parts(spark, path, last, up_to)
    rows = [spark.read.schema(_SCHEMA).parquet(p) for p in parts] or [spark.createDataFrame([], _SCHEMA)]
    _sum(reduce(DataFrame.unionByName, rows)).write.mode("overwrite").parquet(f"{path}/snapshots/{up_to}")
