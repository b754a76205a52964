"""Approximate nearest neighbours (largest inner product) by shifted Hilbert curves.

Vectors are scaled by the largest length and get one more component that makes them unit vectors, so the largest inner product
is the smallest distance. Several curves order them: each curve has a random projection to a few dimensions, a random
shift of its grid, and cuts into blocks of about equal numbers. A query is compared with all vectors of its own block and
of ``reach`` blocks on either side along every curve; the curves' finds are merged and reranked by the exact inner
product of the original vectors in double precision.

Every vector is in the index; only the grids and cuts are fitted on a sample of ``SAMPLE`` vectors. Equal vectors are one
entry with their ``k + 1`` smallest ids (no more can be among the ``k`` nearest), so a vector that a third of the rows have is no
hot key; each task merges its own before the shuffle. Keys on a curve are refined by a hash, so other vectors with
equal keys spread over blocks. A block holds ``rows / blocks`` vectors, with blocks growing with the rows beyond
``BLOCKS * BLOCK_ROWS``.

``reach`` is a share of the blocks because it has to be: recall depends on the share of the curve that is searched. Vectors
without structure (64 independent components) need most of it for a recall of 0.9; ``SHARE`` is set for them.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, and neither do vectors whose
number of components isn't the most frequent one (ties: the larger). Rows with a null id take no part. Repeated rows count once; an id
with several vectors asks with each and is never its own neighbour. Ties in score go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docforge.llm import hilbert
from docforge.llm.common import mix64, partitions, stored, tidy

CURVES, DIMS, BITS = 8, 3, 10
BLOCKS, BLOCK_ROWS, LEAST_ROWS = 32, 20_000, 128
#: Share of the blocks that a query is compared with on either side of its own.
SHARE = 0.1
SAMPLE = 4096


@dataclass(frozen=True)
class Curves:
    """Projections, grids and cuts; of bounded size, fitted on a sample."""

    scale: float
    blocks: int
    reach: int
    axes: np.ndarray  # (curves, components + 1, DIMS)
    low: np.ndarray  # (curves, DIMS)
    high: np.ndarray
    cuts: np.ndarray  # (curves, blocks - 1)

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors whose distances order as the inner products do."""
        if query:
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            return np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        x = x / self.scale
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))], axis=1)

    def keys(self, lifted: np.ndarray, salt: np.ndarray, curve: int) -> np.ndarray:
        cells = hilbert.grid(lifted @ self.axes[curve], self.low[curve], self.high[curve], BITS)
        return (hilbert.keys(cells, BITS) << 20) | (mix64(salt.astype(np.uint64)) >> np.uint64(44)).astype(np.int64)

    def block(self, lifted: np.ndarray, salt: np.ndarray, curve: int) -> np.ndarray:
        return np.searchsorted(self.cuts[curve], self.keys(lifted, salt, curve), "right")


def fit(sample: np.ndarray, salt: np.ndarray, longest: float, rows: int, seed: int = 7) -> Curves:
    blocks = max(1, min(rows // LEAST_ROWS, max(BLOCKS, -(-rows // BLOCK_ROWS))))
    rng = np.random.default_rng(seed)
    width = sample.shape[1] + 1
    axes = np.stack([np.linalg.qr(rng.standard_normal((width, DIMS)))[0] for _ in range(CURVES)])
    empty = Curves(longest, blocks, max(1, round(SHARE * blocks)), axes, np.zeros(0), np.zeros(0), np.zeros(0))
    lifted = empty.lifted(sample, False)
    points = np.stack([lifted @ a for a in axes])
    middle, spread = points.mean(axis=1), np.maximum(points.std(axis=1), 1e-9)
    # a box of twice the size of nearly all points, moved at random, so that curves turn at different places
    shift = rng.random((CURVES, DIMS))
    low = middle - 3 * spread - 6 * spread * shift
    grid = Curves(longest, blocks, empty.reach, axes, low, low + 12 * spread, np.zeros(0))
    at = [len(sample) * k // blocks for k in range(1, blocks)]
    cuts = np.stack([np.sort(grid.keys(lifted, salt, c))[at] for c in range(CURVES)])
    return Curves(longest, blocks, empty.reach, axes, low, low + 12 * spread, cuts)


def _matrix(data: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(data), "<f8").reshape(len(data), -1)


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """``entry`` (smallest id), ``vector`` (binary of doubles), and ``ids``, the ``k + 1`` smallest ids, of every distinct vector."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[bytes, list[int]] = {}
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.asarray(v, "<f8") + 0.0  # so that -0.0 equals 0.0
                if np.isfinite(x).all() and x.any():
                    held.setdefault(x.tobytes(), []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()),
                                              pa.array([sorted(set(i))[: k + 1] for i in held.values()], pa.list_(pa.int64()))],
                                             names=["vector", "ids"])

    width = vectors.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    sound = vectors.where((F.size("v") == (width["width"] if width else 0)) & ~F.exists("v", lambda x: x.isNull()))
    parts = sound.mapInArrow(tidy(own), "vector binary, ids array<long>")
    return (parts.groupBy("vector").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
            .select(F.col("ids")[0].alias("entry"), "vector", "ids"))


def nearest(vectors: DataFrame, queries: F.Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` nearest rows found of every row that the
    condition ``queries`` (on the id column's name) picks, without the row itself."""
    spark = vectors.sparkSession
    parts = partitions(spark)
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("q"))
    rows = rows.where("v is not null")
    entries = stored(distinct_vectors(rows.select("id", "v"), k), "entries")

    def binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([(np.asarray(v, "<f8") + 0.0).tobytes() for v in b.column(1).to_pylist()],
                                                                    pa.binary())], names=["query_id", "vector"])

    # the ids that ask, by the entry of their vector; a null component makes a vector that is no entry's
    asking = (rows.where("q").where(~F.exists("v", lambda x: x.isNull())).select("id", "v").mapInArrow(tidy(binary), "query_id long, vector binary")
              .join(entries.select("entry", "vector"), "vector").select("query_id", "entry").distinct())
    asking = stored(asking, "asking")
    asked = asking.select("entry").distinct().withColumn("asks", F.lit(True))
    table = entries.select("entry", "vector").join(asked, "entry", "left")

    count = entries.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.orderBy(F.xxhash64("entry")).limit(SAMPLE).select("entry", "vector").collect()  # of bounded size

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([np.linalg.norm(_matrix(b.column(0).to_pylist()), axis=1).max()])], names=["m"])

    longest = entries.select("vector").mapInArrow(tidy(lengths), "m double").agg(F.max("m")).first()[0]
    curves = fit(_matrix([r["vector"] for r in sample]), np.array([r["entry"] for r in sample]), longest * (1 + 1e-12), count)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each batch's vectors by curve and block: its entries, and copies of its queries for the blocks in reach."""
        reach = np.arange(-curves.reach, curves.reach + 1) if 2 * curves.reach + 1 < curves.blocks else np.arange(curves.blocks)
        for b in batches:
            if not b.num_rows:
                continue
            entry, data = b.column(0).to_numpy(), b.column(1).to_pylist()
            x = _matrix(data)
            out = []
            for query, use in ((False, np.arange(len(x))), (True, np.flatnonzero(b.column(2).fill_null(False).to_numpy(zero_copy_only=False)))):
                if not len(use):
                    continue
                lifted = curves.lifted(x[use], query)
                for c in range(CURVES):
                    at = curves.block(lifted, entry[use], c)
                    near = (at[:, None] + reach) % curves.blocks if query else at[:, None]
                    cell, who = near.ravel(), np.repeat(use, near.shape[1])
                    by = np.argsort(cell, kind="stable")
                    cell, who = cell[by], who[by]
                    edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
                    for s, e in zip(edge[:-1], edge[1:]):
                        out.append((c * curves.blocks + int(cell[s]), query, entry[who[s:e]].astype("<i8").tobytes(), x[who[s:e]].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.bool_()),
                                              pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.binary())],
                                             names=["cell", "query", "entries", "vectors"])

    def compare(t: pa.Table) -> pa.Table:
        """The best entries of a block for each of its queries."""
        query = t["query"].to_numpy(zero_copy_only=False)
        ids, data = t["entries"].to_pylist(), t["vectors"].to_pylist()
        side = lambda q: (np.frombuffer(b"".join(i for i, m in zip(ids, query) if m == q), "<i8"),
                          np.frombuffer(b"".join(d for d, m in zip(data, query) if m == q), "<f8"))
        (qi, qx), (ei, ex) = side(True), side(False)
        rows_out: list[tuple[int, bytes, bytes]] = []
        if len(qi) and len(ei):
            qx, ex = qx.reshape(len(qi), -1), ex.reshape(len(ei), -1)
            for s in range(0, len(qi), 256):
                score = qx[s : s + 256] @ ex.T
                least = np.partition(score, -min(k + 1, len(ei)), axis=1)[:, -min(k + 1, len(ei))]
                for r, (row, bound) in enumerate(zip(score, least)):
                    good = np.flatnonzero(row >= bound)
                    good = good[np.lexsort((ei[good], -row[good]))][: k + 1]
                    rows_out.append((int(qi[s + r]), ei[good].astype("<i8").tobytes(), row[good].astype("<f8").tobytes()))
        return pa.table([pa.array([r[0] for r in rows_out], pa.int64()), pa.array([r[1] for r in rows_out], pa.binary()),
                         pa.array([r[2] for r in rows_out], pa.binary())], names=["query", "entries", "scores"])

    def merge(t: pa.Table) -> pa.Table:
        """The best entries of all curves for each query."""
        entries_of = [np.frombuffer(x.as_buffer(), "<i8") for x in t["entries"]]
        count = np.fromiter(map(len, entries_of), np.int64, len(entries_of))
        query = np.repeat(t["query"].to_numpy(), count)
        entry = np.concatenate(entries_of)
        score = np.concatenate([np.frombuffer(x.as_buffer(), "<f8") for x in t["scores"]])
        by = np.lexsort((-score, entry, query))  # one score of an entry, though two blocks may round it differently
        query, entry, score = query[by], entry[by], score[by]
        one = np.concatenate([[True], (query[1:] != query[:-1]) | (entry[1:] != entry[:-1])])
        query, entry, score = query[one], entry[one], score[one]
        by = np.lexsort((entry, -score, query))
        query, entry, score = query[by], entry[by], score[by]
        first = np.searchsorted(query, query)
        keep = np.arange(len(query)) - first <= k
        return pa.table([query[keep], entry[keep], score[keep]], names=["query", "entry", "score"])

    found = (table.mapInArrow(tidy(deal), "cell long, query boolean, entries binary, vectors binary").groupBy("cell")
             .applyInArrow(tidy(compare), "query long, entries binary, scores binary")
             .withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts))).groupBy("part")
             .applyInArrow(tidy(lambda t: merge(t.drop_columns("part"))), "query long, entry long, score double"))
    # entries back to rows: the k + 1 best rows of each asking entry, then each asking row without itself
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    candidates = (found.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
                  .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1))
    mine = Window.partitionBy("query_id", "entry").orderBy("place")
    return (asking.join(candidates, asking["entry"] == candidates["query"]).where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
