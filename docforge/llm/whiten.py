"""Whitening of embeddings by an incremental eigendecomposition (see ``spectrum`` for the updates).

1. *Whole numbers.* An entry c becomes x = floor(1024 * c) + 100000, so counts, sums and deviations are exact.
2. *Spectra.* Every partition keeps the spectrum of its vectors' scatter and changes it by centred rank-one updates. Spectra of ``FAN``
   partitions are combined by rank-one updates again, until one is left; it has the exact count n and sums S of all.
3. *Rayleigh-Ritz.* The leading eigenvectors and a few more span a subspace. One pass over the rows computes what the covariance V does to
   it (each row centred on S / n before it is multiplied), the projected problem is solved, and the residuals V u - e u join the
   subspace until those of the asked components are at working precision.
4. *Whitening.* Rows are projected on the components and divided by the root of the eigenvalue; another pass measures the
   covariance of what comes out.

Matrices of the size of a vector squared go to the driver and to tasks, nothing that grows with the rows.

Defined results: vectors that are null, empty, or hold null, non-finite or huge entries (2**40 and more, which would not be exact) take
no part, nor do vectors of another length than the commonest (of equally common ones the longer). Repeated rows count each.
Components whose variance is zero to working precision (a 1e-13th of the trace) have no whitened values and are not returned; with one row, or equal
ones, there are none. A deviation beyond the range of a long is null as ``deviation``; ``deviation_exact`` (decimal) has it up to 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import stored, tidy
from docforge.llm.spectrum import Spectrum

SCALE, ORIGIN = 1024, 100_000
#: Entries from here on can't be told apart as whole numbers in doubles.
HUGE = float(1 << 40)
#: Spectra combined in one task, and rows (times the vector's length) turned into updates at once.
FAN, BLOCK = 8, 64
#: Directions of the subspace beyond the components, residual (share of the trace) that counts as none, passes at most.
SPARE, RESIDUAL, PASSES = 8, 1e-14, 6
#: Share of the trace below which a component has no variance.
NO_VARIANCE = 1e-13


def whole_numbers(column: pa.ListArray, size: int) -> np.ndarray:
    """Rows of x = floor(1024 * c) + 100000 (int64)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
    return np.floor(SCALE * flat).astype(np.int64) + ORIGIN


def _usable(embeddings: DataFrame, vec_col: str) -> DataFrame:
    """Rows that take part, with ``__size`` entries."""
    vector = F.col(vec_col)
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(HUGE)))
    return embeddings.where(vector.isNotNull() & (F.size(vector) > 0) & fine)


def _rows(batches: Iterator[pa.RecordBatch], column: int, size: int, most: int) -> Iterator[np.ndarray]:
    """Matrices of at most ``most`` rows."""
    held: list[np.ndarray] = []
    count = 0
    for b in batches:
        x = whole_numbers(b.column(column), size)
        while len(x):
            take = x[: most - count]
            held.append(take)
            count += len(take)
            x = x[len(take) :]
            if count == most:
                yield np.concatenate(held)
                held, count = [], 0
    if held:
        yield np.concatenate(held)


_SPECTRUM = "part int, n long, sums array<string>, values binary, vectors binary"


def _packed(part: int, s: Spectrum) -> dict:
    return {"part": [part], "n": [s.n], "sums": [[str(int(v)) for v in s.sums]], "values": [s.values.astype("<f8").tobytes()],
            "vectors": [s.vectors.astype("<f8").tobytes()]}


def _unpacked(n: int, sums: list[str], values: bytes, vectors: bytes) -> Spectrum:
    return Spectrum(n, np.array([int(v) for v in sums], object), np.frombuffer(values, "<f8").copy(),
                    np.frombuffer(vectors, "<f8").reshape(len(sums), len(sums)).copy())


_ARROW = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("values", pa.binary()), ("vectors", pa.binary())])


def spectrum(rows: DataFrame, size: int) -> Spectrum:
    """Count, sums and spectrum of the column ``v`` (arrays of ``size`` fine entries)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = Spectrum.empty(size)
        for x in _rows(batches, 0, size, BLOCK * max(size, 16)):
            own.add_rows(x)
        if own.n:
            yield pa.RecordBatch.from_pydict(_packed(TaskContext.get().partitionId(), own), _ARROW)

    def combine(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        columns = (t[c].to_pylist() for c in ("n", "sums", "values", "vectors"))
        first, *others = (_unpacked(*r) for r in zip(*columns))
        for other in others:
            first.add(other)
        return pa.Table.from_pydict(_packed(t["part"][0].as_py() // FAN, first), _ARROW)

    found = stored(rows.select("v").mapInArrow(tidy(run), _SPECTRUM), "spectra")
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        found = stored(found.groupBy(F.floor(F.col("part") / FAN)).applyInArrow(tidy(combine), _SPECTRUM), "spectra")
        parts = -(-parts // FAN)
    one = found.first()
    return Spectrum.empty(size) if one is None else _unpacked(one["n"], one["sums"], bytes(one["values"]), bytes(one["vectors"]))


def _centre(s: Spectrum) -> tuple[np.ndarray, np.ndarray]:
    """S / n as a whole part and a rest, so that x - S / n loses nothing."""
    return np.array([int(v) // s.n for v in s.sums], np.int64), np.array([int(v) % s.n for v in s.sums], float) / s.n


def _summed(rows: DataFrame, function, cells: int) -> np.ndarray:
    """Sum over all tasks of the arrays of ``cells`` numbers that ``function`` gives of a task's batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([function(batches).tolist()], pa.list_(pa.float64()))], names=["a"])

    sums = (rows.select("v").mapInArrow(tidy(run), "a array<double>").select(F.posexplode("a").alias("cell", "value"))
            .groupBy("cell").agg(F.sum("value").alias("value")).collect())  # `cells` rows
    out = np.zeros(cells)
    for r in sums:
        out[r["cell"]] = r["value"]
    return out


def components(rows: DataFrame, s: Spectrum, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues of the covariance (falling), their unit eigenvectors (columns) and the trace."""
    size = len(s.sums)
    whole, rest = _centre(s)
    basis = s.vectors[:, ::-1][:, : min(size, wanted + SPARE)]
    images = np.zeros((size, 0))
    trace = 0.0
    for _ in range(PASSES):
        new = basis[:, images.shape[1] :]

        def image(batches: Iterator[pa.RecordBatch], new: np.ndarray = new) -> np.ndarray:
            total, squares = np.zeros(new.shape), 0.0
            for x in _rows(batches, 0, size, 1 << 12):
                y = (x - whole).astype(float) - rest
                total += y.T @ (y @ new)
                squares += float((y * y).sum())
            return np.append(total.ravel(), squares)

        sums = _summed(rows, image, size * new.shape[1] + 1) / s.n
        trace = sums[-1]
        images = np.hstack([images, sums[:-1].reshape(size, -1)])
        small = basis.T @ images
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1][:wanted], inner[:, ::-1][:, :wanted]
        vectors = basis @ inner
        left = images @ inner - vectors * values
        open_ = np.linalg.norm(left, axis=0) > RESIDUAL * max(trace, 1e-300)
        room = size - basis.shape[1]
        if not open_.any() or room <= 0:
            break
        more = left[:, open_]
        for _ in range(2):  # twice is enough for orthogonality
            more = more - basis @ (basis.T @ more)
            more, _ = np.linalg.qr(more)
        basis = np.hstack([basis, more[:, :room]])
    vectors /= np.linalg.norm(vectors, axis=0)
    there = values > NO_VARIANCE * trace
    return values[there], vectors[:, there], trace


def _deviation(x: np.ndarray, s: Spectrum, whole: np.ndarray) -> list[int]:
    """Sum over the dimensions of (n * x - S)**2 as exact whole numbers: with S = n * whole + r it is n**2 * sum y**2 - 2 n * sum y r + sum r**2."""
    y = x - whole
    r = [int(v) - s.n * int(w) for v, w in zip(s.sums, whole)]
    if not len(y) or float(np.abs(y).max()) ** 2 * y.shape[1] >= 2**62 or float(np.abs(y).max()) * s.n * y.shape[1] >= 2**62:
        y = y.astype(object)
        squares, cross = (y * y).sum(axis=1), (y * np.array(r, object)).sum(axis=1)
    else:
        squares, cross = (y * y).sum(axis=1), (y * np.array(r, np.int64)).sum(axis=1)
    last = sum(v * v for v in r)
    return [s.n * s.n * int(a) - 2 * s.n * int(b) + last for a, b in zip(squares, cross)]


def whiten(embeddings: DataFrame, *, components_wanted: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each vector and component (from 1 by falling eigenvalue): ``id_col``, ``component`` int, ``n`` long, ``deviation``
    long, ``whitened``, ``explained``, ``identity_error`` double, ``deviation_exact`` decimal(38,0). Other columns are not read."""
    spark = embeddings.sparkSession
    kind = embeddings.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, "
              "deviation_exact decimal(38,0)")
    used = _usable(embeddings.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), "v")
    sizes = used.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    size = sizes["size"]
    rows = used.where(F.size("v") == size)
    s = spectrum(rows, size)
    values, vectors, trace = components(rows, s, min(components_wanted, size))
    m = len(values)
    if not m:
        return spark.createDataFrame([], schema)
    whole, rest = _centre(s)
    scale = vectors / np.sqrt(values)

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total, sums = np.zeros((m, m)), np.zeros(m)
        for x in _rows(batches, 0, size, 1 << 12):
            w = ((x - whole).astype(float) - rest) @ scale
            total += w.T @ w
            sums += w.sum(axis=0)
        return np.append(total.ravel(), sums)

    measured = _summed(rows, products, m * m + m) / s.n
    covariance = measured[: m * m].reshape(m, m) - np.outer(measured[m * m :], measured[m * m :])
    error = float(np.abs(covariance - np.eye(m)).max())
    explained = (values / trace).tolist()
    n = s.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = whole_numbers(b.column(1), size)
            w = ((x - whole).astype(float) - rest) @ scale
            exact = [v for v in _deviation(x, s, whole) for _ in range(m)]
            k = b.num_rows
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(k), m))), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)),
                pa.array(np.full(k * m, n, np.int64)), pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()), pa.array(w.ravel()),
                pa.array(np.tile(explained, k)), pa.array(np.full(k * m, error)),
                pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return rows.select("id", "v").mapInArrow(tidy(run), schema)
