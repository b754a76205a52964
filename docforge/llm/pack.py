"""Packing of documents into sequences along a space-filling curve.

A document's ids are hashed into a signed count vector, which is projected to a few dimensions and scaled to length one;
the Hilbert key of that point orders the documents (ties: document id, then row). Documents are laid one after another
along the curve and cut at every ``length`` ids, so neighbours on the curve share sequences, and nothing is padded: the
ids beyond the last full sequence are cut into sequences whose lengths are descending powers of two.

The ids are computed once and written to the shared folder. Places along the curve come from a table of four numbers a
document, range-partitioned on (key, id, row) so that equal keys split, with running sums within partitions and one row a
partition above. The places then join the ids on the row number: that is the only shuffle of ids.

Defined results: a null text is empty and has only the end id; null ids sort first; repeated rows are documents of their
own; an empty table has no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docforge.llm import hilbert
from docforge.llm.bpe import encoder
from docforge.llm.common import partitions, small_batches, splitmix, stored, text_batches, tidy

CHARS = 1 << 20
#: Length of the hashed count vector, dimensions it is projected to, and bits a dimension.
HASHED, DIMS, BITS = 1024, 4, 12


def projection(ids: int, seed: int = 11) -> np.ndarray:
    """What one occurrence of each id adds to the projected vector: sign(id) * row[bucket(id)] of a fixed random matrix."""
    bits = splitmix(seed, ids)
    rows = np.random.default_rng(seed).standard_normal((HASHED, DIMS)).astype(np.float32)
    sign = np.where(bits >> np.uint64(63), 1, -1).astype(np.float32)
    return rows[(bits % np.uint64(HASHED)).astype(np.int64)] * sign[:, None]


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``row`` (a number of its own), ``id``, ``key``, ``doc_tokens`` and ``ids`` (two bytes each, four if the tokenizer has more) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        size = max(enc.model.size, end_id + 1)
        width = 2 if size <= 1 << 16 else 4
        weights = projection(size)
        row = TaskContext.get().partitionId() << 40
        for t in text_batches(batches, CHARS):
            ids, begins = enc.encode(t["text"].to_pylist())
            ids = np.insert(ids, begins[1:], end_id)
            begins = begins + np.arange(len(begins))
            point = np.add.reduceat(weights[ids], begins[:-1], axis=0)
            point /= np.maximum(np.linalg.norm(point, axis=1, keepdims=True), 1e-30)
            key = hilbert.keys(hilbert.grid(point, np.full(DIMS, -1.0), np.full(DIMS, 1.0), BITS), BITS)
            data, at = ids.astype(f"<u{width}").tobytes(), (begins * width).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row, row + len(key))), t["id"].combine_chunks(), pa.array(key), pa.array(np.diff(begins)),
                pa.array([data[a:b] for a, b in zip(at, at[1:])], pa.binary())],
                names=["row", "id", "key", "doc_tokens", "ids"])
            row += len(key)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run, ("encoder",)), "row long, id long, key long, doc_tokens long, ids binary")


def places(order: DataFrame) -> DataFrame:
    """``row`` and ``place``: ids before it along the curve."""
    n = partitions(order.sparkSession)
    dealt = stored(order.repartitionByRange(n, "key", "id", "row").withColumn("part", F.spark_partition_id()), "curve")
    total = dealt.groupBy("part").agg(F.sum("doc_tokens").alias("ids"))  # one row a partition
    up = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = total.select("part", F.coalesce(F.sum("ids").over(up), F.lit(0)).alias("first"))
    along = Window.partitionBy("part").orderBy("key", "id", "row").rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.select("part", "row", F.coalesce(F.sum("doc_tokens").over(along), F.lit(0)).alias("own"))
    return own.join(first, "part").select("row", (F.col("own") + F.col("first")).alias("place"))


def bounds(total: int, length: int) -> np.ndarray:
    """Starts of the sequences after the last full one, and the end: the rest in descending powers of two."""
    at = total - total % length
    out = [at]
    for b in range(int(length).bit_length(), -1, -1):
        if (total % length) >> b & 1:
            at += 1 << b
            out.append(at)
    return np.asarray(out, np.int64)


def pack(docs: DataFrame, tokenizer: str, *, end_id: int, length: int = 2048, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row a piece: ``doc_id``, ``start`` (ids of its document before it), ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (place in the sequence) and ``ids`` (binary, little-endian unsigned 32-bit)."""
    small_batches(docs.sparkSession)
    table = stored(encoded(docs, tokenizer, end_id, id_col, text_col), "ids")
    total = table.agg(F.sum("doc_tokens")).first()[0] or 0
    rest = bounds(total, length)
    full = total // length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            place, tokens = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            # number of sequences begun up to a place; the end of the last belongs to none
            number = lambda p: np.where(p < rest[0], p // length, full + np.searchsorted(rest, p, "right") - 1)
            first, last = number(place), number(place + tokens - 1)
            count = last - first + 1
            doc = np.repeat(np.arange(len(place)), count)
            seq = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
            later = np.clip(seq - full, 0, len(rest) - 1)
            begin = np.where(seq < full, seq * length, rest[later])
            end = np.where(seq < full, (seq + 1) * length, rest[np.minimum(later + 1, len(rest) - 1)])
            start = np.maximum(begin, place[doc]) - place[doc]
            stop = np.minimum(end, (place + tokens)[doc]) - place[doc]
            ids = [np.frombuffer(x, f"<u{len(x) // n}").astype("<u4").tobytes() for x, n in zip(b.column(3).to_pylist(), tokens.tolist())]
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(doc)), pa.array(start), pa.array(stop - start), pa.array(tokens[doc]), pa.array(seq),
                pa.array(np.maximum(begin, place[doc]) - begin),
                pa.array([ids[d][4 * s : 4 * e] for d, s, e in zip(doc.tolist(), start.tolist(), stop.tolist())], pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    where = places(table.select("row", "id", "key", "doc_tokens"))
    return table.join(where, "row").select("id", "place", "doc_tokens", "ids").mapInArrow(tidy(cut, ("encoder",)), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
