"""Encode documents to token ids and decode them (see ``bpe`` for the method)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.bpe import encoder
from docforge.llm.common import small_batches, text_batches, tidy

#: Characters that one call of the encoder gets: bounds a task's arrays to some tens of MB.
CHARS = 1 << 20


def encode(docs: DataFrame, tokenizer: str, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           with_ids: bool = True) -> DataFrame:
    """The columns ``keep``, ``n_tokens`` and, unless only counts are wanted, ``ids`` (binary: little-endian unsigned 32-bit ids) of
    every row. A kept column of one of these names is replaced.

    A narrow step: no shuffle, each text read once. One row out for each row in, repeated rows included; a null or empty text
    has no ids. Other columns of ``docs`` are not read.
    """
    small_batches(docs.sparkSession)
    keep = tuple(c for c in keep if c not in ("n_tokens", "ids"))
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for t in text_batches(batches, CHARS, "__text"):
            ids, begins = enc.encode(t["__text"].to_pylist())
            out = [*(t[c].combine_chunks() for c in keep), pa.array(np.diff(begins))]
            if with_ids:
                data, at = ids.astype("<u4").tobytes(), (begins * 4).tolist()
                out.append(pa.array([data[a:b] for a, b in zip(at, at[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=[*keep, "n_tokens", *(["ids"] if with_ids else [])])

    return docs.select(*keep, F.col(text_col).alias("__text")).mapInArrow(
        tidy(run, ("encoder",)), kinds + "n_tokens long" + (", ids binary" if with_ids else ""))


def decode(encoded: DataFrame, tokenizer: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``, the text of its ids (null ids: null), special tokens written out."""
    columns = [f for f in encoded.schema.fields if f.name != out_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), f"`{out_col}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            texts = [None if x is None else enc.decode(np.frombuffer(x, "<u4").astype(np.int64))
                     for x in b.column(b.schema.get_field_index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out_col])

    return encoded.select(*(f.name for f in columns)).mapInArrow(tidy(run, ("encoder",)), schema)
