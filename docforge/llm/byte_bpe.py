"""Byte-level BPE with the tiktoken library and a local rank file.

The library matches a pattern and merges the bytes of each match by rank. On long texts two things go wrong: a run of some hundred
thousand blanks overflows the pattern's stack, and all ids of a text are one list. So a text longer than ``PIECE_CHARS`` is cut
beforehand, only where a match of the pattern is bound to end whatever stands around:

* after a letter, before anything else; after a number, before anything else;
* after a character that is no blank, before a blank;
* before the last blank of a run, if no blank follows (the pattern leaves that one for the next word).

No alternative of the pattern looks behind or runs over such a place, so the pieces' ids put together are the text's. A run without such a
place (blanks alone, however many) is a single match and goes to the library's merge as one, past the pattern. What letters,
numbers and blanks are is asked of the library itself, as its Unicode tables may differ from Python's.

Defined results: a null or empty text has no ids. Bytes that are no UTF-8 count as the replacement character. The text of a special token
is ordinary text. Repeated rows stay rows. ``decode`` returns the ids' bytes as they are (null ids: null).
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import KEPT, small_batches, text_batches, tidy

#: A longer text is cut into pieces of about this size.
PIECE_CHARS = 1 << 16
#: Characters (bytes of UTF-8) that are handed on at once.
CHARS = 1 << 20


@lru_cache(maxsize=1)
def _classes() -> dict[str, str]:
    """Letters, numbers and blanks as the library sees them, as the inside of a character class."""
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    out = {}
    for name, pattern in (("letter", r"\p{L}+"), ("number", r"\p{N}+"), ("blank", r"\s+")):
        seen = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = [ord(c) for c in seen.decode_bytes(seen.encode_ordinary(points)).decode()]
        runs: list[list[int]] = []
        for c in found:
            if runs and runs[-1][1] == c - 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        out[name] = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)
    return out


@lru_cache(maxsize=1)
def safe_places() -> re.Pattern:
    """Matches (empty) where the standard pattern's matches are bound to end."""
    c = _classes()
    letter, number, blank = c["letter"], c["number"], c["blank"]
    return re.compile(f"(?<=[{letter}])(?=[^{letter}])|(?<=[{number}])(?=[^{number}])|(?<=[^{blank}])(?=[{blank}])"
                      f"|(?<=[{blank}])(?=[{blank}][^{blank}])")


class Codec:
    """The library's encoding of a rank file; long texts go through in pieces."""

    def __init__(self, ranks: str, pattern: str, cut: bool) -> None:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.cut = cut
        self.blanks = re.compile(f"[{_classes()['blank']}]+") if cut else None

    def _last_place(self, text: str, start: int, end: int) -> int | None:
        """The last safe place in (start, end], or None."""
        width = 256
        while True:
            low = max(start, end - width)
            place = None
            for m in safe_places().finditer(text, max(low, start + 1), end):
                place = m.start()
            if place is not None or low == start:
                return place
            width *= 16

    def pieces(self, text: str) -> Iterator[str]:
        """The text cut at safe places into pieces of at most ``PIECE_CHARS`` characters, or of one run that has no such place."""
        at, n = 0, len(text)
        while n - at > PIECE_CHARS:
            place = self._last_place(text, at, at + PIECE_CHARS)
            if place is None:  # a run goes on
                later = safe_places().search(text, at + PIECE_CHARS)
                if later is None:
                    break
                place = later.start()
            yield text[at:place]
            at = place
        yield text[at:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE_CHARS or not self.cut:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for piece in self.pieces(text):
            if len(piece) > PIECE_CHARS and self.blanks.fullmatch(piece):
                ids += self.encoding._encode_single_piece(piece.encode())  # one match by itself; the pattern's stack would not hold it
            else:
                ids += self.encoding.encode_ordinary(piece)
        return ids


@lru_cache(maxsize=4)
def codec(ranks: str, pattern: str, cut: bool = True) -> Codec:
    """A worker's codec of a rank file."""
    return Codec(ranks, pattern, cut)


KEPT["codec"] = codec


def encode(docs: DataFrame, ranks: str, pattern: str, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
           cut: bool = True) -> DataFrame:
    """The columns ``keep``, ``n_tokens`` (long) and ``ids`` (array of int) of every row. A kept column of one of these names is replaced.

    ``ranks``: path of a rank file that every executor has (base64 token, blank, rank); ``pattern``: the library's split pattern.
    ``cut=False`` for a pattern that is not of the standard form the safe places hold for.

    A narrow step: no shuffle, each text read once, other columns not at all.
    """
    small_batches(docs.sparkSession)
    keep = tuple(c for c in keep if c not in ("n_tokens", "ids"))
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern, cut)
        for t in text_batches(batches, CHARS, "__text"):
            ids = [own.encode(x.decode("utf-8", "replace")) if x else [] for x in t["__text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(t[c].combine_chunks() for c in keep), pa.array([len(x) for x in ids], pa.int64()),
                                              pa.array(ids, pa.list_(pa.int32()))], names=[*keep, "n_tokens", "ids"])

    return docs.select(*(f"`{c}`" for c in keep), F.col(text_col).cast("binary").alias("__text")).mapInArrow(
        tidy(run, ("codec",)), kinds + "n_tokens long, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with ``out_col``: the raw bytes of its ids. An id that the rank file doesn't have raises an error."""
    fields = [f for f in encoded.schema.fields if f.name != out_col]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{out_col}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern).encoding
        for b in batches:
            data = [None if x is None else own.decode_bytes(x) for x in b.column(b.schema.get_field_index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(data, pa.binary())], names=[*b.schema.names, out_col])

    return encoded.select(*(f"`{f.name}`" for f in fields)).mapInArrow(tidy(run, ("codec",)), schema)
