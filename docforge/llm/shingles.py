"""Sets of word shingles as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from docforge.llm.common import WordHash, mix64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_HASH = WordHash(0xB00C, 256)


def text_bytes(text: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another and the offset of each, with the end (null: empty)."""
    if isinstance(text, pa.ChunkedArray):
        text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], text.type)
    text = text.fill_null("")
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = text.buffers()
    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    off = np.frombuffer(off, kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off - off[0]


def shingle_sets(text: pa.Array | pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after another, and the offsets of the texts (with the end).

    Words are runs of bytes other than blanks (0x20, 0x09-0x0D) with A-Z in lower case. A text of fewer than ``size``
    words has its whole sequence as one shingle; a text without words has none.
    """
    raw, begin = text_bytes(text)
    docs = len(begin) - 1
    low = _LOWER[raw]
    word = ~_BLANK[low]
    first = np.zeros(len(raw) + 1, bool)
    first[begin[:-1]] = True
    first = first[:-1]
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:]
    stop = word.copy()
    stop[:-1] &= ~word[1:] | first[1:]
    start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
    word_hash = _HASH.spans(low, start, stop)
    word_at = np.searchsorted(start, begin)  # first word of each text
    words = np.diff(word_at)
    owner = np.repeat(np.arange(docs), words)
    value = np.zeros(0, np.uint64)
    whole = owner[:0]
    if len(word_hash):
        n = max(0, len(word_hash) - size + 1)
        value = np.zeros(n, np.uint64)
        for k in range(size):
            value = mix64(value + word_hash[k : k + n])
        fits = owner[:n] == owner[size - 1 : size - 1 + n]
        value, whole = value[fits], owner[:n][fits]
    short = np.flatnonzero((words > 0) & (words < size))
    if len(short):
        extra = words[short].astype(np.uint64)  # also tells a short sequence from a shingle
        for k in range(size - 1):
            has = words[short] > k
            extra[has] = mix64(extra[has] + word_hash[word_at[short[has]] + k])
        value, whole = np.concatenate([value, extra]), np.concatenate([whole, short])
        by = np.argsort(whole, kind="stable")
        value, whole = value[by], whole[by]
    at = np.searchsorted(whole, np.arange(docs + 1))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        value[a:b].sort()
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (whole[1:] != whole[:-1])
    return value[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def digests(value: np.ndarray, begin: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit digest of each set, from a sum over its members (any order)."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(value ^ np.uint64(seed)))])
    return mix64(total[begin[1:]] - total[begin[:-1]] + np.diff(begin).astype(np.uint64))


def parity_bits(value: np.ndarray) -> bytes:
    """Members counted modulo two in hashed bits: two sets differ in at least as many members as their bits differ in.

    The number of bits is the power of two from half the set's size, 64 at least; folding halves it.
    """
    bits = max(64, 1 << max(0, int(len(value) - 1).bit_length() - 1))
    count = np.bincount((mix64(value) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """In how many bits two parity sets differ, folded to the shorter one."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int(np.bitwise_count(x ^ y).sum())
