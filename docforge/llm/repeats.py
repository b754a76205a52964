"""Removal of byte strings that also occur in an earlier document, by a difference-cover sample of the suffixes.

Only the first ``width`` (50) bytes of a suffix matter, so suffixes are sorted to that depth. The steps are those of
the difference-cover algorithm; names are hashes instead of ranks, as only equality of prefixes is asked for:

1. *Sample.* Positions whose place in the document, modulo 21, lies in a difference cover of 21 (five of 21). For any two
   equal 50-byte strings there is a shift below 21 at which both are sampled, and the 30 bytes from there lie in both.
2. *Sort and name the sample.* Every sampled suffix is named by its first 30 bytes. Names are dealt by value over the
   cluster and sorted; a name that only one document has is unique, and so is everything that starts there.
3. *Merge the rest.* The other suffixes, sampled or not, need a look only where a sampled suffix within the next 21 bytes
   has a name that is not unique. Those get the name of their first 50 bytes; these names are sorted in turn and
4. *adjacent ones compared*: a string is removed wherever an equal one starts in a smaller document id.

A text that a smaller document has as a whole goes as a whole: whole texts are named in the first pass too, and the strings
of such copies are not named again (the smaller document names them).

Documents are dealt once, in compressed batches, by ranges of document id over shards; all three passes over the text use that one exchange, so
"smaller document" is "smaller shard", or decided within the shard. Between the passes only names travel: a shard
sends each name once, however often it has it (so a passage in a third of all documents is no hot key), sorted by
value, as byte-packed gaps; the answer is a bit a name. A shard holds about ``SHARD_BYTES`` of text and sends one row for
each name range; ranges are as many as shards.

Names of step 2 are cut to 38 bits, where a chance match only costs a look. Names of step 4 have 64 bits; at n looked-at
strings about n*n/2**65 chance matches are to be expected (0.001 at 200 million).

Defined results: a null text is empty. A null id is smaller than all others and equal to itself; rows of equal id don't
remove each other's strings. Texts shorter than ``width`` bytes are kept whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import SpanHash, gather, small_batches, spread_keys, text_batches, tidy

#: A perfect difference set: the differences of its members give every residue.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
#: Text a shard holds, and text whose hashes are in memory at once within it.
SHARD_BYTES, CHUNK_BYTES = 12 << 20, 1 << 20
#: Characters that are dealt at once: a task sends a compressed batch to each shard that has some of them.
DEAL_CHARS = 6 << 20
NAME_BITS = 38
NULL_ID = -(1 << 63)


# -- packed, sorted names -----------------------------------------------------------------------------------


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending values as byte planes of their gaps."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    return bytes([width]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :width] = planes.T
    return np.cumsum(full.view("<u8").ravel(), dtype=np.uint64)


def ranges(count: int, bits: int) -> np.ndarray:
    """Lower ends of ``count`` equal ranges of the values below 2**bits."""
    return np.array([(k << bits) // count for k in range(count)], np.uint64)


def distinct(values: np.ndarray) -> np.ndarray:
    values.sort()
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def digests(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each whole text."""
    view = memoryview(np.ascontiguousarray(data))
    found = b"".join(hashlib.blake2b(view[a : a + n], digest_size=8).digest() for a, n in zip(begin.tolist(), size.tolist()))
    return np.frombuffer(found, "<u8")


# -- one shard ----------------------------------------------------------------------------------------------


class Shard:
    """The texts of a shard as one byte array, documents in ascending id."""

    def __init__(self, dealt: list[bytes], width: int) -> None:
        self.table = table = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in dealt])
        text = table["text"].combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        null = np.asarray(text.is_null().to_numpy(zero_copy_only=False), bool)
        ids = table["id"].combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        self.order = np.argsort(ids, kind="stable")
        large = pa.types.is_large_string(text.type)
        kind = np.int64 if large else np.int32
        if len(text):
            _, off, data = text.buffers()
            off = np.frombuffer(off, kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
            raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        else:
            off, raw = np.zeros(1, np.int64), np.zeros(0, np.uint8)
        size = np.where(null, 0, np.diff(off))
        self.ids, self.size, self.raw = ids[self.order], size[self.order], raw
        self.at = off[:-1][self.order]
        self.rank = np.cumsum(np.concatenate([[True], self.ids[1:] != self.ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
        self.width, self.gram = width, width - PERIOD + 1
        self.whole = np.zeros(len(self.size), np.uint64)  # names of whole texts, once the sample is named
        self.hash = SpanHash(0xC0DE, 256)

    def chunks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Runs of documents: first, past the last, their bytes one after another, and where each begins."""
        ends = np.cumsum(self.size)
        first = 0
        while first < len(self.size):
            base = ends[first] - self.size[first]
            last = max(first + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
            size = self.size[first:last]
            if last == first + 1:
                data = self.raw[self.at[first] : self.at[first] + size[0]]
            else:
                data = self.raw[gather(self.at[first:last], size)]
            yield first, last, data, np.cumsum(size) - size
            first = last

    def sampled(self, size: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions of a chunk, and the document (within the chunk) of each."""
        last = size - self.gram  # the last position that has a whole name
        cover = np.asarray(COVER)
        count = np.where(last >= 0, last // PERIOD * len(cover) + np.searchsorted(cover, last % PERIOD, "right"), 0)
        k = gather(np.zeros(len(size), np.int64), count)
        at = k // len(cover) * PERIOD
        at += cover[k % len(cover)]
        doc = np.repeat(np.arange(len(size), dtype=np.int32), count)
        at += begin[doc]
        return at, doc

    def names(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for first, last, data, begin in self.chunks():
            prefix = self.hash.prefix(data)
            self.whole[first:last] = digests(data, begin, self.size[first:last])
            at, doc = self.sampled(self.size[first:last], begin)
            name = self.hash.spans(prefix, at, at + self.gram) >> np.uint64(64 - NAME_BITS)
            yield first, last, begin, prefix, at, doc, name

    def sample(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names of the sample, and whether more than one position of the shard has them."""
        found = [x[-1] for x in self.names()]
        values = np.concatenate(found) if found else np.zeros(0, np.uint64)
        del found
        values.sort()
        edge = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, np.int64)
        return values[edge[:-1]], np.diff(edge) > 1

    def texts(self) -> np.ndarray:
        """Distinct names of the whole texts that are long enough to go."""
        return distinct(self.whole[self.size >= self.width])

    def copies(self, earlier: np.ndarray) -> np.ndarray:
        """Which documents are copies of a smaller one: of this shard, or of one whose text is among the names ``earlier``."""
        by = np.lexsort((self.rank, self.whole))
        edge = np.ones(len(by), bool)
        edge[1:] = self.whole[by[1:]] != self.whole[by[:-1]]
        least = self.rank[by[edge]][np.cumsum(edge) - 1]
        out = np.zeros(len(by), bool)
        out[by] = least < self.rank[by]
        return (out | np.isin(self.whole, earlier)) & (self.size >= self.width)

    def looked_at(self, repeated: np.ndarray, copy: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """First document of a chunk; start in its document, document and name of each string to be looked at."""
        bits = 22
        seen = np.zeros(1 << bits, bool)
        low = np.uint64((1 << bits) - 1)
        seen[(repeated & low).astype(np.int64)] = True
        for first, last, begin, prefix, at, doc, name in self.names():
            maybe = np.flatnonzero(seen[(name & low).astype(np.int64)])
            place = np.searchsorted(repeated, name[maybe])
            hit = maybe[repeated[np.minimum(place, len(repeated) - 1)] == name[maybe]] if len(repeated) else maybe[:0]
            hit = hit[~copy[doc[hit] + first]]
            size = self.size[first:last]
            mark = np.zeros(int(size.sum()) + 1, np.int32)
            low_at = np.maximum(at[hit] - PERIOD + 1, begin[doc[hit]])
            high = np.minimum(at[hit], begin[doc[hit]] + size[doc[hit]] - self.width) + 1
            ok = high > low_at
            np.add.at(mark, low_at[ok], 1)
            np.add.at(mark, high[ok], -1)
            start = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
            owner = np.searchsorted(begin, start, "right") - 1
            yield first, (start - begin[owner]).astype(np.int32), (owner + first).astype(np.int32), self.hash.spans(prefix, start, start + self.width)


def _rows(key_of: list[int], count: int, shard: int, step: int, values: np.ndarray) -> pa.Table:
    bits = BITS_OF[step]
    cut = np.append(np.searchsorted(values, ranges(count, bits)), len(values))
    parts = [(key_of[k], step, k, shard, pack_sorted(values[cut[k] : cut[k + 1]])) for k in range(count) if cut[k + 1] > cut[k]]
    return pa.table([list(c) for c in zip(*parts)] if parts else [[]] * 5, schema=_NAMES)


#: Steps of naming, and the bits of their names.
SAMPLE, TEXTS, STRINGS = 0, 1, 2
BITS_OF = (NAME_BITS, 64, 64)
_NAMES = pa.schema([("key", pa.int64()), ("step", pa.int32()), ("part", pa.int32()), ("shard", pa.int32()), ("names", pa.binary())])
_BITS = pa.schema([("key", pa.int64()), ("step", pa.int32()), ("part", pa.int32()), ("bits", pa.binary())])
NAMES_SCHEMA = "key long, step int, part int, shard int, names binary"
BITS_SCHEMA = "key long, step int, part int, bits binary"


def _answer(rows: pa.Table, key_of: list[int]) -> pa.Table:
    """A bit for each name of each shard: of the sample, whether another shard has it; else whether a smaller one has."""
    out: list[tuple[int, int, int, bytes]] = []
    steps, shard_of, parts = (rows[c].to_numpy() for c in ("step", "shard", "part"))
    for step in np.unique(steps).tolist():
        at = np.flatnonzero(steps == step)
        at = at[np.argsort(shard_of[at], kind="stable")]
        lists = [unpack_sorted(rows["names"][int(k)].as_py()) for k in at]
        values = np.concatenate(lists)
        if step == SAMPLE:
            values.sort()
            several = distinct(values[1:][values[1:] == values[:-1]])
            bits = []
            for own in lists:
                hit = np.zeros(len(own), bool)
                place = np.minimum(np.searchsorted(own, several), len(own) - 1)
                hit[place[own[place] == several]] = True
                bits.append(hit)
        else:
            by = np.argsort(values, kind="stable")  # equal names in order of shard
            again = np.zeros(len(values), bool)
            again[by[1:]] = values[by[1:]] == values[by[:-1]]
            bits = np.split(again, np.cumsum([len(x) for x in lists])[:-1])
        out += [(key_of[int(shard_of[k])], step, int(parts[k]), np.packbits(b).tobytes()) for k, b in zip(at, bits) if b.any()]
    return pa.table([list(c) for c in zip(*out)] if out else [[]] * 4, schema=_BITS)


def _bits(answers: pa.Table, step: int, values: np.ndarray, count: int) -> np.ndarray:
    """The answered bit of each of the shard's sorted names."""
    cut = np.append(np.searchsorted(values, ranges(count, BITS_OF[step])), len(values))
    out = np.zeros(len(values), bool)
    for s, part, data in zip(answers["step"].to_pylist(), answers["part"].to_pylist(), answers["bits"].to_pylist()):
        if s == step:
            a, b = cut[part], cut[part + 1]
            out[a:b] = np.unpackbits(np.frombuffer(data, np.uint8), count=int(b - a)).astype(bool)
    return out


def remove_repeats(docs: DataFrame, *, width: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = (), whole_characters: bool = False, shard_bytes: int | None = None) -> DataFrame:
    """``id_col``, the ``carry`` columns, ``n_bytes``, ``spans`` (array of removed [start, end) byte places, merged) and
    ``kept`` (binary: the bytes left) of every row. With ``whole_characters`` a character goes only with all its bytes, so what
    is left is text. ``shard_bytes`` (default ``SHARD_BYTES``) sizes a task's share of the texts; results don't depend on it."""
    spark = docs.sparkSession
    if width < 2 * PERIOD:
        raise ValueError(f"width must be at least {2 * PERIOD}")
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    count = max(1, -(-int(total) // (shard_bytes or SHARD_BYTES)))
    long_id = F.col(id_col).cast("long")
    steps = [k / count for k in range(1, count)]
    cuts = (docs.agg(F.percentile_approx(long_id, steps, max(10_000, 100 * count))).first()[0] or []) if steps else []
    cuts = sorted(set(cuts))
    count = len(cuts) + 1
    key_of = spread_keys(spark, count)
    small_batches(spark)
    bounds = np.asarray(cuts, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in text_batches(batches, DEAL_CHARS):
            t = t.combine_chunks()
            shard = np.searchsorted(bounds, t["id"].combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False))
            for k in np.unique(shard).tolist():
                own = t.take(pa.array(np.flatnonzero(shard == k)))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(own)
                yield pa.RecordBatch.from_arrays([pa.array([key_of[k]], pa.int64()), pa.array([k], pa.int32()),
                                                  pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["key", "shard", "data"])

    kinds = ", ".join(f"`c{k}` {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(carry))
    rows = docs.select(long_id.alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(carry)))
    dealt = rows.mapInArrow(tidy(deal), "key long, shard int, data binary").repartition(count, "key")

    def of(table: pa.Table) -> int:
        return table["shard"][0].as_py()

    def name_sample(table: pa.Table) -> pa.Table:
        s = Shard(table["data"].to_pylist(), width)
        sample = s.sample()[0]
        return pa.concat_tables([_rows(key_of, count, of(table), SAMPLE, sample), _rows(key_of, count, of(table), TEXTS, s.texts())])

    def second_look(table: pa.Table, answers: pa.Table) -> tuple[Shard, np.ndarray, list]:
        """The shard, its copies, and its strings that have to be looked at, by chunk."""
        s = Shard(table["data"].to_pylist(), width)
        values, own = s.sample()
        repeated = values[own | _bits(answers, SAMPLE, values, count)]
        texts = s.texts()
        copy = s.copies(texts[_bits(answers, TEXTS, texts, count)])
        return s, copy, list(s.looked_at(repeated, copy))

    def name_strings(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _NAMES.empty_table()
        _, _, chunks = second_look(table, answers)
        return _rows(key_of, count, of(table), STRINGS, distinct(np.concatenate([c[3] for c in chunks])))

    def cut_out(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return out_schema.empty_table()
        s, copy, chunks = second_look(table, answers)
        names = np.concatenate([c[3] for c in chunks])
        chunks = [c[:3] for c in chunks]
        by = np.argsort(names, kind="stable")  # documents ascend, so the first of equal names is the smallest one's
        names = names[by]
        edge = np.ones(len(names), bool)
        edge[1:] = names[1:] != names[:-1]
        values = names[edge]
        del names
        group = (np.cumsum(edge, dtype=np.int32) - 1)
        owners = s.rank[np.concatenate([c[2] for c in chunks])[by]].astype(np.int32)
        gone = np.zeros(len(by), bool)
        gone[by] = (owners[edge][group] < owners) | _bits(answers, STRINGS, values, count)[group]
        del by, group, owners, values
        spans: list[list[int]] = [[]] * len(s.size)
        kept: list[bytes] = [b""] * len(s.size)
        done = 0
        for (first, start, owner), (f, last, data, begin) in zip(chunks, s.chunks()):
            use = gone[done : done + len(start)]
            done += len(start)
            size = s.size[f:last]
            mark = np.zeros(len(data) + 1, np.int32)
            at = begin[owner[use] - f] + start[use]
            mark[at] += 1
            np.subtract.at(mark, at + width, 1)
            whole = copy[f:last]
            np.add.at(mark, begin[whole], 1)
            np.subtract.at(mark, begin[whole] + size[whole], 1)
            removed = np.cumsum(mark[:-1]) > 0
            if whole_characters and len(data):
                lead = np.flatnonzero((data & 0xC0) != 0x80)
                removed = np.repeat(np.logical_and.reduceat(removed, lead), np.diff(np.append(lead, len(data))))
            left = data[~removed].tobytes()
            before = np.concatenate([[0], np.cumsum(~removed)])
            a, b = before[begin].tolist(), before[begin + size].tolist()
            for k in range(last - f):
                kept[f + k] = left[a[k] : b[k]]
            if removed.any():
                edge = np.zeros(len(data) + 1, bool)
                edge[begin] = True
                begins, ends = removed.copy(), removed.copy()
                begins[1:] &= ~removed[:-1] | edge[1:-1]
                ends[:-1] &= ~removed[1:] | edge[1:-1]
                b_at, e_at = np.flatnonzero(begins), np.flatnonzero(ends) + 1
                doc = np.searchsorted(begin, b_at, "right") - 1
                for d, x, y in zip(doc.tolist(), (b_at - begin[doc]).tolist(), (e_at - begin[doc]).tolist()):
                    spans[f + d] = [*spans[f + d], (x, y)]
        back = np.argsort(s.order)
        pairs = [[{"start": x, "end": y} for x, y in spans[k]] for k in back]
        return pa.table([s.table["id"], *(s.table[f"c{k}"] for k in range(len(carry))), pa.array(s.size[back]),
                         pa.array(pairs, out_schema.field("spans").type), pa.array([kept[k] for k in back], pa.binary())],
                        schema=out_schema)

    from pyspark.sql.pandas.types import to_arrow_type

    out_schema = pa.schema([("id", pa.int64()), *((f"c{k}", to_arrow_type(docs.schema[c].dataType)) for k, c in enumerate(carry)),
                            ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                            ("kept", pa.binary())])

    def answers(names: DataFrame) -> DataFrame:
        return names.groupBy("key").applyInArrow(tidy(lambda t: _answer(t, key_of)), BITS_SCHEMA)

    first = answers(dealt.groupBy("key").applyInArrow(tidy(name_sample), NAMES_SCHEMA))
    second = answers(dealt.groupBy("key").cogroup(first.groupBy("key")).applyInArrow(tidy(name_strings), NAMES_SCHEMA))
    out = dealt.groupBy("key").cogroup(first.unionByName(second).groupBy("key")).applyInArrow(tidy(cut_out), f"id long, {kinds + ', ' if carry else ''}n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
                      *(F.col(f"c{k}").alias(c) for k, c in enumerate(carry)), "n_bytes", "spans", "kept")
