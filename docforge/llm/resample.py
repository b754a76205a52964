"""Importance resampling towards a target distribution, ranked by parallel sorting by regular sampling.

1. *Counts.* Features are the runs of one and two consecutive words, hashed into buckets. Every task counts its texts into one array of
   ``buckets`` numbers; the arrays are summed by bucket. The gains of the buckets (one number each) go to all tasks.
2. *Weights.* A text's weight is the floored mean of the gains over its features, looked up in the array. A Gumbel term made from the id
   turns the weight into the score; the highest scores are a sample without replacement.
3. *Ranks.* The scored rows (numbers only) are sorted locally, each partition one run. Every run gives a regular sample, of
   positions at a fixed distance; samples of runs are merged and thinned in groups until few are left, and the splitters
   stand at regular places of the merged sample. Rows go to the segment between their two splitters, and each segment is
   merged into order by itself. The segments' counts, summed up, are the ranks their rows begin with. Segments that lie
   wholly beyond the drawn share are not exchanged at all.

A row's key is (score, id, number of the row), so rows with the same score and id, however many, are still divided among segments.

Defined results: a null text has no words; a text without words has no features and the weight 0. A null id counts as an empty one in
the hash and comes after all others in ties. Repeated rows are drawn as rows of their own. An empty target or corpus is
fine (all counts zero).
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import partitions, small_batches, stored, text_batches, tidy
from docforge.llm.shingles import text_bytes

CHARS = 1 << 20
#: Longest word whose checksum is computed in arrays; longer ones go one by one.
LONG_WORD = 48
#: Rows of a run's regular sample at least (at most twice as many), and runs whose samples are merged in one task.
SAMPLE, FAN = 64, 64

_TABLE = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\x00") for b in range(256)], np.uint32)  # linear part of one byte
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


# -- features -----------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """[length, place, byte]: a checksum's byte at that place, moved on by that many zero bytes (the checksum is linear)."""
    out = np.zeros((LONG_WORD + 2, 4, 256), np.uint32)
    for place in range(4):
        out[0, place] = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
    for n in range(1, len(out)):
        last = out[n - 1]
        out[n] = (last >> np.uint32(8)) ^ _TABLE[last & np.uint32(255)]
    return out


def _moved(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    s = _shifts()
    out = s[length, 0, crc & np.uint32(255)]
    for place in range(1, 4):
        out ^= s[length, place, (crc >> np.uint32(8 * place)) & np.uint32(255)]
    return out


def word_features(text: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Checksums of all words and of all pairs of consecutive words ("first second"), and the text of each.

    Words are runs of digits, letters a-z (A-Z in lower case) and bytes beyond ASCII.
    """
    raw, begin = text_bytes(text)
    low = _LOWER[raw]
    word = _WORD[low]
    first = np.zeros(len(raw) + 1, bool)
    first[begin[:-1]] = True
    first = first[:-1]
    start, stop = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | first[1:]
    stop[:-1] &= ~word[1:] | first[1:]
    start, stop = np.flatnonzero(start), np.flatnonzero(stop) + 1
    size = stop - start
    owner = np.searchsorted(begin, start, "right") - 1
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    short = np.flatnonzero(size <= LONG_WORD)
    now = short
    for k in range(int(size[short].max()) if len(short) else 0):
        now = now[size[now] > k]
        c = crc[now]
        crc[now] = _TABLE[(c ^ low[start[now] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    long = np.flatnonzero(size > LONG_WORD)
    for i in long.tolist():
        crc[i] = zlib.crc32(low[start[i] : stop[i]].tobytes())
    pair = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, np.int64)
    length = np.minimum(size[pair + 1], LONG_WORD)
    blank = np.full(len(pair), zlib.crc32(b" "), np.uint32)
    both = _moved(crc[pair], length + 1) ^ _moved(blank, length) ^ crc[pair + 1]
    for k in np.flatnonzero(size[pair + 1] > LONG_WORD).tolist():
        i = pair[k] + 1
        both[k] = zlib.crc32(b" " + low[start[i] : stop[i]].tobytes(), int(crc[i - 1]))
    return crc, owner, both, owner[pair]


def _bucket_counts(docs: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """How often each bucket's features occur in all texts (``buckets`` numbers, whatever the input)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for t in text_batches(batches, CHARS):
            one, _, two, _ = word_features(t["text"])
            for crc in (one, two):
                total += np.bincount((crc % np.uint32(buckets)).astype(np.int64), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    sums = (docs.select(F.col(text_col).alias("text")).mapInArrow(tidy(run), "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    buckets = len(corpus)
    s_all, t_all = int(corpus.sum()) + buckets, int(target.sum()) + buckets
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())],
                    np.int64)


def _weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Id, words, features and weight of every row."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in text_batches(batches, CHARS):
            n = t.num_rows
            one, of_one, two, of_two = word_features(t["text"])
            total, words, pairs = np.zeros(n + 1, np.int64), np.bincount(of_one, minlength=n), np.bincount(of_two, minlength=n)
            for crc, count in ((one, words), (two, pairs)):
                run_sum = np.concatenate([[0], np.cumsum(gain[(crc % np.uint32(buckets)).astype(np.int64)])])
                ends = np.cumsum(count)
                total[:n] += run_sum[ends] - run_sum[ends - count]
            features = words + pairs
            weight = np.where(features > 0, total[:n] // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([t["id"].combine_chunks(), pa.array(words.astype(np.int64)), pa.array(features.astype(np.int64)),
                                              pa.array(weight)], names=["id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        tidy(run), "id long, n_words long, n_features long, weight long")


def _score(seed: int) -> F.Column:
    """Weight plus a Gumbel term of the id's hash, in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


# -- parallel sorting by regular sampling -------------------------------------------------------------------

KEY_BYTES = 25  # score, whether the id is null, id, row


def _keys(score: np.ndarray, ids: pa.Array, row: np.ndarray) -> np.ndarray:
    """Keys as byte strings whose order is: score descending, id ascending (null last), row."""
    known = np.asarray(ids.is_valid())
    number = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros(len(score), np.dtype([("score", ">u8"), ("none", "u1"), ("id", ">u8"), ("row", ">u8")]))
    out["score"] = (~score.astype(np.int64)).view(np.uint64) ^ np.uint64(1 << 63)
    out["none"] = ~known
    out["id"] = number.view(np.uint64) ^ np.uint64(1 << 63)
    out["row"] = row.astype(np.uint64)
    return out.view(f"S{KEY_BYTES}")


def _samples(rows: DataFrame) -> DataFrame:
    """A regular sample of each locally sorted partition: every ``step``-th key, ``SAMPLE`` to twice as many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[bytes] = []
        step, seen = 1, 0
        for b in batches:
            keys = _keys(b.column(0).to_numpy(), b.column(1), b.column(2).to_numpy())
            take = np.arange((-seen - 1) % step, len(keys), step)  # positions step, 2 step, ... counted from 1
            held += [bytes(k).ljust(KEY_BYTES, b"\0") for k in keys[take]]
            seen += len(keys)
            while len(held) > 2 * SAMPLE:
                held, step = held[1::2], 2 * step
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([float(step)]),
                                              pa.array([held], pa.list_(pa.binary()))], names=["run", "step", "keys"])

    return rows.select("score", "id", "row").sortWithinPartitions(F.desc("score"), F.asc_nulls_last("id"), "row").mapInArrow(
        tidy(run), "run int, step double, keys array<binary>")


def _merged(samples: DataFrame) -> DataFrame:
    """Samples of ``FAN`` runs each merged into one. A key weighs the rows between it and its run's last one."""
    def run(t: pa.Table) -> pa.Table:
        pairs = sorted((k, s) for s, keys in zip(t["step"].to_pylist(), t["keys"].to_pylist()) for k in keys)
        whole = sum(s for _, s in pairs)
        step = max(1.0, whole / (2 * SAMPLE * FAN))
        keys, weight = [], 0.0
        for k, s in pairs:
            weight += s
            while weight >= step:  # a key that stands for several steps is named as often
                keys.append(k)
                weight -= step
        return pa.table({"run": pa.array([t["run"][0].as_py() // FAN], pa.int32()), "step": [step], "keys": pa.array([keys], pa.list_(pa.binary()))})

    return samples.groupBy(F.floor(F.col("run") / FAN)).applyInArrow(tidy(run), "run int, step double, keys array<binary>")


def splitters(rows: DataFrame, segments: int) -> list[bytes]:
    """At most ``segments`` - 1 keys that cut the rows into about equal segments."""
    samples = stored(_samples(rows), "samples")
    runs = (samples.agg(F.max("run")).first()[0] or 0) + 1
    while runs > FAN:  # few rounds: the runs become fewer by that factor in each
        samples, runs = stored(_merged(samples), "samples"), -(-runs // FAN)
    pairs = sorted((bytes(k), r["step"]) for r in samples.collect() for k in r["keys"])  # FAN samples of bounded size
    if not pairs:
        return []
    ends = np.cumsum([s for _, s in pairs])
    places = np.searchsorted(ends, ends[-1] * np.arange(1, segments) / segments)
    return sorted({pairs[p][0] for p in places.tolist()})


def ranks(rows: DataFrame, draw: int) -> DataFrame:
    """``rows`` (``score`` long, ``id`` long, ``row`` long unique, others) with ``rank``: 1, 2, ... up to ``draw`` in the order of their
    keys, null beyond. ``rows`` must be the same whenever read (a written table)."""
    spark = rows.sparkSession
    cuts = splitters(rows, partitions(spark))
    columns = rows.columns

    def segment_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.array(cuts, f"S{KEY_BYTES}")
        for b in batches:
            b = pa.Table.from_batches([b])
            keys = _keys(b["score"].combine_chunks().to_numpy(), b["id"].combine_chunks(), b["row"].combine_chunks().to_numpy())
            yield from b.append_column("segment", pa.array(np.searchsorted(at, keys, "left").astype(np.int32))).combine_chunks().to_batches()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.mapInArrow(tidy(segment_of), kinds + ", segment int")
    counts = {r["segment"]: r["count"] for r in dealt.groupBy("segment").count().collect()}  # one row a segment
    before, offset = 0, {}
    for s in range(len(cuts) + 1):
        offset[s] = before
        before += counts.get(s, 0)
    starts = [offset[s] for s in range(len(cuts) + 1)]
    last = bisect_right(starts, draw - 1) - 1 if draw > 0 else -1  # the last segment with a drawn row

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, nth = -1, 0
        for b in batches:
            own = b.column(b.schema.get_field_index("segment")).to_numpy()
            place = np.zeros(len(own), np.int64)
            edges = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for x, y in zip(edges, edges[1:]):
                if own[x] != segment:
                    segment, nth = int(own[x]), starts[own[x]]
                place[x:y] = nth + np.arange(1, y - x + 1)
                nth += y - x
            rank = pa.array(place, mask=place > draw)
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in columns), rank], names=[*columns, "rank"])

    near = (dealt.where(F.col("segment") <= last).repartitionById(len(cuts) + 1, F.col("segment"))
            .sortWithinPartitions("segment", F.desc("score"), F.asc_nulls_last("id"), "row").mapInArrow(tidy(number), kinds + ", rank long"))
    far = dealt.where(F.col("segment") > last).select(*(f"`{c}`" for c in columns), F.lit(None).cast("long").alias("rank"))
    return near.unionByName(far)


# -- the operator -------------------------------------------------------------------------------------------


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = 10_000,
             id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (all long) of every row of ``docs``.

    Of the N rows with at least ``min_words`` words, floor(``percent`` * N / 100) are drawn: rank 1, 2, ... by falling score, ties by smaller
    id; the rest have a null rank. Other columns of either table are not read.
    """
    small_batches(docs.sparkSession)
    gain = gains(_bucket_counts(docs, text_col, buckets), _bucket_counts(target, target_text, buckets))
    scored = (_weights(docs, gain, id_col, text_col).withColumn("score", _score(seed))
              .withColumn("row", F.monotonically_increasing_id()))
    scored = stored(scored, "scored")
    able = scored.where(F.col("n_words") >= min_words)
    draw = percent * able.count() // 100
    drawn = ranks(able, draw)
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    kind = docs.schema[id_col].dataType
    return drawn.unionByName(rest).select(F.col("id").cast(kind).alias(id_col), "n_words", "n_features", "weight", "score", "rank")
