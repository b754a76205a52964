"""Token ids written with Re-Pair grammar compression, and read back by random access.

A file is Parquet, written and read by Spark, with one row a block. Blocks hold whole documents in ascending
document id; (shard, block) ascends with it. A block's columns: its documents' ids and token counts, the
grammar (``rules``: two symbols a rule) with the expansion length of each rule, the symbols of the block (two bytes each, four for a
tokenizer that leaves no room in two), and where each document's symbols begin, so any document is decoded without the rest of its block.

Re-Pair is run by rounds over whole arrays: a round counts all adjacent pairs, takes the most frequent ones that
pay, and replaces their occurrences by new symbols. Where chosen pairs overlap, the more frequent one wins; of a run of
one symbol every second pair is taken. The others are counted again in the next round. Rounds end when no pair pays for its
rule, or all symbols of that width are used. The end id never joins a pair,
so no symbol spans two documents.

Defined results: a null text is empty (only the end id); a null document id sorts first; equal ids keep together and
are ordered by text. An empty table gives files without rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docforge.llm.bpe import encoder
from docforge.llm.common import gather, partitions, small_batches, text_batches

#: Ids a block holds at least (its last document may be longer): bounds a task's memory.
BLOCK_IDS = 1 << 21
#: Characters that one call of the encoder gets.
CHARS = 1 << 20
#: New rules in one round. A pair becomes one if it is seen MIN_COUNT times and replaced PAYS times (a rule takes two symbols).
ROUND_RULES, MIN_COUNT, PAYS = 4096, 6, 4
BUCKET_BITS = 20
#: Passes in a round that choose occurrences; what the last one leaves is counted again in the next round.
SELECTIONS = 8

BLOCK_SCHEMA = ("shard int, block int, n_docs int, n_ids long, doc_ids binary, null_ids binary, doc_tokens binary, "
                "n_terminals int, width int, rules binary, rule_lengths binary, symbols binary, doc_symbols binary")


@dataclass
class Grammar:
    terminals: int
    rules: np.ndarray  # (n, 2) symbols
    lengths: np.ndarray  # ids each rule expands to

    def expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pool of ids with the offset and length of each symbol's expansion."""
        length = np.concatenate([np.ones(self.terminals, np.int64), self.lengths.astype(np.int64)])
        offset = np.cumsum(length) - length
        pool = np.empty(int(length.sum()), np.int32)
        pool[: self.terminals] = np.arange(self.terminals)
        at = self.terminals
        for k, (a, b) in enumerate(self.rules.tolist(), self.terminals):
            at, half = int(offset[k]), int(length[a])
            pool[at : at + half] = pool[offset[a] : offset[a] + half]
            pool[at + half : at + int(length[k])] = pool[offset[b] : offset[b] + int(length[b])]
        return pool, offset, length


def width_of(terminals: int) -> int:
    """Bytes of a symbol: two where they leave room for a round of rules."""
    return 2 if terminals + ROUND_RULES <= 1 << 16 else 4


def compress(ids: np.ndarray, terminals: int, barrier: int) -> tuple[np.ndarray, Grammar]:
    """Symbols and grammar of ``ids``; no rule holds ``barrier``.

    Rounds go on until no pair pays for its rule, or symbols of the block's width are used up. Pairs are first counted by a hash of
    ``BUCKET_BITS`` bits; only pairs of buckets that may hold one of the most frequent are counted exactly. Counts of old pairs only
    fall, so a place is looked at again only if its pair was frequent or one of its symbols is new.
    """
    width = width_of(terminals)
    bits = np.uint64(32) if width == 4 else np.uint32(16)
    x = ids.astype(type(bits))
    rules: list[np.ndarray] = []
    lengths = [np.ones(terminals, np.int64)]
    known = lengths[0]
    size = terminals
    places = np.flatnonzero((x[:-1] != barrier) & (x[1:] != barrier))  # where a frequent pair may begin
    while len(places) and (room := min(ROUND_RULES, (1 << 8 * width) - size)) > 0:
        pair = (x[places] << bits) | x[places + 1]
        bucket = _bucket(pair)
        count = np.bincount(bucket, minlength=1 << BUCKET_BITS)
        frequent = (count >= MIN_COUNT)[bucket]
        places, pair, bucket = places[frequent], pair[frequent], bucket[frequent]
        looked = (count >= int(np.partition(count, -room)[-room]))[bucket]
        ordered = np.sort(pair[looked])
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(ordered) else np.zeros(1, np.int64)
        count = np.diff(edge)
        good = np.flatnonzero(count >= MIN_COUNT)
        if not len(good):
            break
        if len(good) > room:
            good = good[np.argpartition(-count[good], room - 1)[:room]]
        keys, count = ordered[edge[good]], count[good]
        keys = keys[np.lexsort((keys, -count))]  # the most frequent first
        table = np.full(1 << BUCKET_BITS, -1, np.int32)
        table[_bucket(keys[::-1])] = np.arange(len(keys) - 1, -1, -1)  # of two in one bucket the better stays
        rank = table[bucket]
        fits = (rank >= 0) & (keys[rank] == pair)
        at, rank = _disjoint(places[fits], rank[fits])
        pays = np.bincount(rank, minlength=len(keys)) >= PAYS
        at, rank = at[pays[rank]], rank[pays[rank]]
        used = np.flatnonzero(pays)
        if not len(used):
            break
        pairs = np.stack([keys[used] >> bits, keys[used] & ((type(bits)(1) << bits) - type(bits)(1))], axis=1).astype(np.int64)
        rules.append(pairs)
        lengths.append(known[pairs].sum(axis=1))
        known = np.concatenate([known, lengths[-1]])
        x[at] = (size + (np.cumsum(pays) - 1)[rank]).astype(x.dtype)
        keep = np.ones(len(x), bool)
        keep[at + 1] = False
        again = np.zeros(len(x), bool)
        again[places] = True
        again[at] = True
        again = again[keep]
        x = x[keep]
        fresh = x >= size
        again[:-1] |= fresh[1:]
        places = np.flatnonzero(again[:-1] & (x[:-1] != barrier) & (x[1:] != barrier))
        size += len(used)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return x.astype(np.int64), Grammar(terminals, table, known[terminals:])


def _bucket(pair: np.ndarray) -> np.ndarray:
    mix, bits = (np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BUCKET_BITS)) if pair.dtype == np.uint64 else (np.uint32(0x9E3779B1), np.uint32(32 - BUCKET_BITS))
    return ((pair * mix) >> bits).astype(np.int64)


def _disjoint(at: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-overlapping ones of the occurrences ``at`` (ascending), the better rank first; in runs of one rank every second."""
    places, ranks = [], []
    for _ in range(SELECTIONS):
        if not len(at):
            break
        touch = np.diff(at) == 1
        before, after = np.concatenate([[False], touch]), np.concatenate([touch, [False]])
        left = np.where(before, np.concatenate([[0], rank[:-1]]), np.iinfo(np.int32).max)
        right = np.where(after, np.concatenate([rank[1:], [0]]), np.iinfo(np.int32).max)
        index = np.arange(len(at))
        run = index - np.maximum.accumulate(np.where(rank == left, 0, index))
        take = (rank <= left) & (rank <= right) & (run % 2 == 0)
        places.append(at[take])
        ranks.append(rank[take])
        rest = ~take
        rest[1:] &= ~(take[:-1] & before[1:])
        rest[:-1] &= ~(take[1:] & after[:-1])
        at, rank = at[rest], rank[rest]
    if not places:
        return at, rank
    return np.concatenate(places), np.concatenate(ranks)


def write(docs: DataFrame, path: str, tokenizer: str, *, end_id: int, shards: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every document's ids, ``end_id`` appended, in ascending document id under ``path``.

    One shuffle: texts are range-partitioned by id into ``shards`` partitions (default: the session's shuffle
    partitions); a partition is encoded and compressed block by block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = shards or partitions(spark)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        terminals = max(enc.model.size, end_id + 1)
        width = width_of(terminals)
        shard, block = TaskContext.get().partitionId(), 0
        held_ids, held_tokens, held, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids, tokens = np.concatenate(held), np.concatenate(held_tokens)
            symbols, grammar = compress(ids, terminals, end_id)
            ends = np.flatnonzero(symbols == end_id) if end_id not in _inner(ids, tokens) else _ends(symbols, grammar, tokens)
            begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.zeros(0, np.int64)
            null = np.fromiter((x is None for x in held_ids), np.uint8, len(held_ids))
            doc_ids = np.fromiter((x or 0 for x in held_ids), np.int64, len(held_ids))
            row = [shard, block, len(held_ids), int(tokens.sum()), doc_ids.astype("<i8").tobytes(), null.tobytes(),
                   tokens.astype("<i8").tobytes(), terminals, width, grammar.rules.astype(f"<u{width}").tobytes(),
                   grammar.lengths.astype("<i8").tobytes(), symbols.astype(f"<u{width}").tobytes(), begins.astype("<i8").tobytes()]
            return pa.RecordBatch.from_pylist([dict(zip(BLOCK_ARROW.names, row))], BLOCK_ARROW)

        for t in text_batches(batches, CHARS):
            ids, begins = enc.encode(t["text"].to_pylist())
            ids = np.insert(ids, begins[1:], end_id)
            held.append(ids)
            held_tokens.append(np.diff(begins) + 1)
            held_ids += t["id"].to_pylist()
            total += len(ids)
            if total >= BLOCK_IDS:
                yield flush()
                block, held_ids, held_tokens, held, total = block + 1, [], [], [], 0
        if held:
            yield flush()

    (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
     .repartitionByRange(n, "id").sortWithinPartitions("id", "text")
     .mapInArrow(blocks, BLOCK_SCHEMA).write.mode("error").parquet(path))


BLOCK_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()),
                         ("doc_ids", pa.binary()), ("null_ids", pa.binary()), ("doc_tokens", pa.binary()),
                         ("n_terminals", pa.int32()), ("width", pa.int32()), ("rules", pa.binary()), ("rule_lengths", pa.binary()),
                         ("symbols", pa.binary()), ("doc_symbols", pa.binary())])


def _inner(ids: np.ndarray, tokens: np.ndarray) -> set[int]:
    """The end id, if it also stands inside a document."""
    ends = np.cumsum(tokens) - 1
    last = set(np.unique(ids[ends]).tolist()) if len(ends) else set()
    return {e for e in last if int((ids == e).sum()) > len(ends)}


def _ends(symbols: np.ndarray, grammar: Grammar, tokens: np.ndarray) -> np.ndarray:
    """Index of each document's last symbol, from the expansion lengths."""
    length = np.concatenate([np.ones(grammar.terminals, np.int64), grammar.lengths])[symbols]
    return np.searchsorted(np.cumsum(length), np.cumsum(tokens))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: ``shard``, ``block``, ``doc_id``, ``n_tokens``, ``before`` (ids before it in its
    block) and ``ids`` (binary, little-endian unsigned 32-bit). Blocks are expanded whole; ``read_some`` reads documents alone."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                rules = np.frombuffer(row["rules"], f"<u{row['width']}").reshape(-1, 2)
                pool, offset, length = Grammar(row["n_terminals"], rules, np.frombuffer(row["rule_lengths"], "<i8")).expansions()
                symbols = np.frombuffer(row["symbols"], f"<u{row['width']}").astype(np.int64)
                begins = np.append(np.frombuffer(row["doc_symbols"], "<i8"), len(symbols))
                tokens = np.frombuffer(row["doc_tokens"], "<i8")
                before = np.cumsum(tokens) - tokens
                data = pool[gather(offset[symbols], length[symbols])].astype("<u4").tobytes()
                at = (np.append(np.cumsum(length[symbols]) - length[symbols], length[symbols].sum())[begins] * 4).tolist()
                null = np.frombuffer(row["null_ids"], np.uint8).astype(bool)
                n = row["n_docs"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, row["shard"], np.int32)), pa.array(np.full(n, row["block"], np.int32)),
                    pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=null), pa.array(tokens), pa.array(before),
                    pa.array([data[s:e] for s, e in zip(at, at[1:])], pa.binary())],
                    names=["shard", "block", "doc_id", "n_tokens", "before", "ids"])

    small = "shard int, block int, doc_id long, n_tokens long, before long, ids binary"
    return spark.read.parquet(path).mapInArrow(expand, small)


def read_some(spark: SparkSession, path: str, doc_ids: list[int | None], start: int = 0, stop: int | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (as of ``read``) from place ``start`` to before ``stop`` of every document with one of
    ``doc_ids``. Only their blocks' symbols are read, and only symbols that reach into the places asked for are expanded."""
    if start < 0 or (stop is not None and stop < 0):
        raise ValueError("places count from the document's first id")
    wanted = {x for x in doc_ids if x is not None}
    numbers = np.array(sorted(wanted), np.int64)
    nulls = len(wanted) < len(set(doc_ids))

    def chosen(row: dict) -> np.ndarray:
        null = np.frombuffer(row["null_ids"], np.uint8).astype(bool)
        return np.flatnonzero(np.where(null, nulls, np.isin(np.frombuffer(row["doc_ids"], "<i8"), numbers)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                if len(chosen(row)):
                    yield pa.RecordBatch.from_pydict({"shard": pa.array([row["shard"]], pa.int32()), "block": pa.array([row["block"]], pa.int32())})

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                rules = np.frombuffer(row["rules"], f"<u{row['width']}").reshape(-1, 2).astype(np.int64)
                length = np.concatenate([np.ones(row["n_terminals"], np.int64), np.frombuffer(row["rule_lengths"], "<i8")])
                symbols = np.frombuffer(row["symbols"], f"<u{row['width']}")
                begins = np.append(np.frombuffer(row["doc_symbols"], "<i8"), len(symbols))
                tokens, ids = np.frombuffer(row["doc_tokens"], "<i8"), np.frombuffer(row["doc_ids"], "<i8")
                null = np.frombuffer(row["null_ids"], np.uint8)
                for k in chosen(row).tolist():
                    own = symbols[begins[k] : begins[k + 1]].astype(np.int64)
                    ends = np.cumsum(length[own])
                    last = int(tokens[k]) if stop is None else min(stop, int(tokens[k]))
                    first = min(start, last)
                    a, z = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, last)) + 1
                    skip = first - (int(ends[a - 1]) if a else 0)
                    out = _expanded(own[a:z], rules, row["n_terminals"])[skip : skip + last - first] if last > first else own[:0]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([None if null[k] else int(ids[k])], pa.int64()), "n_tokens": pa.array([int(tokens[k])], pa.int64()),
                        "ids": pa.array([out.astype("<u4").tobytes()], pa.binary())})

    blocks = spark.read.parquet(path)
    found = blocks.select("shard", "block", "doc_ids", "null_ids").mapInArrow(find, "shard int, block int").collect()
    places: dict[int, list[int]] = {}
    for r in found:
        places.setdefault(r["shard"], []).append(r["block"])
    where = F.lit(False)
    for shard, of in places.items():
        where |= (F.col("shard") == shard) & F.col("block").isin(of)
    return blocks.where(where).mapInArrow(expand, "doc_id long, n_tokens long, ids binary")


def _expanded(symbols: np.ndarray, rules: np.ndarray, terminals: int) -> np.ndarray:
    x = symbols
    while (big := x >= terminals).any():
        size = 1 + big
        at = (np.cumsum(size) - size)[big]
        pair = rules[x[big] - terminals]
        x = np.repeat(x, size)
        x[at], x[at + 1] = pair[:, 0], pair[:, 1]
    return x


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """``shard``, ``block`` and ``first``: ids of all blocks before it. Reads two numbers a block; the window over all
    rows is over one row a shard."""
    blocks = spark.read.parquet(path).select("shard", "block", "n_ids")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    up = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = shards.select("shard", F.coalesce(F.sum("ids").over(up), F.lit(0)).alias("shard_first"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("own"))
            .join(firsts, "shard").select("shard", "block", (F.col("own") + F.col("shard_first")).alias("first")))

