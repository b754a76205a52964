"""Near-duplicate classes by a grouped prefix join on word shingles (Jaccard similarity, exact).

1. *Sets.* Every text becomes its set of shingle hashes. Texts of equal sets are one node from here on (the widest grouping: equal
   prefix, size and rest). A sketch of fixed size counts shingles over all documents; it only decides their order.
2. *Prefixes.* A set's members are ordered rare first (buckets of the sketch that stand out come last, ties by hash). Two
   sets as similar as asked share a member among their first ``n - ceil(t * n) + 1``. Prefix members are dealt by value; nodes
   with the same prefix and size form one group, which is put into one cluster without further pairing. Groups that share a
   prefix member are paired if sizes and the members' places allow the similarity (positional filter, the same for all nodes of
   a group). A list of more than ``LONG_LIST`` nodes is cut into blocks, and pairs of blocks are dealt as tasks, so no
   task gets an unbounded list.
3. *Filter.* The nodes of paired groups are compared by parity bits, a lower bound of their sets' difference. What passes is only
   used to put nodes into clusters (connected components).
4. *Expand and verify.* A cluster's texts come together, in pairs of blocks of bounded size if it is large, and all
   its pairs are counted exactly. Each task returns a spanning forest of the links it found; links of different texts
   are thus never dropped, but a class of m texts costs its task m - 1 rows. Components of these give the classes.

Nothing is dropped or capped: the order is exact for any sketch, blocks cover all pairs. Sets are told apart by 64-bit digests.

Defined results: a null or blank text has the empty set and is linked with nothing, not even with another blank one.
A null id orders before all others as id of a class only if the class has no other. Repeated rows are rows of one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.common import gather, mix64, partitions, small_batches, stored, text_batches, tidy
from docforge.llm.components import components
from docforge.llm.shingles import bits_apart, digests, parity_bits, shingle_sets

CHARS = 1 << 20
#: log2 of the sketch's counters; a bucket stands out from twice the mean plus STAND_OUT on. Order only, never results.
SKETCH_BITS, STAND_OUT = 20, 32
#: Counters of one row of the sketch.
SLICE_BITS = 14
#: Longest list of nodes that is paired in the task of its member, and nodes a block of a longer one holds.
LONG_LIST = 48
LIST_BLOCK = 1024
#: Shingles a block of a cluster holds (a larger text is a block of its own), and columns counted at once.
CLUSTER_BLOCK, COLUMNS = 1 << 19, 4096
#: A set counts as so many shingles at least, so a block has CLUSTER_BLOCK / LEAST_WEIGHT texts at most.
LEAST_WEIGHT = 512


#: Rows named by a broadcast at most (some 40 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1 << 15


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of sets of these sizes with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


# -- sets and sketch ----------------------------------------------------------------------------------------

_SETS = "kind int, id long, mark long, file long, line long, n int, node long, data binary"


_SETS_ARROW = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("mark", pa.int64()), ("file", pa.int64()), ("line", pa.int64()), ("n", pa.int32()), ("node", pa.int64()),
                         ("data", pa.binary())])


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """Kind 0: a row's id, hash of its text, place, set size, node and parity bits. Kind 1: a slice (n) of the task's sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        for t in text_batches(batches, CHARS):
            value, begin = shingle_sets(t["text"], size)
            sketch += np.bincount((value >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch))
            node = digests(value, begin, 0x51).view(np.int64)
            n = np.diff(begin)
            cut = begin.tolist()
            data = [parity_bits(value[a:b]) for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(len(n), np.int32)), *(t[c].combine_chunks() for c in ("id", "mark", "file", "line")),
                pa.array(n.astype(np.int32)), pa.array(node), pa.array(data, pa.binary())], names=_SETS_ARROW.names)
        for k, part in enumerate(sketch.reshape(-1, 1 << SLICE_BITS)):
            if part.any():
                yield pa.RecordBatch.from_pydict({"kind": [1], "id": [None], "mark": [None], "file": [None], "line": [None], "n": [k], "node": [0],
                                                  "data": [part.astype("<i8").tobytes()]}, _SETS_ARROW)

    return docs.select("id", "text", "mark", "file", "line").mapInArrow(tidy(run), _SETS)


def _standing_out(sets: DataFrame) -> np.ndarray:
    """The sketch's buckets that stand out, as packed bits (2**SKETCH_BITS bits, whatever the input)."""
    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(1 << SLICE_BITS, np.int64)
        for x in t["data"]:
            total += np.frombuffer(x.as_buffer(), "<i8")
        return pa.table({"n": t["n"].slice(0, 1).cast(pa.int32()), "data": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    counts = np.zeros(1 << SKETCH_BITS, np.int64).reshape(-1, 1 << SLICE_BITS)
    for r in sets.where("kind = 1").select("n", "data").groupBy("n").applyInArrow(tidy(add), "n int, data binary").collect():
        counts[r["n"]] = np.frombuffer(r["data"], "<i8")
    counts = counts.ravel()
    return np.packbits(counts > 2 * counts.mean() + STAND_OUT, bitorder="little")


# -- prefixes and pairs of groups ---------------------------------------------------------------------------

_ENTRY = np.dtype([("token", "<u8"), ("group", "<i8"), ("node", "<i8"), ("n", "<i4"), ("place", "<i4")])


def _prefixes(docs: DataFrame, common: np.ndarray, size: int, percent: int, parts: int) -> DataFrame:
    """Prefix entries of all sets, packed by range of member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = np.unpackbits(common, bitorder="little").astype(bool)
        for t in text_batches(batches, 2 * CHARS):
            value, begin = shingle_sets(t["text"], size)
            node = digests(value, begin, 0x51).view(np.int64)
            n = np.diff(begin)
            _, once = np.unique(node, return_index=True)
            once = once[n[once] > 0]
            found = []
            for d in once.tolist():
                own = value[begin[d] : begin[d + 1]]
                last = late[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                found.append(np.concatenate([own[~last], own[last]])[: prefix_length(n[d], percent)])
            if not found:
                continue
            length = np.fromiter(map(len, found), np.int64, len(found))
            entries = np.empty(int(length.sum()), _ENTRY)
            entries["token"] = np.concatenate(found)
            entries["node"] = np.repeat(node[once], length)
            entries["n"] = np.repeat(n[once], length)
            entries["place"] = gather(np.zeros(len(length), np.int64), length)
            ends = np.cumsum(length)
            group = digests(entries["token"], np.concatenate([[0], ends]), 0x67)
            entries["group"] = np.repeat(mix64(group + n[once].astype(np.uint64)).view(np.int64), length)
            part = (entries["token"] % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            entries = entries[by]
            cut = np.searchsorted(part[by], np.arange(parts + 1)).tolist()
            rows = [(p, entries[a:b].tobytes()) for p, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())],
                                             names=["part", "data"])

    return docs.select("id", "text").mapInArrow(tidy(run), "part int, data binary")


_PAIRS = "list long, u long, v long, nu int, nv int, place int, same boolean"
_PAIR_NAMES = ["list", "u", "v", "nu", "nv", "place", "same"]


def _pairs(t: pa.Table, percent: int) -> pa.Table:
    """Pairs of nodes of a range of members (list null), and the nodes of long lists (``v`` null).

    Nodes of one group (``same``) are paired with its smallest one only, once, and need no comparison to be in one cluster.
    """
    entries = np.concatenate([np.frombuffer(x.as_buffer(), _ENTRY) for x in t["data"]])
    entries = entries[np.lexsort((entries["node"], entries["group"], entries["n"], entries["token"]))]
    again = np.zeros(len(entries), bool)  # the same set from another batch
    again[1:] = (entries["token"][1:] == entries["token"][:-1]) & (entries["node"][1:] == entries["node"][:-1])
    entries = entries[~again]
    new = np.ones(len(entries), bool)
    new[1:] = (entries["token"][1:] != entries["token"][:-1]) | (entries["group"][1:] != entries["group"][:-1])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(entries)), 0))
    inner = np.flatnonzero(~new & (entries["place"] == 0))  # one of the group's lists is enough
    out = [_table(None, entries[lead[inner]], entries[inner], np.ones(len(inner), bool))]
    edge = np.flatnonzero(np.concatenate([[True], entries["token"][1:] != entries["token"][:-1], [True]]))
    length = np.repeat(np.diff(edge), np.diff(edge))
    groups = np.add.reduceat(new.astype(np.int64), edge[:-1]) if len(entries) else np.zeros(0, np.int64)
    groups = np.repeat(groups, np.diff(edge))  # groups of the entry's list; one alone needs no pairs
    some = entries[(groups > 1) & (length <= LONG_LIST)]
    for lag in range(1, min(LONG_LIST, len(some))):  # sizes ascend within a list
        a, b = some[:-lag], some[lag:]
        ok = a["token"] == b["token"]
        if not ok.any():
            break
        ok &= a["group"] != b["group"]
        a, b = a[ok], b[ok]
        ok = _allowed(a, b, percent)
        out.append(_table(None, a[ok], b[ok], np.zeros(int(ok.sum()), bool)))
    long = entries[(groups > 1) & (length > LONG_LIST)]
    out.append(_table(long["token"].view(np.int64), long, None, np.zeros(len(long), bool)))
    return pa.concat_tables(out)


def _allowed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sizes, and the sets beyond the shared member's places, allow the similarity."""
    na, nb = a["n"].astype(np.int64), b["n"].astype(np.int64)
    rest = np.minimum(na - a["place"], nb - b["place"])
    return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (rest >= least_overlap(na, nb, percent))


def _table(lists: np.ndarray | None, a: np.ndarray, b: np.ndarray | None, same: np.ndarray) -> pa.Table:
    none = lambda kind: pa.nulls(len(a), kind)
    column = lambda x: pa.array(np.ascontiguousarray(x))
    return pa.table([
        none(pa.int64()) if lists is None else column(lists), column(a["node"]), none(pa.int64()) if b is None else column(b["node"]),
        column(a["n"]), none(pa.int32()) if b is None else column(b["n"]), column(a["place"]), column(same)], names=_PAIR_NAMES)


def _close(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs that their parity bits allow to be as similar as asked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v, nu, nv, x, y = (b.column(k).to_pylist() for k in range(6))
            ok = [k for k in range(len(u)) if bits_apart(x[k], y[k]) <= nu[k] + nv[k] - 2 * least_overlap(nu[k], nv[k], percent)]
            yield pa.RecordBatch.from_arrays([pa.array([u[k] for k in ok], pa.int64()), pa.array([v[k] for k in ok], pa.int64())],
                                             names=["u", "v"])

    both = (pairs.join(bits.select(F.col("node").alias("u"), F.col("data").alias("bu")), "u")
            .join(bits.select(F.col("node").alias("v"), F.col("data").alias("bv")), "v"))
    return both.select("u", "v", "nu", "nv", "bu", "bv").mapInArrow(tidy(run), "u long, v long")


# -- blocks -------------------------------------------------------------------------------------------------


def _dealt(members: DataFrame, group: str, weight: F.Column, block: int, order: str) -> DataFrame:
    """``members`` with ``blocks`` (how many their group is cut into, from its summed weight) and ``own``, their block, by hash of ``order``."""
    sizes = members.groupBy(group).agg(F.ceil(F.sum(weight) / block).cast("int").alias("blocks"))
    return members.join(sizes, group).withColumn("own", F.pmod(F.xxhash64(F.col(order)), F.col("blocks")).cast("int"))


def _block_pairs(dealt: DataFrame) -> DataFrame:
    """Every row once for every pair of blocks of its group that it belongs to: columns ``i`` <= ``j``."""
    return (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("blocks", "other"))


def _by_group(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Sorted batches cut into the tables of one group each."""
    held: list[pa.Table] = []
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        change = np.zeros(b.num_rows, bool)
        for k in keys:
            c = t[k].to_numpy()
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for x, y in zip(cuts, cuts[1:]):
            part = t.slice(x, y - x)
            if held and any(held[-1][k][0] != part[k][0] for k in keys):
                yield pa.concat_tables(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held)


class _Forest:
    """A spanning forest, grown row by row so that no task holds all links of a dense block."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.u: list[int] = []
        self.v: list[int] = []

    def join(self, k: int, others: np.ndarray) -> None:
        """Link ``k`` with ``others``; one edge for each tree that it isn't in yet."""
        others = others[self.label[others] != self.label[k]]
        if len(others):
            trees, first = np.unique(self.label[others], return_index=True)
            self.u += [k] * len(first)
            self.v += others[first].tolist()
            self.label[np.isin(self.label, trees)] = self.label[k]

    def edges(self, node: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(node[np.asarray(self.u, np.int64)], pa.int64()),
                                           pa.array(node[np.asarray(self.v, np.int64)], pa.int64())], names=["u", "v"])


def _long_lists(members: DataFrame, bits: DataFrame, percent: int, parts: int) -> DataFrame:
    """Edges that put the nodes of long lists that may be similar into one cluster."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_group(batches, ("list", "i", "j")):
            t = t.sort_by([("n", "ascending"), ("u", "ascending")])
            node, n, place = (t[c].to_numpy().astype(np.int64) for c in ("u", "n", "place"))
            own = t["own"].to_numpy()
            data = t["bits"].to_pylist()
            cross = t["i"][0] != t["j"][0]
            # bits are compared folded to the smaller set's length; sizes that may be similar differ by one halving at most
            length = np.fromiter(map(len, data), np.int64, len(data))
            folded, row = {}, np.zeros((len(data), 2), np.int64)
            for size in np.unique(length).tolist():
                for step in (0, 1):
                    at = np.flatnonzero(length == size << step)
                    row[at, step] = np.arange(len(at)) + (len(folded[size]) if step else 0)
                    own_bits = [np.stack([_fold(data[k], size) for k in at.tolist()])] if len(at) else []
                    folded[size] = np.concatenate([folded[size], *own_bits]) if step else own_bits[0]
            forest = _Forest(len(node))
            for k in range(len(node) - 1):
                need = least_overlap(n[k], n[k + 1 :], percent)
                ok = (100 * n[k] >= percent * n[k + 1 :]) & (np.minimum(n[k] - place[k], (n - place)[k + 1 :]) >= need)
                if cross:
                    ok &= own[k + 1 :] != own[k]
                later = np.flatnonzero(ok) + k + 1
                if not len(later):
                    continue
                bits_of = folded[length[k]]
                rows_of = row[later, np.where(length[later] == length[k], 0, 1)]
                apart = np.bitwise_count(bits_of[rows_of] ^ bits_of[row[k, 0]]).sum(axis=1, dtype=np.int64)
                later = later[apart <= n[k] + n[later] - 2 * least_overlap(n[k], n[later], percent)]
                forest.join(k, later)
            yield forest.edges(node)

    rows = _block_pairs(_dealt(members.select("list", "u", F.col("nu").alias("n"), "place"), "list", F.lit(1), LIST_BLOCK, "u"))
    rows = rows.join(bits.select(F.col("node").alias("u"), F.col("data").alias("bits")), "u")
    return (rows.select("list", "i", "j", "own", "u", "n", "place", "bits").repartition(parts, "list", "i", "j")
            .sortWithinPartitions("list", "i", "j").mapInArrow(tidy(run), "u long, v long"))


def _fold(data: bytes, length: int) -> np.ndarray:
    x = np.frombuffer(data, np.uint8)
    while len(x) > length:
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return x


def _overlaps(value: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sizes of all pairwise intersections of n sets, from members and their sets."""
    _, column, count = np.unique(value, return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    out = np.zeros((n, n), np.float32)
    by = np.argsort(column, kind="stable")
    column, owner = column[by], owner[by]
    for start in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        has = np.zeros((n, COLUMNS), np.float32)
        has[owner[a:b], column[a:b] - start] = 1
        out += has @ has.T
    return out


def _links(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Spanning forests of the links within clusters, counted exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_group(batches, ("cluster", "i", "j")):
            value, begin = shingle_sets(t["text"], size)
            n = np.diff(begin)
            node, own = t["node"].to_numpy(), t["own"].to_numpy()
            common = _overlaps(value, np.repeat(np.arange(len(n)), n), len(n))
            cross = t["i"][0] != t["j"][0]
            forest = _Forest(len(n))
            for k in range(len(n) - 1):
                shared = common[k, k + 1 :].astype(np.int64)
                link = 100 * shared >= percent * (n[k] + n[k + 1 :] - shared)
                if cross:
                    link &= own[k + 1 :] != own[k]
                forest.join(k, np.flatnonzero(link) + k + 1)
            yield forest.edges(node)

    return rows.select("cluster", "i", "j", "own", "node", "text").mapInArrow(tidy(run), "u long, v long")


# -- the join -----------------------------------------------------------------------------------------------


def _placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__file`` and ``__line``, a row's file (hashed) and place in it: the same whenever and however the files are read.

    What doesn't come from files is written to the shared folder first (and is then read from there)."""
    here = [F.xxhash64(F.col("_metadata.file_path")).alias("__file"), F.col("_metadata.row_index").alias("__line")]
    own = [F.col(f"`{c}`") for c in docs.columns]
    try:
        if not any(c.startswith("_metadata") for c in docs.columns):
            return docs.select(*own, *here)
    except AnalysisException:
        pass  # no files behind it
    kept = stored(docs.toDF(*(f"c{k}" for k in range(len(docs.columns)))), "rows")
    return kept.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(docs.columns)), *here)


def _at(rows: DataFrame, places: DataFrame, count: int | None, how: str) -> DataFrame:
    """``rows`` joined with ``places`` (``file``, ``line``; at most one row a place): broadcast if these are few, else by a shuffle."""
    if count is not None and count <= BROADCAST_ROWS:
        places = F.broadcast(places)
    return rows.join(places, ["file", "line"], how)


def classes(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links) of every row, ``text_mark``
    (Spark's xxhash64 of the text), which with the id finds the row again, and ``root``, the class itself (null without shingles):
    classes that are not linked can have one ``component_id``, if ids repeat or are null.

    Rows are found again by file and place in it, so ids and texts may repeat as often as they like.

    Two rows are linked when 100 * (shared shingles) >= ``percent`` * (shingles of either).
    """
    found = _classes(_placed(docs.select(id_col, text_col)), size, percent, id_col, text_col)
    kind = docs.schema[id_col].dataType
    return found.select(F.col("id").cast(kind).alias(id_col), "n_shingles", F.col("component").cast(kind).alias("component_id"),
                        F.col("mark").alias("text_mark"), "root")


def _classes(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``mark``, ``file``, ``line``, ``n_shingles``, ``component`` and ``root`` of every row of a placed table."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    spark = docs.sparkSession
    small_batches(spark)
    parts = partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("mark"), F.col("__file").alias("file"), F.col("__line").alias("line"))
    table = stored(_sets(rows, size), "sets")
    common = _standing_out(table)
    sets = table.where("kind = 0")
    # a node's text is that of one row, the first by place
    nodes = stored(sets.where("n > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.min(F.struct("file", "line")).alias("row"), F.first("n").alias("n"),
        F.first("data").alias("data")), "nodes")
    bits = nodes.select("node", "data")
    pairs = stored(_prefixes(rows, common, size, percent, parts).groupBy("part").applyInArrow(tidy(lambda t: _pairs(t, percent)), _PAIRS), "pairs")
    found = pairs.where("v is not null").groupBy("u", "v").agg(
        F.first("nu").alias("nu"), F.first("nv").alias("nv"), F.max("same").alias("same"))
    maybe = (_close(found.where("not same"), bits, percent).unionByName(found.where("same").select("u", "v"))
             .unionByName(_long_lists(pairs.where("list is not null"), bits, percent, parts)))
    clusters = stored(components(maybe).withColumnRenamed("root", "cluster"), "clusters")
    members = clusters.join(nodes.select("node", "row.file", "row.line", "n"), "node")
    members = stored(_dealt(members, "cluster", F.greatest("n", F.lit(LEAST_WEIGHT)), CLUSTER_BLOCK, "node"), "members")
    # the texts of clusters are found by place, and copied for their pairs of blocks after that
    texts = _block_pairs(_at(rows.select("file", "line", "text"), members, members.count(), "inner"))
    together = (texts.select("cluster", "i", "j", "own", "node", "text")
                .repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node"))
    roots = components(_links(together, size, percent))
    found = nodes.select("node", "id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = found.groupBy("root").agg(F.min("id").alias("component"))
    of = found.join(least, "root").select("node", "component", "root")
    return (sets.join(of, "node", "left").select(
        "id", "mark", "file", "line", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"), "root"))


def one_of_each(docs: DataFrame, *, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each class stays: that of the class's id. Blank texts all stay, and rows of
    one id, or of none, whose texts are not linked.

    Who goes is decided on places and numbers alone; the rows themselves are read once more and move only if
    very many go."""
    placed = _placed(docs)
    found = stored(_classes(placed, size, percent, id_col, text_col), "classes")
    own = F.col("id").eqNullSafe(F.col("component"))
    stay = (found.where(own & (F.col("n_shingles") > 0)).groupBy("root").agg(F.min(F.struct("mark", "file", "line")).alias("s"))
            .select(F.col("s.file").alias("file"), F.col("s.line").alias("line")))
    gone = stored(found.where("n_shingles > 0").select("file", "line").join(stay, ["file", "line"], "left_anti"), "gone")
    rows = placed.withColumnsRenamed({"__file": "file", "__line": "line"}) if not {"file", "line"} & set(docs.columns) else None
    if rows is None:  # columns of these names: aside for the join
        rows = placed.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("__file").alias("file"), F.col("__line").alias("line"))
        return _at(rows, gone, gone.count(), "left_anti").select(*(F.col("row")[c].alias(c) for c in docs.columns))
    return _at(rows, gone, gone.count(), "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
