"""Change capture from two snapshots of a source (STR-1).

A snapshot is a folder with the rows, partitioned by range of the id's hash and sorted by leaf within each file, and a hash tree: a leaf has
the count and digests of the rows whose id's hash lies in its range, an inner node those of its ``2**STEP`` children
(hashes of hashes). Two snapshots are compared from the root down: below equal nodes nothing is looked at. Only rows
of unequal leaves are read (partition filter on the range, pushed filter on the leaf) and joined by id.

Digests are sums and parities of two 64-bit hashes of a row, in any order, combined per task before the shuffle, so a hot
leaf is no single task's load. The tree has a fixed size (``2**bits`` leaves), whatever the rows; it should have more
leaves than there are changes between two snapshots.

Defined results: a row counts as all its columns, in the order of their names. Rows that repeat an id are compared as one: it is an update if any of
them differs, comes or goes. A null id is an id of its own. Columns added or dropped between the snapshots make every row an update.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a level of the tree, and of the ranges that rows are partitioned by.
STEP, RANGE_BITS = 4, 6
#: Unequal leaves up to which they are named in the scan's filter; above, ranges alone prune.
NAMED_LEAVES = 4096
_ROWS = "_id string, _leaf int, _h1 long, _h2 long, _range int"


def _hashable(f: T.StructField) -> Column:
    """Maps have no hash of their own, their entries in key order have."""
    col = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.MapType):
        return F.array_sort(F.map_entries(col))
    return F.to_json(F.struct(col)) if "map<" in f.dataType.simpleString() else col


def _marked(rows: DataFrame, id_col: str, bits: int) -> DataFrame:
    """``_id`` (as text), ``_leaf`` and the row's two hashes."""
    fields = sorted(rows.schema.fields, key=lambda f: f.name)
    names = F.lit(",".join(f.name for f in fields))
    values = [_hashable(f) for f in fields]
    # a null leaves a hash as it was, so which values are null is hashed too
    nulls = F.concat(*[F.when(v.isNull(), F.lit("1")).otherwise(F.lit("0")) for v in values])
    key = F.col(f"`{id_col}`").cast("string")
    return rows.select(key.alias("_id"), F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int").alias("_leaf"),
                       F.xxhash64(names, nulls, *values).alias("_h1"), F.xxhash64(nulls, F.lit(1), *values, names).alias("_h2"))


def _digests(h1: Column, h2: Column, n: Column) -> list[Column]:
    return [F.sum(n).alias("n"), F.sum(h1.cast("decimal(38,0)")).alias("s"), F.bit_xor(h2).alias("x")]


def write_snapshot(rows: DataFrame, path: str, id_col: str = "id", bits: int = 12) -> None:
    """Ids, leaves and hashes of ``rows`` under ``path``/rows, the tree under ``path``/tree. The source is read once."""
    if bits < RANGE_BITS or bits % STEP:
        raise ValueError(f"bits must be a multiple of {STEP}, {RANGE_BITS + 2} or more")
    spark = rows.sparkSession
    (_marked(rows, id_col, bits).withColumn("_range", F.shiftright("_leaf", bits - RANGE_BITS))
     .repartitionByRange("_leaf", "_h1")  # hashes, not rows; whole leaves lie together, a hot one is split
     .sortWithinPartitions("_range", "_leaf").write.partitionBy("_range").parquet(f"{path}/rows"))
    level = spark.read.schema(_ROWS).parquet(f"{path}/rows").groupBy(F.col("_leaf").alias("node")).agg(*_digests(F.col("_h1"), F.col("_h2"), F.lit(1)))
    tree = [level.select(F.lit(bits).alias("level"), "node", "n", "s", "x")]
    for depth in range(bits - STEP, -1, -STEP):
        hashes = [F.xxhash64(F.lit(seed), "node", "n", F.col("s").cast("string"), "x") for seed in (1, 2)]
        level = level.groupBy(F.shiftright("node", STEP).alias("node")).agg(*_digests(*hashes, F.col("n")))
        tree.append(level.select(F.lit(depth).alias("level"), "node", "n", "s", "x"))
    whole = tree[0]
    for one in tree[1:]:
        whole = whole.unionByName(one)
    whole.coalesce(1).write.parquet(f"{path}/tree")  # a fixed number of rows


def unequal_leaves(spark: SparkSession, old: str, new: str) -> tuple[list[int], int]:
    """Leaves that differ between two snapshots, found from the root down, and the tree's bits."""
    trees = [spark.read.parquet(f"{p}/tree") for p in (old, new)]
    bits = [t.agg(F.max("level")).first()[0] for t in trees]
    if None not in bits and bits[0] != bits[1]:
        raise ValueError("the snapshots' trees differ in size")
    depth = max((b for b in bits if b is not None), default=0)
    open_ = [0]
    for level in range(0, depth + 1, STEP):
        below = F.shiftright("node", STEP if level else 0).isin(open_)
        a, b = (t.where((F.col("level") == level) & below) for t in trees)
        same = (F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.s").eqNullSafe(F.col("b.s")) & F.col("a.x").eqNullSafe(F.col("b.x")))
        found = a.alias("a").join(b.alias("b"), F.col("a.node") == F.col("b.node"), "full_outer").where(~same)
        open_ = sorted(r[0] for r in found.select(F.coalesce("a.node", "b.node")).collect())  # 2**bits numbers at most
        if not open_:
            break
    return open_, depth


def changes(spark: SparkSession, old: str, new: str) -> DataFrame:
    """``id`` and ``op`` (persist, update, remove) that lead from the snapshot ``old`` to ``new``; one row an id."""
    leaves, bits = unequal_leaves(spark, old, new)
    if not leaves:
        return spark.createDataFrame([], "id string, op string")
    ranges = sorted({leaf >> (bits - RANGE_BITS) for leaf in leaves})

    def side(path: str) -> DataFrame:
        rows = spark.read.schema(_ROWS).parquet(f"{path}/rows").where(F.col("_range").isin(ranges))
        if len(leaves) <= NAMED_LEAVES:
            rows = rows.where(F.col("_leaf").isin(leaves))
        return rows.groupBy("_id").agg(*_digests(F.col("_h1"), F.col("_h2"), F.lit(1)))

    a, b = side(old).alias("a"), side(new).alias("b")
    both = a.join(b, F.col("a._id").eqNullSafe(F.col("b._id")), "full_outer")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.x") == F.col("b.x"))
    op = F.when(F.col("a.n").isNull(), "persist").when(F.col("b.n").isNull(), "remove").when(~same, "update")
    return both.select(F.coalesce("a._id", "b._id").alias("id"), op.alias("op")).where(F.col("op").isNotNull())


def change_rows(found: DataFrame, entity: str, flush: Column) -> DataFrame:
    """Captured changes as the rows that the sync operators take: ``flush``, ``entity``, ``key``, ``op``."""
    return found.select(flush.cast("timestamp_ntz").alias("flush"), F.lit(entity).alias("entity"), F.array("id").alias("key"), "op")
