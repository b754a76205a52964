"""Incremental sync: change capture, flush reconciliation, chunking (2.5, 2.6, 2.11).

Change rows are ``(flush, entity, key ARRAY<STRING> | id STRING, op)`` with
``op`` in ``persist``/``update``/``remove``. Every operator is a set
operation over all rows; nothing iterates on the driver.

Skew: one id, entity or flush may hold a large share of the rows. All
reductions here are algebraic (``max``, ``max_by``, ``count``), so Spark's
partial aggregation collapses a hot key inside each map task before the
shuffle; chunk numbering never puts a whole group into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docforge.session import ensure_checkpoint_dir, scratch

UPSERT, DELETE = "upsert", "delete"


def keep_indexed_entities(changes: DataFrame, entities: DataFrame) -> DataFrame:
    """FLT-1: changes only for entity classes that back a dataset.

    ``entities`` is the dataset spec table (one row per configured dataset),
    bounded by configuration, so it is broadcast explicitly.
    """
    return changes.join(F.broadcast(entities.select("entity")), "entity", "left_semi")


def per_dataset(reconciled: DataFrame, entities: DataFrame) -> DataFrame:
    """JON-8: every change once for each dataset (``code``) that its entity backs."""
    return reconciled.join(F.broadcast(entities.select(F.col("code").alias("dataset"), "entity").distinct()), "entity")


def scalar_ids(changes: DataFrame, key_col: str = "key") -> DataFrame:
    """FLT-2: drop rows with a composite or null identifier; id -> string."""
    key = F.col(key_col)
    ok = (F.size(key) == 1) & key.getItem(0).isNotNull()
    return changes.where(ok).withColumn("id", key.getItem(0).cast("string")).drop(key_col)


def reconcile_flushes(changes: DataFrame) -> DataFrame:
    """STR-2 / JON-2: one action per (flush, entity, id); a remove anywhere in
    the flush wins whatever the order. One shuffle, map-side combined."""
    removed = F.max(F.when(F.col("op") == "remove", 1).otherwise(0))
    return (changes.groupBy("flush", "entity", "id")
            .agg(F.when(removed == 1, F.lit(DELETE)).otherwise(F.lit(UPSERT)).alias("action")))


def final_state(reconciled: DataFrame) -> DataFrame:
    """STR-3: across flushes the later flush wins (``max_by`` per id)."""
    return (reconciled.groupBy("entity", "id")
            .agg(F.max_by("action", "flush").alias("action")))


def number_within_groups(df: DataFrame, group_cols: list[str], order_col: str,
                         partitions: int | None = None) -> DataFrame:
    """Dense 0-based rank of ``order_col`` within each group, without ever
    putting a whole group into one task (unlike ``row_number`` over a window
    partitioned by the group).

    1. range-partition on (group, order) -- a hot group is spread over many
       partitions -- and sort inside each partition;
    2. count rows per (group, partition): a table of at most
       ``groups + partitions`` rows;
    3. prefix-sum those counts per group (window over that small table; a
       group has at most ``partitions`` rows there) = start offset of each
       (group, partition) slice;
    4. rank = offset + position inside the slice.

    The numbered frame is checkpointed to the shared checkpoint folder so that
    partition ids and positions stay stable if a task is recomputed.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, order_col]
    ranged = (df.repartitionByRange(n, *[F.col(k) for k in keys])
              .sortWithinPartitions(*keys)
              .withColumn("__pid", F.spark_partition_id())
              .withColumn("__mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    slices = ranged.groupBy(*group_cols, "__pid").agg(F.min("__mid").alias("__first"), F.count("*").alias("__n"))
    w = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__offset", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*group_cols, "__pid"]]  # null groups count too
    numbered = (ranged.alias("r").join(slices.alias("s"), reduce(Column.__and__, same))
                .select("r.*", "s.__first", "s.__offset"))
    return (numbered.withColumn("rank", (F.col("__offset") + F.col("__mid") - F.col("__first")).cast("bigint"))
            .drop("__pid", "__mid", "__first", "__offset"))


def chunk_plan(reconciled: DataFrame, size: int = 500) -> DataFrame:
    """AGG-6 / STR-7: ids of each (flush, entity, action) cut into jobs of at
    most ``size`` ids, in id order; chunks = ceil(n / max(1, size)).

    Output: one row per chunk ``(flush, entity, action, chunk_no, n_ids,
    first_id, last_id)``; the ids of a chunk are bounded by ``size``.
    """
    size = max(1, int(size))
    numbered = number_within_groups(reconciled, ["flush", "entity", "action"], "id")
    return (numbered.withColumn("chunk_no", F.floor(F.col("rank") / size).cast("bigint"))
            .groupBy("flush", "entity", "action", "chunk_no")
            .agg(F.count("*").alias("n_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")))


def chunk_ids(reconciled: DataFrame, size: int = 500) -> DataFrame:
    """The message form of :func:`chunk_plan`: ``ids ARRAY<STRING>`` per chunk (<= size)."""
    size = max(1, int(size))
    numbered = number_within_groups(reconciled, ["flush", "entity", "action"], "id")
    return (numbered.withColumn("chunk_no", F.floor(F.col("rank") / size).cast("bigint"))
            .groupBy("flush", "entity", "action", "chunk_no")
            .agg(F.array_sort(F.collect_list("id")).alias("ids")))


def reindex_documents(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """SRC-3 / JON-3 / STR-4: current documents for the changed ids.

    Ids absent from the source are skipped silently. The join strategy is
    left to AQE: the id set is broadcast only when its runtime size is under
    ``spark.sql.autoBroadcastJoinThreshold``, otherwise it is a shuffle join.
    """
    return documents.join(ids.select("id").distinct(), "id", "left_semi")


def reconcile_counts(reconciled: DataFrame, documents: DataFrame) -> DataFrame:
    """AGG-7: ``reconciled X of Y`` per (flush, entity) for the upsert jobs.

    Document ids are unique in a document table, so ``reconciled`` is an
    inner join of the (small) upsert set with the document ids -- a join AQE
    can broadcast on the upsert side, leaving the document table unshuffled
    -- and ``requested`` an aggregate of the upsert set alone; the two small
    aggregates are then joined."""
    upserts = reconciled.where(F.col("action") == UPSERT).select("flush", "entity", "id")
    requested = upserts.groupBy("flush", "entity").agg(F.count("*").alias("requested"))
    found = (upserts.join(documents.select("id"), "id")
             .groupBy("flush", "entity").agg(F.count("*").alias("reconciled")))
    return (requested.join(found, ["flush", "entity"], "left")
            .select("flush", "entity", "requested", F.coalesce("reconciled", F.lit(0)).alias("reconciled")))


def orphan_sweep(documents: DataFrame, source_ids: DataFrame) -> DataFrame:
    """STR-6 deviation: documents whose source row is gone (``left_anti``)."""
    return documents.join(source_ids.select("id").distinct(), "id", "left_anti")


def live_after(documents: DataFrame, state: DataFrame) -> DataFrame:
    """Documents left live once the final deletes are applied."""
    deletes = state.where(F.col("action") == DELETE).select("id")
    return documents.join(deletes, "id", "left_anti")


def new_session_scoped_dir(spark: SparkSession, name: str) -> str:
    return scratch(spark, name)
