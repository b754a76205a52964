"""Structured Streaming sync of change rows (STR-1..7, SNK-11).

Change rows land as files (JSON or Parquet) in a landing folder. A file
stream reads them with a bounded number of files per micro-batch; each
micro-batch is reduced per (flush, entity, id) and written to the action log
under ``batch_id=<n>`` with overwrite, so a replayed batch (at-least-once
``foreachBatch``) rewrites the same folder and changes nothing. The stream
checkpoint replaces the reference's "clear the spool after hand-off" step,
which removes its read/clear race.

A flush split across two micro-batches is harmless: the read side reduces
the log by (flush, entity, id) again (delete wins), then takes the latest
flush per id. Both reductions are algebraic and map-side combined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docforge.operators import sync

CHANGE_SCHEMA = "flush timestamp_ntz, entity string, key array<string>, op string"


def reconcile_batch(batch: DataFrame, entities: DataFrame) -> DataFrame:
    changes = sync.keep_indexed_entities(batch, entities)
    return sync.reconcile_flushes(sync.scalar_ids(changes))


def start_sync(spark: SparkSession, landing: str, action_log: str, checkpoint: str, entities: DataFrame,
               max_files_per_trigger: int = 1, fmt: str = "parquet",
               on_batch: Callable[[DataFrame, int], None] | None = None,
               available_now: bool = True, interval: str = "10 seconds", name: str | None = None) -> StreamingQuery:
    """Start the sync stream, over what has landed or (not ``available_now``) every ``interval`` until it is stopped. ``on_batch(reconciled, batch_id)`` may apply the
    batch to a document store (re-reading current source rows)."""
    stream = (spark.readStream.schema(CHANGE_SCHEMA).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing))

    def handle(batch: DataFrame, batch_id: int) -> None:
        reduced = reconcile_batch(batch, entities)
        reduced.write.mode("overwrite").parquet(f"{action_log}/batch_id={batch_id}")
        if on_batch is not None:
            on_batch(spark.read.parquet(f"{action_log}/batch_id={batch_id}"), batch_id)

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return (writer if name is None else writer.queryName(name)).start()


def action_log_state(spark: SparkSession, action_log: str) -> DataFrame:
    """Final action per (entity, id) over everything the stream has logged."""
    from docforge.sources.spool import _exists

    if not _exists(spark, action_log):  # nothing handed off yet
        return spark.createDataFrame([], "entity string, id string, action string")
    log = spark.read.parquet(action_log)
    merged = sync.reconcile_flushes(log.select("flush", "entity", "id",
                                               F.when(F.col("action") == sync.DELETE, "remove")
                                               .otherwise("update").alias("op")))
    return sync.final_state(merged)


def drain_spool(spark: SparkSession, spool_path: str, checkpoint: str, store, alias: str, entity: str,
                current: Callable[[], DataFrame], max_files_per_trigger: int = 100) -> StreamingQuery:
    """STR-5 spool mode: drain the id spool of one entity into the alias with a
    file stream (``availableNow``). The stream checkpoint records which spool
    files were handed off -- nothing is deleted, so the reference's read/clear
    race cannot lose ids (SNK-11). Ids still in the source are re-indexed from their
    current row, ids gone from it become tombstones, so the order of spooled lines
    does not matter and removals are not lost. The batch is named after the
    micro-batch: a retry replaces what the first try wrote. Only the entity's own
    folder is read (a filter on the partition column)."""
    from docforge.sources.spool import ENTITY_DIR, entity_folder

    stream = (spark.readStream.schema(f"id string, {ENTITY_DIR} string")
              .option("maxFilesPerTrigger", max_files_per_trigger).json(spool_path))

    name = "drain-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def handle(batch: DataFrame, batch_id: int) -> None:
        ids = (batch.where(F.col("id").isNotNull())
               .where(F.col(ENTITY_DIR) == entity_folder(entity)))
        store.reindex(alias, ids, current(), batch=f"{name}-{batch_id}")

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def compact_action_log(spark: SparkSession, action_log: str) -> int:
    """Bound the action log of a long-running stream: reduce every folder
    present now to one row per (entity, id) -- its latest flush and that
    flush's merged action -- written as one new folder, then drop the folders
    it replaces. Because the read side re-reduces by (flush, entity, id) and
    then takes the latest flush, a reader (or a crash) between the two steps
    sees duplicates that merge to the same answer. Returns folders dropped."""
    from docforge.sources.spool import _exists

    if not _exists(spark, action_log):
        return 0
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(action_log)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = [st.getPath().toString() for st in fs.listStatus(root)
               if st.isDirectory() and st.getPath().getName().startswith("batch_id=")]
    if len(folders) <= 1:
        return 0
    log = spark.read.parquet(*folders).select("flush", "entity", "id", "action")
    merged = sync.reconcile_flushes(log.select("flush", "entity", "id",
                                               F.when(F.col("action") == sync.DELETE, "remove")
                                               .otherwise("update").alias("op")))
    latest = (merged.groupBy("entity", "id")
              .agg(F.max_by(F.struct("flush", "action"), "flush").alias("last"))
              .select(F.col("last.flush").alias("flush"), "entity", "id", F.col("last.action").alias("action")))
    import uuid
    latest.write.parquet(f"{action_log}/batch_id=compacted-{uuid.uuid4().hex[:12]}")
    for folder in folders:
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
    return len(folders)
