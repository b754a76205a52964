"""Flushes handed on once, when they are complete (STR-2).

Change rows of a flush may come in any number of files and micro-batches. The stream keeps one small state a (flush, entity, id) --
whether a remove was among its rows -- and hands a flush on when the watermark (the latest flush seen, less ``delay``) has
passed it (Spark takes a flush that equals the watermark for passed, so ``delay`` is a millisecond at least): one row an id, delete wins, whatever the order and however the rows were split. State and watermark live in the
checkpoint, so a restart in between changes nothing, and the file sink writes every flush exactly once.

A row of a later flush, or a heartbeat (a row with a flush and nothing else), closes the flushes before it. Rows that come more
than ``delay`` behind the latest flush are too late; Spark leaves them out of the state, ``late_rows`` counts
them, and they stay in the landing folder, where the batch operators (``sync.reconcile_flushes``) see them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docforge.operators import sync
from docforge.streaming.sync_stream import CHANGE_SCHEMA


def complete_flushes(changes: DataFrame, entities: DataFrame, delay: str = "1 millisecond") -> DataFrame:
    """``flush``, ``entity``, ``id``, ``action`` of complete flushes, from a stream of change rows.

    Which rows count (entity of a dataset, scalar key) is judged as a value, not by a filter: a filter would be pushed
    below the watermark, and rows that don't count, heartbeats above all, must still move it."""
    known = [r[0] for r in entities.select("entity").distinct().collect()]  # configuration-sized
    key = F.col("key")
    counts = F.coalesce(F.col("entity").isin(known) & (F.size(key) == 1) & key.getItem(0).isNotNull(), F.lit(False))
    rows = changes.select(F.col("flush").cast("timestamp").alias("flush"), F.when(counts, F.col("entity")).alias("entity"),
                          F.when(counts, key.getItem(0)).alias("id"), counts.alias("counts"), (F.col("op") == "remove").alias("removed"))
    closed = rows.withWatermark("flush", delay).groupBy("flush", "entity", "id").agg(
        F.max("removed").alias("removed"), F.max("counts").alias("counts"))
    return closed.where("counts").select(F.col("flush").cast("timestamp_ntz").alias("flush"), "entity", "id",
                                         F.when(F.col("removed"), sync.DELETE).otherwise(sync.UPSERT).alias("action"))


def start_flushes(spark: SparkSession, landing: str, out: str, checkpoint: str, entities: DataFrame, delay: str = "1 millisecond",
                  max_files_per_trigger: int = 1, fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Start the stream from the landing folder to the folder ``out`` (Parquet, each flush once)."""
    stream = (spark.readStream.schema(CHANGE_SCHEMA).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger).load(landing))
    writer = (complete_flushes(stream, entities, delay).writeStream.outputMode("append").format("parquet").option("path", out)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def heartbeat(spark: SparkSession, at: str) -> DataFrame:
    """A change row that only closes the flushes before ``at``."""
    return spark.sql(f"SELECT timestamp_ntz'{at}' AS flush, CAST(NULL AS STRING) AS entity, CAST(NULL AS ARRAY<STRING>) AS key, CAST(NULL AS STRING) AS op")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came too late for their flush, as far as the query's kept progress goes back."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
