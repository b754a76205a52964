"""Queries for incremental sync (2.4 FLT-1/2, 2.5 JON-2/3, 2.6, 2.11, spool)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docforge.operators import sync
from docforge.operators.documents import build_documents
from docforge.plans.fixtures import (CUSTOMER_ENTITY, FINAL_SQL, RECONCILED_SQL, change_rows,
                                     dataset_entities)
from docforge.plans.registry import query
from docforge.sources import spool
from docforge.session import scratch
from docforge.spec import DatasetSpec

CUSTOMER_SPEC = DatasetSpec(code="customer", entity=CUSTOMER_ENTITY, table="customer", id_field="c_custkey",
                            source_fields=("c.c_name", "c.c_nationkey", "c.c_acctbal", "c.c_mktsegment"))

CUSTOMER_DOCS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
"""


def reconciled(spark, sf_dir):
    changes = sync.keep_indexed_entities(change_rows(spark, sf_dir), dataset_entities(spark))
    return sync.reconcile_flushes(sync.scalar_ids(changes))


def customer_docs(spark, sf_dir):
    return build_documents(spark, CUSTOMER_SPEC, sf_dir)


def changed_docs(spark, sf_dir):
    """The source as it is when the changes are synced: every row has other values than when the index was built."""
    return customer_docs(spark, sf_dir).withColumns({
        "c_mktsegment": F.concat("c_mktsegment", F.lit("/"), F.length("c_name")), "c_nationkey": F.col("c_nationkey") + 100})


# untouched documents keep the values of the first build, upserted ones have the new ones, deleted ones are gone
AFTER_SYNC_SQL = f"""
SELECT d.id, d.c_name, d.c_nationkey + CASE WHEN f.id IS NULL THEN 0 ELSE 100 END AS c_nationkey, d.c_acctbal,
       d.c_mktsegment || CASE WHEN f.id IS NULL THEN '' ELSE '/' || length(d.c_name) END AS c_mktsegment
FROM ({CUSTOMER_DOCS_SQL}) d LEFT JOIN ({FINAL_SQL}) f ON f.id = d.id
WHERE f.action IS NULL OR f.action <> 'delete'
"""


@query("flush_reconcile", RECONCILED_SQL, ("STR-1", "STR-2", "FLT-1", "FLT-2", "JON-2", "JON-8"))
def flush_reconcile_q(spark, sf_dir):
    return reconciled(spark, sf_dir)


@query("sync_final_state", FINAL_SQL, ("STR-3",))
def sync_final_state_q(spark, sf_dir):
    return sync.final_state(reconciled(spark, sf_dir))


@query("chunk_plan", f"""
SELECT flush, entity, action, chunk_no, count(*) AS n_ids, min(id) AS first_id, max(id) AS last_id FROM (
  SELECT flush, entity, action, id,
         CAST(floor((row_number() OVER (PARTITION BY flush, entity, action ORDER BY id) - 1) / 25) AS BIGINT) AS chunk_no
  FROM ({RECONCILED_SQL}) r) c
GROUP BY flush, entity, action, chunk_no
""", ("AGG-6", "STR-7"))
def chunk_plan_q(spark, sf_dir):
    return sync.chunk_plan(reconciled(spark, sf_dir), size=25)


@query("chunk_null_groups", f"""
SELECT flush, entity, action, chunk_no, count(*) AS n_ids, min(id) AS first_id, max(id) AS last_id FROM (
  SELECT flush, entity, action, id,
         CAST(floor((row_number() OVER (PARTITION BY flush, entity, action ORDER BY id) - 1) / 25) AS BIGINT) AS chunk_no
  FROM (SELECT CASE WHEN date_part('day', flush) % 3 = 0 THEN NULL ELSE flush END AS flush, entity, id, action
        FROM ({RECONCILED_SQL}) r) n) c
GROUP BY flush, entity, action, chunk_no
""", ("AGG-6", "STR-7"))
def chunk_null_groups_q(spark, sf_dir):
    rows = reconciled(spark, sf_dir)
    return sync.chunk_plan(rows.withColumn("flush", F.when(F.dayofmonth("flush") % 3 != 0, F.col("flush"))), size=25)


@query("chunk_jobs", f"""
SELECT flush, entity, action, chunk_no, string_agg(id, ',' ORDER BY id) AS ids FROM (
  SELECT flush, entity, action, id,
         CAST(floor((row_number() OVER (PARTITION BY flush, entity, action ORDER BY id) - 1) / 10) AS BIGINT) AS chunk_no
  FROM ({RECONCILED_SQL}) r) c
GROUP BY flush, entity, action, chunk_no
""", ("AGG-6", "STR-7"))
def chunk_jobs_q(spark, sf_dir):
    return sync.chunk_ids(reconciled(spark, sf_dir), size=10).withColumn("ids", F.array_join("ids", ","))


@query("dataset_changes", f"""
SELECT r.flush, r.entity, d.dataset, r.id, r.action FROM ({RECONCILED_SQL}) r
JOIN (VALUES ('customer', '{CUSTOMER_ENTITY}'), ('customer_archive', '{CUSTOMER_ENTITY}')) AS d(dataset, entity) ON d.entity = r.entity
""", ("JON-8", "FLT-1"))
def dataset_changes_q(spark, sf_dir):
    # two datasets of one entity: both are synced
    entities = spark.sql(f"VALUES ('customer', '{CUSTOMER_ENTITY}'), ('customer_archive', '{CUSTOMER_ENTITY}') AS d(code, entity)"
                         .replace("\\", "\\\\"))
    changes = sync.reconcile_flushes(sync.scalar_ids(sync.keep_indexed_entities(change_rows(spark, sf_dir), entities)))
    return sync.per_dataset(changes, entities).select("flush", "entity", "dataset", "id", "action")


@query("scalar_keys", """
SELECT CAST(event_id AS VARCHAR) AS event, CAST(user_id AS VARCHAR) AS id FROM events
WHERE event_id % 3 <> 0 AND event_id % 5 <> 0
""", ("FLT-2",))
def scalar_keys_q(spark, sf_dir):
    # every third event has a composite key, every fifth a null one
    from docforge.sources.tables import read_table
    one = F.when(F.col("event_id") % 5 != 0, F.col("user_id").cast("string"))
    key = F.when(F.col("event_id") % 3 == 0, F.array(one, F.lit("x"))).otherwise(F.array(one))
    rows = read_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event"), key.alias("key"))
    return sync.scalar_ids(rows).select("event", "id")


@query("reindex_ids", f"""
SELECT d.* FROM ({CUSTOMER_DOCS_SQL}) d
WHERE d.id IN (SELECT id FROM ({RECONCILED_SQL}) r WHERE action = 'upsert')
""", ("SRC-3", "JON-3", "STR-4"))
def reindex_ids_q(spark, sf_dir):
    ids = reconciled(spark, sf_dir).where(F.col("action") == sync.UPSERT)
    return sync.reindex_documents(customer_docs(spark, sf_dir), ids)


@query("reconcile_counts", f"""
SELECT r.flush, r.entity, count(*) AS requested, count(d.id) AS reconciled
FROM ({RECONCILED_SQL}) r LEFT JOIN ({CUSTOMER_DOCS_SQL}) d ON r.id = d.id
WHERE r.action = 'upsert' GROUP BY r.flush, r.entity
""", ("AGG-7",))
def reconcile_counts_q(spark, sf_dir):
    return sync.reconcile_counts(reconciled(spark, sf_dir), customer_docs(spark, sf_dir))


@query("live_after_sync", f"""
SELECT d.* FROM ({CUSTOMER_DOCS_SQL}) d
WHERE d.id NOT IN (SELECT id FROM ({FINAL_SQL}) f WHERE action = 'delete')
""", ("SNK-2", "JON-2"))
def live_after_sync_q(spark, sf_dir):
    state = sync.final_state(reconciled(spark, sf_dir))
    return sync.live_after(customer_docs(spark, sf_dir), state)


@query("orphan_sweep", f"""
SELECT d.id FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS id FROM events) d
WHERE d.id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
""", ("STR-6",))
def orphan_sweep_q(spark, sf_dir):
    # documents indexed for every user seen in events; the source keeps only
    # non-AUTOMOBILE customers, so the rest are orphans to delete.
    from docforge.sources.tables import read_table
    docs = read_table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id")).distinct()
    src = (read_table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "AUTOMOBILE")
           .select(F.col("c_custkey").cast("string").alias("id")))
    return sync.orphan_sweep(docs, src)


def _spool_dir(spark):
    return sync.new_session_scoped_dir(spark, "spool")


@query("spool_pending", f"""
SELECT DISTINCT entity, id FROM ({RECONCILED_SQL}) r
""", ("SRC-4", "SNK-10", "AGG-1", "SCL-9"))
def spool_pending_q(spark, sf_dir):
    # every flush appends its upserts and (unlike the reference) its tombstones
    path = _spool_dir(spark)
    spool.append_spool(reconciled(spark, sf_dir).where(F.col("action") == sync.UPSERT), path)
    spool.append_spool(reconciled(spark, sf_dir).where(F.col("action") == sync.DELETE), path)
    return spool.read_spool(spark, path)


@query("spool_classes", f"""
SELECT DISTINCT entity FROM ({RECONCILED_SQL}) r
""", ("SRC-5",))
def spool_classes_q(spark, sf_dir):
    path = _spool_dir(spark)
    spool.append_spool(reconciled(spark, sf_dir), path)
    return spool.spool_classes(spark, path)


@query("sync_stream", FINAL_SQL, ("STR-1", "STR-2", "STR-3", "STR-4", "STR-5", "SNK-11"))
def sync_stream_q(spark, sf_dir):
    from docforge.streaming.sync_stream import action_log_state, start_sync

    base = sync.new_session_scoped_dir(spark, "sync")
    landing, log, ckpt = f"{base}/landing", f"{base}/actions", f"{base}/checkpoint"
    # producer side: the change rows land as files (several flushes per file)
    change_rows(spark, sf_dir).repartition(6).write.parquet(landing)
    q = start_sync(spark, landing, log, ckpt, dataset_entities(spark), max_files_per_trigger=2)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return action_log_state(spark, log)


@query("spool_drain", AFTER_SYNC_SQL, ("STR-5", "STR-6", "SNK-11", "STR-4"))
def spool_drain_q(spark, sf_dir):
    from docforge.operators.store import DocumentStore
    from docforge.streaming.sync_stream import drain_spool
    import uuid

    base = sync.new_session_scoped_dir(spark, "drain")
    store = DocumentStore(spark, database=f"docforge_{uuid.uuid4().hex[:10]}", root=scratch(spark, "store"))
    docs = customer_docs(spark, sf_dir)
    store.rebuild("customer", docs)  # the index as built before the changes
    changes = reconciled(spark, sf_dir)
    # every touched id is spooled once per flush (duplicates on purpose)
    spool.append_spool(changes.repartition(4), f"{base}/spool")

    def current():
        # the database after the changes: rows whose last action was a delete are gone
        return sync.live_after(changed_docs(spark, sf_dir), sync.final_state(reconciled(spark, sf_dir)))

    q = drain_spool(spark, f"{base}/spool", f"{base}/checkpoint", store, "customer", CUSTOMER_ENTITY, current,
                    max_files_per_trigger=2)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return store.read("customer")


@query("sync_stream_documents", AFTER_SYNC_SQL, ("STR-4", "STR-5", "SNK-1", "SNK-2"))
def sync_stream_documents_q(spark, sf_dir):
    # queued-jobs mode end to end: each micro-batch's reconciled actions are
    # applied to the live alias -- upserts re-read the current source row,
    # deletes become tombstones, both sequenced by their flush so that a
    # later flush wins even across micro-batches and replays change nothing
    import uuid

    from docforge.operators.store import DocumentStore
    from docforge.streaming.sync_stream import start_sync

    base = sync.new_session_scoped_dir(spark, "sync-docs")
    store = DocumentStore(spark, database=f"docforge_{uuid.uuid4().hex[:10]}", root=scratch(spark, "store"))
    store.rebuild("customer", customer_docs(spark, sf_dir))
    change_rows(spark, sf_dir).repartition(6).write.parquet(f"{base}/landing")

    def apply(batch, batch_id):
        seq = F.unix_micros(F.col("flush").cast("timestamp")).alias("_seq")
        last = sync.final_state(batch).join(batch.groupBy("entity", "id").agg(F.max("flush").alias("flush")), ["entity", "id"])
        ups = last.where(F.col("action") == sync.UPSERT).select("id", seq)
        dels = last.where(F.col("action") == sync.DELETE).select("id", seq)
        store.apply_changes("customer", changed_docs(spark, sf_dir).join(ups, "id"), dels, batch=f"stream-{batch_id}")

    q = start_sync(spark, f"{base}/landing", f"{base}/actions", f"{base}/checkpoint", dataset_entities(spark),
                   max_files_per_trigger=2, on_batch=apply)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return store.read("customer")


@query("captured_changes", f"""
SELECT id, 'remove' AS op FROM ({CUSTOMER_DOCS_SQL}) d WHERE c_nationkey = 3
UNION ALL SELECT id, 'update' FROM ({CUSTOMER_DOCS_SQL}) d WHERE c_nationkey = 4
UNION ALL SELECT 'n' || id, 'persist' FROM ({CUSTOMER_DOCS_SQL}) d WHERE c_nationkey = 5
""", ("STR-1",))
def captured_changes_q(spark, sf_dir):
    # two snapshots of the source: one nation's rows went, another's have other values (one a null), some rows are new
    from docforge.operators import capture
    base = sync.new_session_scoped_dir(spark, "capture")
    docs = customer_docs(spark, sf_dir)
    capture.write_snapshot(docs, f"{base}/old")
    later = docs.where("c_nationkey <> 3").withColumns({
        "c_acctbal": F.when(F.col("c_nationkey") != 4, F.col("c_acctbal")),
        "c_mktsegment": F.when(F.col("c_nationkey") == 4, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))})
    added = docs.where("c_nationkey = 5").withColumn("id", F.concat(F.lit("n"), "id"))
    capture.write_snapshot(later.unionByName(added).repartition(3), f"{base}/new")
    return capture.changes(spark, f"{base}/old", f"{base}/new")


@query("complete_flushes", RECONCILED_SQL, ("STR-2", "FLT-1", "FLT-2", "STR-5"))
def complete_flushes_q(spark, sf_dir):
    # rows land by time; the day in the middle is split over three files, with the stream stopped after each of them
    from docforge.sources.tables import read_table
    from docforge.streaming.flushes import heartbeat, start_flushes
    base = sync.new_session_scoped_dir(spark, "flushes")
    first, last = read_table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    middle = (first + (last - first) / 2).replace(hour=0, minute=0, second=0, microsecond=0)
    hours = F.col("at") - F.lit(middle).cast("timestamp_ntz")
    part = F.when(hours < F.expr("interval 8 hours"), 0).when(hours < F.expr("interval 16 hours"), 1).otherwise(2)
    rows = change_rows(spark, sf_dir, extra=(F.col("ts").cast("timestamp_ntz").alias("at"),)).withColumn("part", part)
    for k in range(4):
        landed = rows.where(F.col("part") == k).drop("part", "at") if k < 3 else heartbeat(spark, "2999-01-01 00:00:00")
        landed.coalesce(1).write.mode("append").parquet(f"{base}/landing")
        q = start_flushes(spark, f"{base}/landing", f"{base}/out", f"{base}/checkpoint", dataset_entities(spark))
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")


@query("listened_calls", """
SELECT 'stream' AS operation, CAST(3 AS BIGINT) AS calls, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS empty_searches, count(*) AS ops,
       CAST(NULL AS BIGINT) AS hits, 'customer-sync' AS of FROM events
UNION ALL SELECT 'search', 2, 0, 1, NULL, count(*), 'customer' FROM customer WHERE c_nationkey < 5
""", ("UDF-4", "RPT-13", "AGG-5", "STR-5"))
def listened_calls_q(spark, sf_dir):
    # a stream and two searches as Spark's listeners saw them; none of them knows of the log
    from docforge.operators import calls
    from docforge.streaming.call_listener import CallLog
    from docforge.streaming.sync_stream import start_sync

    base = sync.new_session_scoped_dir(spark, "listened")
    change_rows(spark, sf_dir).repartition(6).write.parquet(f"{base}/landing")
    docs = customer_docs(spark, sf_dir)
    with CallLog(spark, f"{base}/calls", "demo", limit=2) as log:
        q = start_sync(spark, f"{base}/landing", f"{base}/actions", f"{base}/checkpoint", dataset_entities(spark), max_files_per_trigger=2,
                       name="customer-sync")
        q.awaitTermination()
        log.wait(q)
        for found in (docs.where("c_nationkey < 5"), docs.where("c_nationkey < 0")):
            found.observe("customer", F.count(F.lit(1)).alias("hits")).write.format("noop").mode("overwrite").save()
        log.wait_rows(5)
    rows = log.read()
    sums = rows.groupBy("operation").agg(F.sum("ops").alias("ops"), F.sum("hits").alias("hits"),
                                         F.max(F.coalesce("index", "request")).alias("of"))
    return calls.summarize(rows, ["operation"]).select("operation", "calls", "errors", "empty_searches").join(sums, "operation")
