"""Queries for the write path: generations, publish, rebuild, upsert/delete (2.2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from docforge.operators import sync
from docforge.operators.documents import delete_actions
from docforge.operators.store import DocumentStore
from docforge.plans.fixtures import RECONCILED_SQL
from docforge.plans.registry import query
from docforge.plans.sync_q import AFTER_SYNC_SQL, CUSTOMER_DOCS_SQL, changed_docs, customer_docs, reconciled
from docforge.functions.porter import duckdb_stem_query
from docforge.functions.folding import fold_sql
from docforge.plans.text_q import _duck_tokens
from docforge.session import scratch
from docforge.spec import AnalyzerSpec, FieldSpec


def fresh_store(spark) -> DocumentStore:
    return DocumentStore(spark, database=f"docforge_{uuid.uuid4().hex[:10]}", root=scratch(spark, "store"))


@query("generation_create", """
SELECT 'id' AS col_name, 'string' AS data_type, CAST(0 AS BIGINT) AS documents
UNION ALL
SELECT column_name, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                                   WHEN 'DOUBLE' THEN 'double' WHEN 'BIGINT' THEN 'bigint' END,
       CAST(0 AS BIGINT)
FROM information_schema.columns
WHERE table_name = 'customer' AND column_name IN ('c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment')
""", ("SNK-4",))
def generation_create_q(spark, sf_dir):
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    gen = store.create_generation("customer", docs.schema, strict=True)
    described = spark.sql(f"DESCRIBE TABLE {store.qualified(gen)}")
    documents = spark.table(store.qualified(gen)).count()  # a new generation is empty
    return described.select("col_name", "data_type", F.lit(documents).cast("bigint").alias("documents"))


@query("rebuild_publish", CUSTOMER_DOCS_SQL, ("SNK-5", "SNK-6"))
def rebuild_publish_q(spark, sf_dir):
    store = fresh_store(spark)
    store.rebuild("customer", lambda: customer_docs(spark, sf_dir))
    return store.read("customer")


@query("rebuild_failure_keeps_live", CUSTOMER_DOCS_SQL, ("SNK-6", "SNK-3"))
def rebuild_failure_keeps_live_q(spark, sf_dir):
    store = fresh_store(spark)
    mapping = {"c_name": FieldSpec("text"), "c_nationkey": FieldSpec("long"), "c_acctbal": FieldSpec("float"),
               "c_mktsegment": FieldSpec("keyword")}
    store.rebuild("customer", lambda: customer_docs(spark, sf_dir), mapping)
    # the second build holds other values, and one kind of them can't be read as the declared number
    second = changed_docs(spark, sf_dir).withColumn("c_nationkey", F.concat("c_mktsegment", F.col("c_nationkey")))
    try:
        store.rebuild("customer", second, mapping)
    except RuntimeError:
        pass
    else:
        raise AssertionError("rebuild with rejected documents must fail")
    return store.read("customer")


@query("populate_limit", f"""
SELECT * FROM ({CUSTOMER_DOCS_SQL}) d ORDER BY id LIMIT 100
""", ("SNK-7", "SNK-8", "LIM-1"))
def populate_limit_q(spark, sf_dir):
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    store.create("customer", docs.schema)
    store.populate("customer", docs, limit=100)
    return store.read("customer")


def _seq(col="flush"):
    return F.unix_micros(F.col(col).cast("timestamp"))


@query("upsert_documents", AFTER_SYNC_SQL, ("SNK-1", "SNK-2", "STR-4"))
def upsert_documents_q(spark, sf_dir):
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    store.rebuild("customer", docs)
    # one action per id first, then one join: the *current* source row of every
    # upserted id (never the change payload) is copied once, however many flushes touched it
    last = reconciled(spark, sf_dir).groupBy("id").agg(F.max_by("action", "flush").alias("action"), F.max("flush").alias("flush"))
    ups = last.where(F.col("action") == sync.UPSERT).select("id", _seq().alias("_seq"))
    deletes = last.where(F.col("action") == sync.DELETE).select("id", _seq().alias("_seq"))
    store.apply_changes("customer", changed_docs(spark, sf_dir).join(ups, "id"), deletes)
    return store.read("customer")


@query("delete_documents", f"""
SELECT r.flush, 'delete' AS action, 'customer' AS "index", r.id,
       r.id IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) AS found
FROM ({RECONCILED_SQL}) r WHERE r.action = 'delete'
""", ("SNK-2", "PRJ-7"))
def delete_documents_q(spark, sf_dir):
    deletes = reconciled(spark, sf_dir).where(F.col("action") == sync.DELETE)
    present = customer_docs(spark, sf_dir).select("id").withColumn("found", F.lit(True))
    actions = delete_actions(deletes.select("flush", "id"), "customer")
    return (actions.join(present, "id", "left")
            .select("flush", "action", "index", "id", F.coalesce("found", F.lit(False)).alias("found")))


@query("retire_candidates", """
SELECT 1 AS position, false AS live, count(*) AS documents FROM customer
UNION ALL SELECT 2, true, count(*) FILTER (WHERE c_nationkey <> 3) FROM customer
UNION ALL SELECT 3, false, 0
""", ("SNK-9", "JON-7", "SET-4", "SRT-1"))
def retire_candidates_q(spark, sf_dir):
    store = fresh_store(spark)
    build = lambda: customer_docs(spark, sf_dir)
    store.rebuild("customer", build)
    store.rebuild("customer", build, keep_old=True)
    store.create_generation("customer", customer_docs(spark, sf_dir).schema)  # unpublished leftover
    # the live index loses the customers of one nation through its change log
    gone = customer_docs(spark, sf_dir).where("c_nationkey = 3").select("id", F.lit(1).alias("_seq"))
    store.apply_changes("customer", None, gone)
    store.rebuild("customer_2", build)  # another alias, whose generations are not candidates of this one
    cands = store.retire_candidates("customer")
    return cands.select("position", "live", "documents")


@query("rebuild_prefix_alias", f"""
SELECT 'film' AS alias, id, c_name FROM ({CUSTOMER_DOCS_SQL}) a WHERE c_nationkey < 5
UNION ALL SELECT 'film_archive', id, c_name FROM ({CUSTOMER_DOCS_SQL}) b WHERE c_nationkey >= 5
""", ("SNK-6", "SNK-7", "JON-7"))
def rebuild_prefix_alias_q(spark, sf_dir):
    # an alias whose name begins like another's keeps its generations
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    store.rebuild("film_archive", docs.where("c_nationkey >= 5"))
    for part in ("c_nationkey < 3", "c_nationkey < 5"):
        store.rebuild("film", docs.where(part))
    store.create("film", docs.schema)
    both = [store.read(a).select(F.lit(a).alias("alias"), "id", "c_name") for a in ("film", "film_archive")]
    return both[0].unionByName(both[1])


@query("populate_upsert", f"""
SELECT d.id, d.c_name, d.c_nationkey + CASE WHEN d.c_nationkey < 10 THEN 100 ELSE 0 END AS c_nationkey, d.c_acctbal,
       d.c_mktsegment || CASE WHEN d.c_nationkey < 10 THEN '/' || length(d.c_name) ELSE '' END AS c_mktsegment
FROM ({CUSTOMER_DOCS_SQL}) d WHERE d.c_nationkey < 10 OR d.c_nationkey >= 15
""", ("SNK-8", "SNK-1"))
def populate_upsert_q(spark, sf_dir):
    # documents change, come twice (the later one counts), and come back after a delete
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    store.rebuild("customer", docs)
    store.apply_changes("customer", None, docs.where("c_nationkey < 5 OR c_nationkey BETWEEN 10 AND 14").select("id", F.lit(1).alias("_seq")))
    new = changed_docs(spark, sf_dir).where("c_nationkey < 110")
    twice = new.withColumn("c_mktsegment", F.lit("older")).withColumn("__at", F.lit(1)).unionByName(new.withColumn("__at", F.lit(2)))
    store.populate("customer", twice, order_by="__at")
    return store.read("customer")


@query("compacted_alias", AFTER_SYNC_SQL, ("SNK-1", "SNK-6"))
def compacted_alias_q(spark, sf_dir):
    store = fresh_store(spark)
    store.rebuild("customer", customer_docs(spark, sf_dir))
    changes = sync.final_state(reconciled(spark, sf_dir))
    current = sync.live_after(changed_docs(spark, sf_dir), changes)
    store.reindex("customer", changes.select("id"), current)
    store.compact("customer")
    return spark.table(store.qualified(store.live_generation("customer")))


DOCUMENT_MAPPING = {"text": FieldSpec("text"), "lang": FieldSpec("keyword"), "source": FieldSpec("keyword"),
                    "n_chars": FieldSpec("long")}


def _index_documents(spark, sf_dir):
    """The reference's main flow: create a generation with the mapping and the
    english analyzer frozen in it, fill it, build its term index, publish."""
    from docforge.operators.analysis import field_postings
    from docforge.operators.documents import build_documents
    from docforge.plans.documents_q import DOCUMENTS_SPEC

    english = AnalyzerSpec("english")
    store = fresh_store(spark)
    store.rebuild("documents", lambda: build_documents(spark, DOCUMENTS_SPEC, sf_dir),
                  mapping=DOCUMENT_MAPPING, analyzer=english,
                  analyze=lambda gen: field_postings(gen, "id", DOCUMENT_MAPPING, english))
    return store


@query("index_documents", """
SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, source, n_chars FROM documents
""", ("SNK-4", "SNK-5", "SNK-6", "TXT-6"))
def index_documents_q(spark, sf_dir):
    return _index_documents(spark, sf_dir).read("documents")


_DOC_TERMS = duckdb_stem_query(_duck_tokens("documents", "doc_id", fold_sql("lower(text)")), ["doc_id", "position"])


@query("live_terms", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, 'text' AS field, position, token AS term FROM ({_DOC_TERMS}) t
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'lang', CAST(0 AS BIGINT), lang FROM documents WHERE lang IS NOT NULL
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'source', CAST(0 AS BIGINT), source FROM documents WHERE source IS NOT NULL
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'n_chars', CAST(0 AS BIGINT), CAST(n_chars AS VARCHAR) FROM documents
          WHERE n_chars IS NOT NULL
""", ("TXT-6", "SNK-4"))
def live_terms_q(spark, sf_dir):
    return _index_documents(spark, sf_dir).terms("documents").select("id", "field", "position", "term")


def _late_changes(store, spark, sf_dir):
    """What lands while a generation is made: one nation's customers go, another's have new values."""
    docs = changed_docs(spark, sf_dir)
    store.apply_changes("customer", docs.where("c_nationkey = 104"), docs.where("c_nationkey = 103").select("id"), seq_col=None)


_AFTER_LATE_SQL = f"""
SELECT id, c_name, c_nationkey + CASE WHEN c_nationkey = 4 THEN 100 ELSE 0 END AS c_nationkey, c_acctbal,
       c_mktsegment || CASE WHEN c_nationkey = 4 THEN '/' || length(c_name) ELSE '' END AS c_mktsegment
FROM ({CUSTOMER_DOCS_SQL}) d WHERE c_nationkey <> 3
"""


@query("change_during_compact", f"{_AFTER_LATE_SQL} AND c_nationkey <> 7", ("SNK-5", "SNK-6", "SNK-1"))
def change_during_compact_q(spark, sf_dir):
    # the log's deletes are folded; changes that land after the read are carried into the new generation
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    store.rebuild("customer", docs)
    store.apply_changes("customer", None, docs.where("c_nationkey = 7").select("id"), seq_col=None)
    store.compact("customer", accept=lambda _: _late_changes(store, spark, sf_dir))
    return store.read("customer")


@query("change_during_rebuild", _AFTER_LATE_SQL, ("SNK-5", "SNK-6", "STR-4"))
def change_during_rebuild_q(spark, sf_dir):
    # the earlier delete is the source's business (the rows are still there), the later changes are carried over; the writer's
    # generation has gone by the time of the last one
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    store.rebuild("customer", docs)
    store.apply_changes("customer", None, docs.where("c_nationkey = 7").select("id"), seq_col=None)
    store.rebuild("customer", docs, accept=lambda _: _late_changes(store, spark, sf_dir))
    return store.read("customer")


@query("writer_overtaken", _AFTER_LATE_SQL, ("SNK-1", "SNK-2", "SNK-5"))
def writer_overtaken_q(spark, sf_dir):
    # the generation is replaced between a writer's look at the alias and its commit: it writes its batch anew
    store = fresh_store(spark)
    docs = customer_docs(spark, sf_dir)
    store.rebuild("customer", docs)
    commit, overtaken = store._commit_batch, []

    def late(alias, head, *rest, **kw):
        if not overtaken:
            overtaken.append(store.rebuild(alias, docs))
        return commit(alias, head, *rest, **kw)

    store._commit_batch = late
    _late_changes(store, spark, sf_dir)
    return store.read("customer")


_BAD_NATIONS = {"c_nationkey": FieldSpec("long"), "c_name": FieldSpec("text"), "c_acctbal": FieldSpec("float"),
                "c_mktsegment": FieldSpec("keyword")}


def _some_unreadable(spark, sf_dir):
    """Customers of two nations have a nation that is no number."""
    return customer_docs(spark, sf_dir).withColumn(
        "c_nationkey", F.when(F.col("c_nationkey").isin(5, 6), F.concat(F.lit("n"), "c_nationkey")).otherwise(F.col("c_nationkey").cast("string")))


@query("all_rejects", f"""
SELECT id, 'document_parsing_exception' AS reject_type, 'failed to parse field [c_nationkey] of type [long]' AS reason, CAST(NULL AS BIGINT) AS live
FROM ({CUSTOMER_DOCS_SQL}) d WHERE c_nationkey IN (5, 6)
UNION ALL SELECT 'accepted', NULL, NULL, count(*) FILTER (WHERE c_nationkey NOT IN (5, 6)) FROM customer
""", ("SNK-3", "FLT-5"))
def all_rejects_q(spark, sf_dir):
    # one pass deals the rows; the load that is asked to accept the rest publishes it
    store = fresh_store(spark)
    store.rebuild("customer", _some_unreadable(spark, sf_dir), _BAD_NATIONS, on_reject="accept")
    live = store.read("customer").groupBy().count().select(
        F.lit("accepted").alias("id"), F.lit(None).cast("string").alias("reject_type"), F.lit(None).cast("string").alias("reason"),
        F.col("count").alias("live"))
    return store.rejects("customer").select("id", "reject_type", "reason", F.lit(None).cast("bigint").alias("live")).unionByName(live)


@query("resumed_batches", f"""
SELECT id, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal,
       c_mktsegment || CASE WHEN c_nationkey < 4 THEN '' ELSE '/again' END AS c_mktsegment FROM ({CUSTOMER_DOCS_SQL}) d
""", ("SNK-8", "SNK-3"))
def resumed_batches_q(spark, sf_dir):
    # five batches by nation; the second is refused: the first one stays, and the repeat writes the rest only
    store = fresh_store(spark)
    bad = _some_unreadable(spark, sf_dir)
    store.create("customer", bad.schema, mapping=_BAD_NATIONS)
    number = F.floor(F.regexp_extract("c_nationkey", "[0-9]+", 0).cast("int") / 4)
    try:
        store.populate_batches("customer", bad, "load", batch_of=number)
    except RuntimeError:
        pass
    else:
        raise AssertionError("a batch with rejected documents must stop the run")
    good = customer_docs(spark, sf_dir).withColumns({"c_nationkey": F.col("c_nationkey").cast("string"),
                                                     "c_mktsegment": F.concat("c_mktsegment", F.lit("/again"))})
    store.populate_batches("customer", good, "load", batch_of=number)
    return store.read("customer")
