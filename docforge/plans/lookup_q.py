"""Check queries (2.13) and the call log (AGG-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docforge.functions.porter import duckdb_stem_query
from docforge.functions.folding import fold_sql
from docforge.functions.text import analyze_tokens
from docforge.operators import calls, lookup
from docforge.plans.registry import query
from docforge.plans.text_q import _duck_tokens
from docforge.sources.tables import read_table
from docforge.session import scratch
from docforge.spec import AnalyzerSpec, FieldSpec

# The query strings of the match checks (singular/plural pairs).
MATCH_QUERIES = ["widgets", "widget", "Bolts", "ring", "polished steel", "Kovács'"]

_Q_VALUES = "(SELECT * FROM (VALUES " + ", ".join("('" + q.replace("'", "''") + "')" for q in MATCH_QUERIES) \
    + ") AS v(query))"


def _part_tokens(spark, sf_dir, analyzer):
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name")
    return analyze_tokens(part, ["id"], "p_name", analyzer)


def _match_sql(stemmed: bool) -> str:
    text = fold_sql("lower(p_name)") if stemmed else "lower(p_name)"
    qtext = fold_sql("lower(query)") if stemmed else "lower(query)"
    toks = _duck_tokens("part", "p_partkey", text)
    qtoks = _duck_tokens(_Q_VALUES, "query", qtext)
    if stemmed:
        toks = duckdb_stem_query(toks, ["p_partkey", "position"])
        qtoks = duckdb_stem_query(qtoks, ["query", "position"])
    return (f"SELECT DISTINCT q.query, CAST(t.p_partkey AS VARCHAR) AS id FROM ({toks}) t "
            f"JOIN ({qtoks}) q ON q.token = t.token")


@query("match_stemmed", _match_sql(True), ("QRY-1",))
def match_stemmed_q(spark, sf_dir):
    english = AnalyzerSpec("english")
    return lookup.match(_part_tokens(spark, sf_dir, english), lookup.query_terms(spark, MATCH_QUERIES, english))


@query("match_standard", _match_sql(False), ("QRY-1", "TXT-7"))
def match_standard_q(spark, sf_dir):
    std = AnalyzerSpec()
    return lookup.match(_part_tokens(spark, sf_dir, std), lookup.query_terms(spark, MATCH_QUERIES, std))


@query("facet_terms", """
SELECT 'p_brand' AS field, p_brand AS value, count(*) AS doc_count FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
UNION ALL
SELECT 'p_type', p_type, count(*) FROM part WHERE p_type IS NOT NULL GROUP BY p_type
""", ("QRY-2",))
def facet_terms_q(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").withColumn("id", F.col("p_partkey").cast("string"))
    return lookup.facet_terms(part, ["p_brand", "p_type"])


@query("facet_stats", """
SELECT 'p_size' AS field, CAST(min(p_size) AS DOUBLE) AS min_value, CAST(max(p_size) AS DOUBLE) AS max_value,
       count(p_size) AS doc_count FROM part
UNION ALL
SELECT 'p_retailprice', min(p_retailprice), max(p_retailprice), count(p_retailprice) FROM part
""", ("QRY-3",))
def facet_stats_q(spark, sf_dir):
    return lookup.facet_stats(read_table(spark, sf_dir, "part"), ["p_size", "p_retailprice"])


# Event type -> client operation of the call-log fixture.
CALL_OPS = {"view": "search", "error": "search", "click": "count", "signup": "index", "purchase": "bulk"}


def call_log(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    op = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in CALL_OPS.items()])
    hits = F.when((op == "search") & (F.col("event_type") != "error"),
                  F.get_json_object("props", "$.k").cast("bigint"))
    return ev.select("event_id", "event_type", "props",
                     F.concat(F.col("user_id").cast("string"), F.lit("@"), F.to_date("ts").cast("string"))
                     .alias("request"), op.alias("operation"), F.col("value").alias("duration_ms"), hits.alias("hits"),
                     F.when(F.col("event_type") == "error", F.lit("search_phase_execution_exception"))
                     .alias("error"))


@query("call_summary", """
SELECT request, count(*) AS calls, CAST(round(sum(duration_ms), 2) AS DECIMAL(20, 2)) AS duration_ms,
       count(CASE WHEN error IS NOT NULL THEN 1 END) AS errors,
       count(CASE WHEN operation = 'search' AND hits = 0 THEN 1 END) AS empty_searches,
       CASE WHEN count(CASE WHEN error IS NOT NULL THEN 1 END) > 0 THEN 'red'
            WHEN count(CASE WHEN operation = 'search' AND hits = 0 THEN 1 END) > 0 THEN 'yellow' ELSE 'none' END AS status
FROM (SELECT CAST(user_id AS VARCHAR) || '@' || CAST(CAST(ts AS DATE) AS VARCHAR) AS request,
             CASE event_type WHEN 'view' THEN 'search' WHEN 'error' THEN 'search' WHEN 'click' THEN 'count'
                             WHEN 'signup' THEN 'index' ELSE 'bulk' END AS operation,
             value AS duration_ms,
             CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS hits,
             CASE WHEN event_type = 'error' THEN 'search_phase_execution_exception' END AS error
      FROM events) c
GROUP BY request
""", ("AGG-5", "SCL-8", "RPT-13", "UDF-4"))
def call_summary_q(spark, sf_dir):
    return calls.summarize(call_log(spark, sf_dir), ["request"])


@query("term_index_lookup", f"""
SELECT DISTINCT q.query, CAST(t.p_partkey AS VARCHAR) AS id
FROM ({duckdb_stem_query(_duck_tokens("part", "p_partkey", fold_sql("lower(p_name)")), ["p_partkey", "position"])}) t
JOIN ({duckdb_stem_query(_duck_tokens(_Q_VALUES, "query", fold_sql("lower(query)")), ["query", "position"])}) q
  ON q.token = t.token
""", ("QRY-1", "TXT-6"))
def term_index_lookup_q(spark, sf_dir):
    # build the persisted term index of part (text field p_name), then answer
    # the match queries from it with pruned, pushed-down lookups
    from docforge.operators.analysis import analyzed_fields, lookup_terms, write_term_index
    from docforge.operators.sync import new_session_scoped_dir
    from docforge.plans.text_q import PART_MAPPING

    english = AnalyzerSpec("english")
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name")
    path = new_session_scoped_dir(spark, "term-index")
    write_term_index(analyzed_fields(part, "id", {"p_name": PART_MAPPING["p_name"]}, english), path)
    q_terms = lookup.query_terms(spark, MATCH_QUERIES, english)
    wanted = sorted({r["term"] for r in q_terms.collect()})  # a handful of analysed query terms
    postings = lookup_terms(spark, path, "p_name", wanted)
    return postings.join(F.broadcast(q_terms), "term").select("query", "id").distinct()


@query("recorded_calls", """
SELECT 'bulk' AS operation, CAST(3 AS BIGINT) AS calls, CAST(0 AS BIGINT) AS errors, CAST(0 AS BIGINT) AS empty_searches,
       (SELECT count(*) FROM customer) + (SELECT count(*) FROM customer WHERE c_nationkey = 3)
       + (SELECT count(*) FROM customer WHERE c_nationkey < 5) AS ops, CAST(NULL AS BIGINT) AS hits, '' AS aggregations
UNION ALL SELECT 'validate', 2, 1, 0, NULL, NULL, ''
UNION ALL SELECT 'search', 2, 0, 1, NULL, (SELECT count(DISTINCT c_mktsegment) FROM customer WHERE c_nationkey <> 3), 'segments'
""", ("UDF-4", "RPT-13"))
def recorded_calls_q(spark, sf_dir):
    # the store's own actions as its recorder saw them: a load, deletes, a batch that is refused, two searches
    from docforge.operators.store import DocumentStore
    from docforge.plans.sync_q import customer_docs
    import uuid

    recorder = calls.CallRecorder(spark, "demo")
    store = DocumentStore(spark, database=f"docforge_{uuid.uuid4().hex[:10]}", root=scratch(spark, "store"), recorder=recorder)
    docs = customer_docs(spark, sf_dir)
    mapping = {"c_name": FieldSpec("text"), "c_nationkey": FieldSpec("long"), "c_acctbal": FieldSpec("float"),
               "c_mktsegment": FieldSpec("keyword"), "flag": FieldSpec("boolean")}
    store.rebuild("customer", docs.withColumn("flag", F.lit("true")), mapping)
    store.apply_changes("customer", None, docs.where("c_nationkey = 3").select("id", F.lit(1).alias("_seq")))
    try:
        store.populate("customer", docs.where("c_nationkey < 5").withColumn("flag", F.lit("perhaps")))
    except RuntimeError:
        pass
    live = store.read("customer")
    recorder.search("customer", live.groupBy("c_mktsegment").count(), ("segments",))
    recorder.search("customer", live.where("c_nationkey = 3").limit(10))
    rows = recorder.frame()
    summary = calls.summarize(rows, ["operation"]).select("operation", "calls", "errors", "empty_searches")
    sums = rows.groupBy("operation").agg(F.sum("ops").alias("ops"), F.sum("hits").alias("hits"),
                                         F.array_join(F.array_distinct(F.flatten(F.collect_list("aggregations"))), ",").alias("aggregations"))
    return summary.join(sums, "operation")


@query("call_log", """
SELECT event_id, CAST(user_id AS VARCHAR) || '@' || CAST(CAST(ts AS DATE) AS VARCHAR) AS request,
       CASE event_type WHEN 'view' THEN 'search' WHEN 'error' THEN 'search' WHEN 'click' THEN 'count'
                       WHEN 'signup' THEN 'index' ELSE 'bulk' END AS operation,
       value AS duration_ms,
       CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS hits,
       CASE WHEN event_type = 'error' THEN 'search_phase_execution_exception' END AS error,
       CASE WHEN event_type = 'purchase'
            THEN CAST(json_extract_string(props, '$.k') AS BIGINT) + event_id % 4 END AS ops
FROM events
""", ("RPT-13", "UDF-4"))
def call_log_q(spark, sf_dir):
    # per-call records; a bulk body holds k index actions (two lines each) and
    # event_id % 4 deletes (one line each): ops are counted from its lines
    log = call_log(spark, sf_dir)
    k = F.get_json_object("props", "$.k").cast("bigint")
    deletes = F.col("event_id") % 4
    ops = F.when(F.col("event_type") == "purchase", calls.bulk_op_count(2 * k + deletes, deletes))
    return log.select("event_id", "request", "operation", "duration_ms", "hits", "error", ops.alias("ops"))
