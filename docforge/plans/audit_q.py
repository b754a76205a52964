"""Queries for the schema audit over the fleet (2.10) and the call log (AGG-5)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docforge.operators import audit
from docforge.operators.store import DocumentStore
from docforge.plans import fleet
from docforge.plans.registry import query
from docforge.sources.tables import read_table, small_frame
from docforge.session import scratch
from docforge.spec import AnalyzerSpec, FieldSpec

# ----------------------------------------------------------------- Spark side


def _inputs(spark, sf_dir):
    datasets = fleet.datasets_df(spark)
    indexes = fleet.indexes_df(spark)
    declared = fleet.declared_df(spark)
    live = audit.live_indexes(datasets, indexes)
    existing = live.where("exists").select("code")
    # The only data-dependent input: one aggregate pass per source table
    # (row count + non-null count per projected column), materialised once.
    stats = fleet.table_stats(spark, sf_dir)
    observed = fleet.observed_stats(spark, stats).join(existing, "code", "left_semi")
    actual = audit.observed_from_stats(observed, declared)
    counts = fleet.counts_from_stats(spark, stats)
    return datasets, indexes, declared.join(existing, "code", "left_semi"), live, actual, counts


# ----------------------------------------------------------------- SQL side

_ALIAS_SQL = f"""SELECT alias, max_by(index, position) AS index
FROM (SELECT position, index, unnest(aliases) AS alias FROM {fleet.INDEXES_SQL} i) x GROUP BY alias"""

_LIVE_SQL = f"""SELECT d.code, coalesce(a.index, n.index, d.code) AS index,
       (a.index IS NOT NULL OR n.index IS NOT NULL) AS "exists"
FROM {fleet.DATASETS_SQL} d LEFT JOIN ({_ALIAS_SQL}) a ON a.alias = d.code
LEFT JOIN {fleet.INDEXES_SQL} n ON n.index = d.code"""

_TABLE_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, count(*) AS docs FROM {t}" for t in sorted({i[2] for i in fleet.INDEXES}))
_COUNTS_SQL = f"""SELECT i.position, i.index, i.aliases, c.docs
FROM {fleet.INDEXES_SQL} i JOIN ({_TABLE_COUNTS}) c ON c.source_table = i.source_table"""


def _observed_raw_sql() -> str:
    parts = []
    for code, _entity, table, *_ in fleet.DATASETS:
        for f in fleet.SOURCE_FIELDS[code]:
            col = "NULL::VARCHAR" if (code, f) in fleet.ABSENT_FIELDS else f
            parts.append(
                f"SELECT '{code}' AS code, '{f}' AS field, CASE any_value(typeof({col})) "
                f"WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'integral' WHEN 'INTEGER' THEN 'integral' "
                f"WHEN 'DOUBLE' THEN 'fractional' WHEN 'FLOAT' THEN 'fractional' WHEN 'TIMESTAMP' THEN 'timestamp' "
                f"WHEN 'BOOLEAN' THEN 'boolean' ELSE 'object' END AS kind, count({col}) AS present_docs FROM {table}")
    return " UNION ALL ".join(parts)


_EXISTING_SQL = f"SELECT code FROM ({_LIVE_SQL}) l WHERE \"exists\""

_ACTUAL_SQL = f"""SELECT o.code, o.field,
  CASE WHEN o.kind = 'object' THEN NULL
       WHEN coalesce((o.kind = 'string' AND d.type IN ('text', 'keyword')) OR (o.kind = 'integral' AND d.type IN ('long', 'integer'))
            OR (o.kind = 'fractional' AND d.type IN ('float', 'double')) OR (o.kind = 'timestamp' AND d.type = 'date')
            OR (o.kind = 'boolean' AND d.type = 'boolean'), false) THEN d.type
       ELSE CASE o.kind WHEN 'string' THEN 'text' WHEN 'integral' THEN 'long' WHEN 'fractional' THEN 'float'
                        WHEN 'timestamp' THEN 'date' WHEN 'boolean' THEN 'boolean' END END AS actual_type,
  CASE WHEN coalesce((o.kind = 'string' AND d.type IN ('text', 'keyword')) OR (o.kind = 'integral' AND d.type IN ('long', 'integer'))
            OR (o.kind = 'fractional' AND d.type IN ('float', 'double')) OR (o.kind = 'timestamp' AND d.type = 'date')
            OR (o.kind = 'boolean' AND d.type = 'boolean'), false) THEN coalesce(d.has_keyword, false)
       ELSE o.kind = 'string' END AS has_keyword,
  o.present_docs
FROM ({_observed_raw_sql()}) o LEFT JOIN {fleet.DECLARED_SQL} d ON d.code = o.code AND d.field = o.field
WHERE o.present_docs > 0 AND o.code IN ({_EXISTING_SQL})"""

_DECLARED_SQL = f"SELECT * FROM {fleet.DECLARED_SQL} d WHERE d.code IN ({_EXISTING_SQL})"

_DRIFT_SQL = f"""SELECT d.code, 'missing' AS kind, d.field, d.type AS declared, CAST(NULL AS VARCHAR) AS actual
FROM ({_DECLARED_SQL}) d WHERE NOT EXISTS (SELECT 1 FROM ({_ACTUAL_SQL}) a WHERE a.code = d.code AND a.field = d.field)
UNION ALL
SELECT a.code, 'unexpected', a.field, NULL, a.actual_type
FROM ({_ACTUAL_SQL}) a WHERE NOT EXISTS (SELECT 1 FROM ({_DECLARED_SQL}) d WHERE a.code = d.code AND a.field = d.field)
UNION ALL
SELECT d.code, 'retyped', d.field, d.type, a.actual_type
FROM ({_DECLARED_SQL}) d JOIN ({_ACTUAL_SQL}) a ON a.code = d.code AND a.field = d.field
WHERE d.type IS NOT NULL AND a.actual_type IS NOT NULL AND d.type <> a.actual_type"""

_KEY_RE = audit.ANALYZER_KEY

_AUDIT_SQL = f"""
WITH live AS ({_LIVE_SQL}),
counts AS ({_COUNTS_SQL}),
idx AS (SELECT l.code, l.index, l."exists", i.aliases, c.docs FROM live l
        LEFT JOIN {fleet.INDEXES_SQL} i ON i.index = l.index LEFT JOIN counts c ON c.index = l.index),
s AS (SELECT index, max(CASE WHEN key = '{fleet.STEMMER_SETTING}' THEN value END) AS indexed_language,
             max(CASE WHEN key = 'index.max_result_window' THEN value END) AS win,
             max(CASE WHEN key = 'index.mapping.total_fields.limit' THEN value END) AS field_limit
      FROM {fleet.SETTINGS_SQL} x GROUP BY index),
names AS (SELECT index, string_agg(name, ', ' ORDER BY name) AS analyzers
          FROM (SELECT DISTINCT index, regexp_extract(key, '{_KEY_RE}', 1) AS name FROM {fleet.SETTINGS_SQL} y
                WHERE regexp_matches(key, '{_KEY_RE}')) z GROUP BY index),
drift AS ({_DRIFT_SQL}),
ds AS (SELECT code,
         string_agg(CASE WHEN kind = 'retyped' THEN field || ' (declared ' || declared || ', actual ' || actual || ')' END, ', '
                    ORDER BY CASE WHEN kind = 'retyped' THEN field || ' (declared ' || declared || ', actual ' || actual || ')' END) AS retyped,
         string_agg(CASE WHEN kind = 'missing' THEN field END, ', ' ORDER BY CASE WHEN kind = 'missing' THEN field END) AS missing,
         string_agg(CASE WHEN kind = 'unexpected' THEN field END, ', ' ORDER BY CASE WHEN kind = 'unexpected' THEN field END) AS unexpected
       FROM drift GROUP BY code),
nd AS (SELECT code, count(*) AS n_declared FROM ({_DECLARED_SQL}) d GROUP BY code),
na AS (SELECT code, count(*) AS n_actual FROM ({_ACTUAL_SQL}) a GROUP BY code),
b AS (SELECT d.code, nullif(d.language, '') AS wanted, d.dynamic, idx.index, idx."exists", idx.aliases, idx.docs,
             s.indexed_language, s.win, s.field_limit, names.analyzers, ds.retyped, ds.missing, ds.unexpected,
             coalesce(nd.n_declared, 0) AS n_declared, coalesce(na.n_actual, 0) AS n_actual
      FROM {fleet.DATASETS_SQL} d JOIN idx ON idx.code = d.code LEFT JOIN s ON s.index = idx.index
      LEFT JOIN names ON names.index = idx.index LEFT JOIN ds ON ds.code = d.code
      LEFT JOIN nd ON nd.code = d.code LEFT JOIN na ON na.code = d.code),
c AS (
  SELECT code, 1 AS position, 'alias' AS check_id,
         CASE WHEN len(coalesce(aliases, []::VARCHAR[])) > 0 THEN 'ok' ELSE 'warn' END AS status,
         CASE WHEN len(coalesce(aliases, []::VARCHAR[])) > 0 THEN 'served through ' || array_to_string(aliases, ', ')
              ELSE 'addressed directly, no alias' END AS detail FROM b WHERE "exists"
  UNION ALL
  SELECT code, 2, 'analysis',
         CASE WHEN wanted IS NOT NULL AND wanted IS DISTINCT FROM indexed_language THEN 'warn'
              WHEN coalesce(length(analyzers), 0) > 0 THEN 'ok' ELSE 'warn' END,
         CASE WHEN wanted IS NOT NULL AND wanted IS DISTINCT FROM indexed_language
                   THEN 'configured for ' || wanted || ' but built with ' || coalesce(indexed_language, 'no custom analyzer')
              WHEN coalesce(length(analyzers), 0) > 0
                   THEN 'custom analyzer: ' || analyzers || coalesce(' (' || indexed_language || ' stemming)', '')
              ELSE 'default analyzer only' END FROM b WHERE "exists"
  UNION ALL
  SELECT code, 3, 'dynamic',
         CASE WHEN coalesce(lower(dynamic), 'true') IN ('strict', 'false') THEN 'ok' ELSE 'warn' END,
         'dynamic: ' || coalesce(lower(dynamic), 'true') FROM b WHERE "exists"
  UNION ALL
  SELECT code, 4, 'drift',
         CASE WHEN len(list_filter([CASE WHEN length(retyped) > 0 THEN 1 END, CASE WHEN length(missing) > 0 THEN 1 END,
                                   CASE WHEN length(unexpected) > 0 THEN 1 END], lambda x: x IS NOT NULL)) = 0
              THEN 'ok' ELSE 'warn' END,
         CASE WHEN coalesce(length(retyped), 0) + coalesce(length(missing), 0) + coalesce(length(unexpected), 0) = 0
              THEN CAST(n_declared AS VARCHAR) || ' declared fields, all present'
              ELSE concat_ws('; ', CASE WHEN length(retyped) > 0 THEN 'type mismatch on ' || retyped END,
                                   CASE WHEN length(missing) > 0 THEN 'declared but absent: ' || missing END,
                                   CASE WHEN length(unexpected) > 0 THEN 'present but never declared: ' || unexpected END)
              END FROM b WHERE "exists"
  UNION ALL
  SELECT code, 5, 'fields',
         CASE WHEN n_actual >= floor(coalesce(CAST(field_limit AS BIGINT), {fleet.DEFAULT_FIELD_LIMIT}) * 0.8)
              THEN 'warn' ELSE 'ok' END,
         CAST(n_actual AS VARCHAR) || ' of ' || CAST(coalesce(CAST(field_limit AS BIGINT), {fleet.DEFAULT_FIELD_LIMIT}) AS VARCHAR)
           || ' mapped fields used' FROM b WHERE "exists"
  UNION ALL
  SELECT code, 6, 'paging',
         CASE WHEN coalesce(docs, 0) <= coalesce(CAST(win AS BIGINT), {fleet.DEFAULT_RESULT_WINDOW}) THEN 'ok' ELSE 'warn' END,
         format('{{:,}}', coalesce(docs, 0)) || ' documents, window '
           || format('{{:,}}', coalesce(CAST(win AS BIGINT), {fleet.DEFAULT_RESULT_WINDOW})) FROM b WHERE "exists"
  UNION ALL
  SELECT code, 1, 'index', 'na', 'not created yet' FROM b WHERE NOT "exists")
SELECT code, CAST(position AS BIGINT) AS position, check_id,
       CASE check_id {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in audit.CHECK_LABELS.items())} END AS label,
       status, detail,
       CAST(CASE WHEN status = 'warn' THEN CASE check_id {' '.join(f"WHEN '{k}' THEN {v}" for k, v in audit.CHECK_ISSUES.items())} END END AS BIGINT) AS issue
FROM c
"""


@query("observed_fields", _ACTUAL_SQL, ("RPT-4", "AGG-8", "FLT-6"))
def observed_fields_q(spark, sf_dir):
    return _inputs(spark, sf_dir)[4]


@query("field_comparison", f"""
SELECT coalesce(d.code, a.code) AS code, coalesce(d.field, a.field) AS field, d.type AS declared, a.actual_type AS actual,
       CASE WHEN a.actual_type IS NULL THEN 'missing' WHEN d.type IS NULL THEN 'undeclared'
            WHEN d.type <> a.actual_type THEN 'mismatch' ELSE 'ok' END AS status
FROM ({_DECLARED_SQL}) d FULL OUTER JOIN ({_ACTUAL_SQL}) a ON a.code = d.code AND a.field = d.field
""", ("RPT-9", "JON-1", "SCL-4", "SET-1"))
def field_comparison_q(spark, sf_dir):
    _, _, declared, _, actual, _ = _inputs(spark, sf_dir)
    return audit.field_comparison(declared, actual)


@query("drift_sets", _DRIFT_SQL, ("SET-2", "SET-3"))
def drift_sets_q(spark, sf_dir):
    _, _, declared, _, actual, _ = _inputs(spark, sf_dir)
    return audit.drift_sets(declared, actual)


@query("schema_audit", _AUDIT_SQL, ("RPT-1", "RPT-2", "RPT-3", "RPT-4", "RPT-5", "RPT-6", "RPT-7", "AGG-10", "SCL-5"))
def schema_audit_q(spark, sf_dir):
    datasets, indexes, declared, live, actual, counts = _inputs(spark, sf_dir)
    return audit.schema_audit(datasets, live, indexes, fleet.settings_df(spark), declared, actual, counts,
                              fleet.DEFAULT_RESULT_WINDOW, fleet.DEFAULT_FIELD_LIMIT, fleet.STEMMER_SETTING)


_INTENTS_SQL = f"""
WITH live AS ({_LIVE_SQL}),
a AS (SELECT code, field AS name,
             CASE WHEN actual_type = 'text' AND has_keyword THEN 'text + .keyword' ELSE actual_type END AS actual_type
      FROM ({_ACTUAL_SQL}) x),
j AS (SELECT i.code, i.name, (i.facet OR i.filterable) AS wants_facet, i.searchable AS wants_searchable,
             i.sortable AS wants_sortable, f.name IS NOT NULL AS in_facet_fields,
             EXISTS (SELECT 1 FROM {fleet.SEARCH_FIELDS_SQL} s WHERE s.code = i.code AND s.name = i.name) AS in_search_fields,
             EXISTS (SELECT 1 FROM {fleet.SORT_FIELDS_SQL} s WHERE s.code = i.code AND s.name = i.name) AS in_sort_fields,
             f.target AS facet_field, a.actual_type, coalesce(live."exists", false) AS index_exists
      FROM {fleet.INTENTS_SQL} i LEFT JOIN {fleet.FACET_FIELDS_SQL} f ON f.code = i.code AND f.name = i.name
      LEFT JOIN a ON a.code = i.code AND a.name = i.name LEFT JOIN live ON live.code = i.code)
SELECT code, name, wants_facet, wants_searchable, wants_sortable, in_facet_fields, in_search_fields, in_sort_fields,
       facet_field, actual_type, (actual_type IS NOT NULL AND actual_type <> 'text') AS aggregatable,
       CASE WHEN wants_facet AND NOT in_facet_fields THEN 'facet dropped before facetFields'
            WHEN wants_searchable AND NOT in_search_fields THEN 'searchable but not in searchFields'
            WHEN wants_sortable AND NOT in_sort_fields THEN 'sortable but not in sortFields'
            WHEN NOT index_exists THEN NULL
            WHEN (in_facet_fields OR in_search_fields OR in_sort_fields) AND actual_type IS NULL
                 THEN 'used but not mapped; needs a rebuild'
            WHEN in_facet_fields AND NOT (actual_type IS NOT NULL AND actual_type <> 'text')
                 THEN 'faceted on a ' || actual_type || ' field' END AS problem
FROM j WHERE wants_facet OR wants_searchable OR wants_sortable OR actual_type IS NOT NULL
"""


@query("field_problems", f"SELECT * FROM ({_INTENTS_SQL}) i WHERE problem IS NOT NULL", ("FLT-10",))
def field_problems_q(spark, sf_dir):
    return audit.problems_only(field_intents_q(spark, sf_dir))


@query("field_intents", _INTENTS_SQL, ("RPT-10", "JON-5", "SCL-1", "SCL-2", "SCL-3", "FLT-9", "FLT-10"))
def field_intents_q(spark, sf_dir):
    _, _, _, live, actual, _ = _inputs(spark, sf_dir)
    return audit.field_intents(fleet.intents_df(spark), fleet.facet_fields_df(spark), fleet.search_fields_df(spark),
                               fleet.sort_fields_df(spark), actual, live)


def _built_store(spark, sf_dir):
    """A store with two published datasets of several generations, an alias of another's generation, a concrete table
    and one that no dataset claims; all loaded from the given tables."""
    store = DocumentStore(spark, database=f"docforge_{uuid.uuid4().hex[:10]}", root=scratch(spark, "store"))
    table = lambda name, key: read_table(spark, sf_dir, name).select(F.col(key).cast("string").alias("id"))
    store.rebuild("customer", table("customer", "c_custkey"), {}, AnalyzerSpec("english"))
    part = store.rebuild("part", table("part", "p_partkey"), {}, strict=False)
    store.publish("catalog", part)
    old = table("documents", "doc_id")
    store.rebuild("documents", old.where("CAST(id AS BIGINT) % 2 = 0"))
    store.rebuild("documents", old, keep_old=True)
    store.apply_changes("documents", None, old.where("CAST(id AS BIGINT) % 3 = 0").withColumn("_seq", F.lit(1)))
    for name, source, key in (("orders", "orders", "o_orderkey"), ("legacy2products", "part", "p_partkey"), ("legacy_products", "supplier", "s_suppkey")):
        table(source, key).createOrReplaceTempView(f"v_{store.db}")
        spark.sql(f"CREATE TABLE {store.qualified(name)} USING parquet LOCATION '{store.root}/{store.db}.tables/{name}' AS SELECT * FROM v_{store.db}")
    spark.catalog.dropTempView(f"v_{store.db}")
    return store


def _plain(index, owner):
    """A generation's name without its time stamp."""
    return F.when(owner.isNull(), index).otherwise(F.concat(owner, F.lit("#"), F.row_number().over(
        Window.partitionBy("owner").orderBy("index")).cast("string")))


def _inventory(store):
    entries = store.catalog()
    rows = store.indexes(entries)
    datasets = small_frame(store.spark, [(c,) for c in ("customer", "part", "orders", "documents", "catalog_missing")], "code string")
    found = audit.fleet_inventory(rows.select("index", "aliases"), rows.select("index", "docs"), datasets)
    return found.join(rows.select("index", "owner"), "index").select(
        _plain(F.col("index"), F.col("owner")).alias("index"), "docs", "aliases", "claimed_by")


_INVENTORY_SQL = """
SELECT 'customer#1' AS index, (SELECT count(*) FROM customer) AS docs, 'customer' AS aliases, 'customer' AS claimed_by
UNION ALL SELECT 'part#1', (SELECT count(*) FROM part), 'catalog,part', 'part'
UNION ALL SELECT 'documents#1', (SELECT count(*) FROM documents WHERE doc_id % 2 = 0), '', NULL
UNION ALL SELECT 'documents#2', (SELECT count(*) FROM documents WHERE doc_id % 3 <> 0), 'documents', 'documents'
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), '', 'orders'
UNION ALL SELECT 'legacy2products', (SELECT count(*) FROM part), '', NULL
UNION ALL SELECT 'legacy_products', (SELECT count(*) FROM supplier), '', NULL
"""


@query("alias_resolution", f"""
SELECT unnest(string_split(aliases, ',')) AS alias, index, docs FROM ({_INVENTORY_SQL}) i WHERE aliases <> ''
""", ("AGG-9", "SRC-6"))
def alias_resolution_q(spark, sf_dir):
    rows = _built_store(spark, sf_dir).indexes()
    named = rows.select("index", _plain(F.col("index"), F.col("owner")).alias("name"), "docs")
    return (audit.alias_resolution(rows).join(named, "index").select("alias", F.col("name").alias("index"), "docs"))


@query("fleet_inventory", _INVENTORY_SQL, ("RPT-11", "JON-4", "SRC-6", "SNK-9"))
def fleet_inventory_q(spark, sf_dir):
    return _inventory(_built_store(spark, sf_dir))


@query("fleet_unclaimed", f"SELECT * FROM ({_INVENTORY_SQL}) i WHERE claimed_by IS NULL", ("FLT-10",))
def fleet_unclaimed_q(spark, sf_dir):
    return audit.unclaimed_only(_inventory(_built_store(spark, sf_dir)))


@query("fleet_settings", """
SELECT 'customer#1' AS index, 'index.analysis.analyzer.docforge_text.tokenizer' AS key, 'standard' AS value, (SELECT count(*) FROM customer) AS docs
UNION ALL SELECT 'customer#1', 'index.analysis.filter.docforge_stemmer.language', 'english', (SELECT count(*) FROM customer)
UNION ALL SELECT 'customer#1', 'index.mapping.dynamic', 'strict', (SELECT count(*) FROM customer)
UNION ALL SELECT 'part#1', 'index.mapping.dynamic', 'true', (SELECT count(*) FROM part)
UNION ALL SELECT 'documents#1', 'index.mapping.dynamic', 'strict', (SELECT count(*) FROM documents WHERE doc_id % 2 = 0)
UNION ALL SELECT 'documents#2', 'index.mapping.dynamic', 'strict', (SELECT count(*) FROM documents WHERE doc_id % 3 <> 0)
""", ("SRC-6", "RPT-3"))
def fleet_settings_q(spark, sf_dir):
    # what the live indexes were built with, not what is configured now
    store = _built_store(spark, sf_dir)
    entries = store.catalog()
    rows = store.indexes(entries).where("owner IS NOT NULL")
    named = rows.select("index", _plain(F.col("index"), F.col("owner")).alias("name"), "docs")
    return store.settings(entries).join(named, "index").select(F.col("name").alias("index"), "key", "value", "docs")


@query("pattern_misses", f"""
SELECT p.pattern, count(CASE WHEN index LIKE p.lk ESCAPE '!' THEN 1 END) AS matched,
       CAST(CASE WHEN count(CASE WHEN index LIKE p.lk ESCAPE '!' THEN 1 END) = 0 THEN count(*) ELSE 0 END AS BIGINT) AS missed
FROM ({_INVENTORY_SQL}) c, (VALUES ('legacy_*', 'legacy!_%'), ('shop_*', 'shop!_%'), ('*', '%')) AS p(pattern, lk)
WHERE c.docs > (SELECT count(*) FROM supplier) GROUP BY p.pattern
""", ("RPT-12", "FLT-7"))
def pattern_misses_q(spark, sf_dir):
    # only indexes larger than the supplier table count, so that the answer follows the data
    store = _built_store(spark, sf_dir)
    rows = store.indexes()
    least = read_table(spark, sf_dir, "supplier").count()
    large = rows.where(F.col("docs") > least)
    return reduce(DataFrame.unionByName, [audit.pattern_misses(large, p).select(F.lit(p).alias("pattern"), "matched", "missed")
                                          for p in ("legacy_*", "shop_*", "*")])


_STATUS_SQL = f"""
SELECT l.code, l.index, l."exists",
       CAST(CASE WHEN l."exists" THEN coalesce(c.docs, 0) ELSE 0 END AS BIGINT) AS documents,
       CAST(CASE WHEN l."exists" THEN coalesce(n.mapped_fields, 0) ELSE 0 END AS BIGINT) AS mapped_fields
FROM ({_LIVE_SQL}) l LEFT JOIN ({_COUNTS_SQL}) c ON c.index = l.index
LEFT JOIN (SELECT code, count(*) AS mapped_fields FROM ({_ACTUAL_SQL}) a GROUP BY code) n ON n.code = l.code
"""


@query("dataset_status", _STATUS_SQL, ("AGG-2", "AGG-3", "QRY-4", "JON-6"))
def dataset_status_q(spark, sf_dir):
    _, _, _, live, actual, counts = _inputs(spark, sf_dir)
    return audit.dataset_status(live, counts, actual)


@query("dataset_report", f"""
SELECT d.code, d.entity, s.index, s."exists", s.documents,
       CASE WHEN s."exists" THEN coalesce(array_to_string(i.aliases, ','), '') ELSE '' END AS aliases,
       CAST(coalesce(k.warnings, 0) AS BIGINT) AS warnings,
       CASE WHEN d.has_provider THEN 'provider' WHEN d.source_table IS NOT NULL THEN 'table' ELSE 'none' END AS document_source,
       k.checks
FROM {fleet.DATASETS_SQL} d JOIN ({_STATUS_SQL}) s ON s.code = d.code
LEFT JOIN {fleet.INDEXES_SQL} i ON i.index = s.index
LEFT JOIN (SELECT code, count(CASE WHEN status = 'warn' THEN 1 END) AS warnings,
                  string_agg(check_id || ':' || status, ',' ORDER BY position) AS checks
           FROM ({_AUDIT_SQL}) a GROUP BY code) k ON k.code = d.code
""", ("RPT-8", "AGG-4", "SCL-10"))
def dataset_report_q(spark, sf_dir):
    datasets, indexes, declared, live, actual, counts = _inputs(spark, sf_dir)
    checks = audit.schema_audit(datasets, live, indexes, fleet.settings_df(spark), declared, actual, counts,
                                fleet.DEFAULT_RESULT_WINDOW, fleet.DEFAULT_FIELD_LIMIT, fleet.STEMMER_SETTING)
    status = audit.dataset_status(live, counts, actual)
    return audit.dataset_report(datasets, status, indexes, checks)


@query("dataset_selection", f"""
SELECT s.* FROM ({_STATUS_SQL}) s JOIN {fleet.DATASETS_SQL} d ON d.code = s.code
WHERE d.code = 'Part' OR regexp_extract(d.entity, '([^\\\\]+)$', 1) = 'Part' OR d.code = 'orders'
""", ("FLT-8", "AGG-3"))
def dataset_selection_q(spark, sf_dir):
    _, _, _, live, actual, counts = _inputs(spark, sf_dir)
    datasets = fleet.datasets_df(spark)
    chosen = audit.select_datasets(datasets, "Part").unionByName(audit.select_datasets(datasets, "orders"))
    return audit.dataset_status(live, counts, actual).join(chosen.select("code"), "code", "left_semi")


# ------------------------------------------- audit of what was built, from the manifest alone
_BUILT_MAPPINGS = {
    "customer": [("c_name", "text", True), ("c_nationkey", "long", False), ("c_acctbal", "text", False), ("c_comment", "text", False)],
    "part": [("p_name", "text", True), ("p_brand", "keyword", False), ("p_type", "keyword", False), ("p_size", "long", False),
             ("p_retailprice", "long", False)],
    "documents": [("text", "text", False), ("lang", "keyword", False)],
}
_BUILT_LIMITS = {"customer": {"index.max_result_window": "20000"}, "part": {"index.mapping.total_fields.limit": "6", "index.max_result_window": "100"},
                 "orders": {"index.max_result_window": "500"}, "documents": {}}
_BUILT_LANGUAGE = {"customer": "english", "documents": "english"}
_BUILT_LOOSE = ("part",)
_BUILT_INDEXES = [(1, "customer#", "customer", ["customer"]), (2, "documents#", "documents", ["documents"]), (3, "orders", "orders", []),
                  (4, "part#", "part", ["catalog", "part"])]


def _built_fleet(spark, sf_dir):
    """A store whose tables were built with older mappings and with limits of their own, one of them made elsewhere."""
    store = DocumentStore(spark, database=f"docforge_{uuid.uuid4().hex[:10]}", root=scratch(spark, "store"))
    keys = {d[0]: d[3] for d in fleet.DATASETS}

    def docs(name):
        rows = read_table(spark, sf_dir, name)
        fields = [f for f, _, _ in _BUILT_MAPPINGS.get(name, []) if f in rows.columns]
        return rows.select(F.col(keys[name]).cast("string").alias("id"), *fields)

    for name, fields in _BUILT_MAPPINGS.items():
        made = store.rebuild(name, docs(name), {f: FieldSpec(kind, keyword) for f, kind, keyword in fields}, AnalyzerSpec(_BUILT_LANGUAGE.get(name)),
                             strict=name not in _BUILT_LOOSE, settings=_BUILT_LIMITS[name])
        if name == "part":
            store.publish("catalog", made)
    store.apply_changes("documents", None, docs("documents").select("id").where("CAST(id AS BIGINT) % 3 = 0").withColumn("_seq", F.lit(1)))
    # documents that were there, are deleted, and come back; and a new one
    again = docs("documents").where("CAST(id AS BIGINT) % 6 = 0")
    store.apply_changes("documents", again.unionByName(again.limit(1).withColumn("id", F.lit("new"))).withColumn("_seq", F.lit(2)), None)
    docs("orders").createOrReplaceTempView(f"v_{store.db}")
    spark.sql(f"CREATE TABLE {store.qualified('orders')} USING parquet LOCATION '{store.root}/{store.db}.tables/orders' AS SELECT * FROM v_{store.db}")
    spark.catalog.dropTempView(f"v_{store.db}")
    store.adopt("orders", _BUILT_LIMITS["orders"])
    return store


_BUILT_COUNTS = {"customer": "SELECT count(*) FROM customer", "part": "SELECT count(*) FROM part", "orders": "SELECT count(*) FROM orders",
                 "documents": "SELECT count(*) + 1 FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 6 = 0"}
_BUILT_SETTINGS = ([(f"{c}#", "index.analysis.analyzer.docforge_text.tokenizer", "standard") for c in _BUILT_LANGUAGE]
                   + [(f"{c}#", fleet.STEMMER_SETTING, v) for c, v in _BUILT_LANGUAGE.items()]
                   + [(c if c == "orders" else f"{c}#", k, v) for c, limits in _BUILT_LIMITS.items() for k, v in limits.items()])
_BUILT_SQL = (
    _AUDIT_SQL
    .replace(_ACTUAL_SQL, "SELECT code, field, type AS actual_type, has_keyword FROM " + fleet.values_sql(
        [(c, *f) for c, fields in _BUILT_MAPPINGS.items() for f in fields], ["code", "field", "type", "has_keyword"]))
    .replace(_COUNTS_SQL, " UNION ALL ".join(f"SELECT '{c if c == 'orders' else c + '#'}' AS index, ({n}) AS docs" for c, n in _BUILT_COUNTS.items()))
    .replace(fleet.INDEXES_SQL, fleet.values_sql(_BUILT_INDEXES, ["position", "index", "source_table", "aliases"]))
    .replace(fleet.SETTINGS_SQL, fleet.values_sql(_BUILT_SETTINGS, ["index", "key", "value"]))
    .replace(fleet.DATASETS_SQL, fleet.values_sql([(*d[:5], None if d[0] == "orders" else "true" if d[0] in _BUILT_LOOSE else "strict", d[6])
                                                   for d in fleet.DATASETS],
                                                  ["code", "entity", "source_table", "id_field", "language", "dynamic", "has_provider"])))


@query("built_audit", _BUILT_SQL, ("RPT-1", "RPT-2", "RPT-5", "RPT-6", "RPT-8", "SRC-6", "SNK-4"))
def built_audit_q(spark, sf_dir):
    store = _built_fleet(spark, sf_dir)
    entries = store.catalog()
    rows, settings = store.indexes(entries), store.settings(entries)
    live = audit.live_indexes(fleet.datasets_df(spark), rows)
    built = F.broadcast(settings.where("key = 'index.mapping.dynamic'").select("index", F.col("value").alias("dynamic")))
    datasets = (fleet.datasets_df(spark).drop("dynamic").join(live.select("code", "index"), "code").join(built, "index", "left").drop("index"))
    there = live.where("exists").select("code", "index")
    actual = store.mappings(entries).join(F.broadcast(there), "index").select("code", "field", F.col("type").alias("actual_type"), "has_keyword")
    return audit.schema_audit(datasets, live, rows, settings, fleet.declared_df(spark).join(there.select("code"), "code", "left_semi"), actual,
                              rows.select("index", "docs"), fleet.DEFAULT_RESULT_WINDOW, fleet.DEFAULT_FIELD_LIMIT, fleet.STEMMER_SETTING)
