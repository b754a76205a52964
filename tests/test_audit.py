"""Audit operators on the reference's inspector cases (FIXTURES A4, A5, A7)."""

import pytest

from docforge.operators import audit, calls

DS_SCHEMA = "code string, entity string, source_table string, id_field string, language string, " \
            "dynamic string, has_provider boolean"
IDX_SCHEMA = "position int, index string, source_table string, aliases array<string>"


def _audit(spark, *, exists=True, aliases=(), settings=(), dynamic=None, language=None, docs=0,
           declared=(), actual=()):
    datasets = spark.createDataFrame([("x", None, "t", "id", language, dynamic, False)], DS_SCHEMA)
    idx_rows = [(1, "x_1", "t", ["x", *aliases])] if exists else []
    if exists and not aliases:
        idx_rows = [(1, "x", "t", [])]
    indexes = spark.createDataFrame(idx_rows, IDX_SCHEMA)
    live = audit.live_indexes(datasets, indexes)
    index_name = idx_rows[0][1] if exists else "x"
    st = spark.createDataFrame([(index_name, k, v) for k, v in settings], "index string, key string, value string")
    decl = spark.createDataFrame([("x", f, t, False) for f, t in declared],
                                 "code string, field string, type string, has_keyword boolean")
    act = spark.createDataFrame([("x", f, t, False, 1) for f, t in actual],
                                "code string, field string, actual_type string, has_keyword boolean, present_docs long")
    counts = spark.createDataFrame([(index_name, docs)], "index string, docs long")
    rows = audit.schema_audit(datasets, live, indexes, st, decl, act, counts).orderBy("position").collect()
    return {r["check_id"]: (r["status"], r["detail"]) for r in rows}, rows


def test_missing_index_single_na(spark):
    checks, rows = _audit(spark, exists=False)
    assert len(rows) == 1 and rows[0]["status"] == "na" and rows[0]["issue"] is None


def test_defaults_warn(spark):
    checks, rows = _audit(spark, settings=[("index.number_of_shards", "1")])
    assert [r["check_id"] for r in rows] == audit.CHECK_ORDER
    assert checks["alias"][0] == "warn" and checks["analysis"][0] == "warn" and checks["dynamic"][0] == "warn"
    assert checks["drift"][0] == "ok"
    assert sum(1 for r in rows if r["status"] == "warn") == 3


def test_accepted_configuration(spark):
    checks, _ = _audit(spark, aliases=["pkg"], dynamic="strict",
                       settings=[("index.analysis.analyzer.english_folding.tokenizer", "standard")])
    assert checks["alias"][0] == "ok" and checks["analysis"][0] == "ok" and checks["dynamic"][0] == "ok"
    assert "english_folding" in checks["analysis"][1]


def test_dynamic_false_is_safe(spark):
    checks, _ = _audit(spark, dynamic="false")
    assert checks["dynamic"][0] == "ok"


def test_beyond_and_explicit_window(spark):
    checks, _ = _audit(spark, docs=14244)
    assert checks["paging"] == ("warn", "14,244 documents, window 10,000")
    checks, _ = _audit(spark, docs=14244, settings=[("index.max_result_window", "100000")])
    assert checks["paging"][0] == "ok"


def test_analyzer_drift_and_match(spark):
    built = [("index.analysis.analyzer.docforge_text.tokenizer", "standard"),
             ("index.analysis.filter.docforge_stemmer.language", "english")]
    checks, _ = _audit(spark, language="hungarian", settings=built)
    assert checks["analysis"][0] == "warn" and "hungarian" in checks["analysis"][1]
    checks, _ = _audit(spark, language="english", settings=built)
    assert checks["analysis"][0] == "ok"


def test_drift_three_kinds(spark):
    # FIXTURES A4
    declared = [("downloads", "long"), ("name", "text"), ("neverIndexed", "keyword")]
    actual = [("downloads", "text"), ("inventedByEs", "float"), ("name", "text")]
    checks, _ = _audit(spark, declared=declared, actual=actual)
    status, detail = checks["drift"]
    assert status == "warn"
    assert detail == ("type mismatch on downloads (declared long, actual text); declared but absent: neverIndexed; "
                      "present but never declared: inventedByEs")
    decl = spark.createDataFrame([("x", f, t) for f, t in declared], "code string, field string, type string")
    act = spark.createDataFrame([("x", f, t) for f, t in actual], "code string, field string, actual_type string")
    comp = {r["field"]: r["status"] for r in audit.field_comparison(decl, act).collect()}
    assert comp == {"downloads": "mismatch", "inventedByEs": "undeclared", "name": "ok", "neverIndexed": "missing"}


def test_field_limit(spark):
    checks, _ = _audit(spark, settings=[("index.mapping.total_fields.limit", "5")],
                       actual=[(f"f{i}", "long") for i in range(4)], declared=[(f"f{i}", "long") for i in range(4)])
    assert checks["fields"] == ("warn", "4 of 5 mapped fields used")


def test_field_intent_branches(spark):
    intents = spark.createDataFrame([
        ("x", "dropped_facet", True, False, False, False),
        ("x", "dropped_search", False, False, True, False),
        ("x", "dropped_sort", False, False, False, True),
        ("x", "unmapped", False, False, True, False),
        ("x", "text_facet", True, False, False, False),
        ("x", "kw_facet", False, True, False, False),
        ("x", "sort_by_key", False, False, False, True),
        ("x", "nothing_asked", False, False, False, False),
        ("x", "mapped_only", False, False, False, False),
    ], "code string, name string, facet boolean, filterable boolean, searchable boolean, sortable boolean")
    facets = spark.createDataFrame([("x", "text_facet", "text_facet"), ("x", "kw_facet", "kw_facet.keyword")],
                                   "code string, name string, target string")
    search = spark.createDataFrame([("x", "unmapped")], "code string, name string")
    sort = spark.createDataFrame([("x", "sort_by_key")], "code string, name string")
    actual = spark.createDataFrame([("x", "text_facet", "text", False), ("x", "kw_facet", "text", True),
                                    ("x", "mapped_only", "long", False), ("x", "sort_by_key", "keyword", False)],
                                   "code string, field string, actual_type string, has_keyword boolean")
    live = spark.createDataFrame([("x", "x", True)], "code string, index string, exists boolean")
    rows = {r["name"]: r for r in audit.field_intents(intents, facets, search, sort, actual, live).collect()}
    assert "nothing_asked" not in rows
    assert rows["dropped_facet"]["problem"].startswith("facet dropped")
    assert rows["dropped_search"]["problem"].startswith("searchable")
    assert rows["dropped_sort"]["problem"].startswith("sortable")
    assert rows["unmapped"]["problem"].startswith("used but not mapped")
    assert rows["text_facet"]["problem"] == "faceted on a text field"
    assert rows["kw_facet"]["problem"] is None and rows["kw_facet"]["actual_type"] == "text + .keyword"
    assert rows["sort_by_key"]["problem"] is None
    assert rows["mapped_only"]["problem"] is None and rows["mapped_only"]["aggregatable"]


def test_fleet_claims(spark):
    indexes = spark.createDataFrame([
        (1, "shop", "t", []), (2, "shop_2024", "t", ["shop_live", "shop"]), (3, ".hidden", "t", []),
        (4, "orphan", "t", ["nobody"])], IDX_SCHEMA)
    counts = spark.createDataFrame([("shop", 1), ("shop_2024", 2), (".hidden", 3), ("orphan", 4)],
                                   "index string, docs long")
    datasets = spark.createDataFrame([("shop", None, "t", "id", None, None, False)], DS_SCHEMA)
    rows = {r["index"]: r["claimed_by"] for r in audit.fleet_inventory(indexes, counts, datasets).collect()}
    assert rows == {"shop": "shop", "shop_2024": "shop", "orphan": None}
    resolved = {r["alias"]: r["index"] for r in audit.alias_resolution(indexes).collect()}
    assert resolved["shop"] == "shop_2024"
    miss = audit.pattern_misses(indexes, "zzz_*").collect()[0]
    assert (miss["matched"], miss["missed"]) == (0, 3)
    assert audit.pattern_misses(indexes, "*").collect()[0]["missed"] == 0


@pytest.mark.parametrize("hits,empty", [(None, 0), (0, 1), (5, 0)])
def test_call_summary_hits(spark, hits, empty):
    log = spark.createDataFrame([("r", "search", 1.25, hits, None), ("r", "bulk", 2.5, None, None)],
                                "request string, operation string, duration_ms double, hits long, error string")
    row = calls.summarize(log, ["request"]).collect()[0]
    assert row["calls"] == 2 and float(row["duration_ms"]) == 3.75 and row["errors"] == 0
    assert row["empty_searches"] == empty
    assert row["status"] == ("yellow" if empty else "none")


def test_call_errors_red_and_bulk_ops(spark):
    log = spark.createDataFrame([("r", "search", 1.0, 0, "boom")],
                                "request string, operation string, duration_ms double, hits long, error string")
    assert calls.summarize(log, ["request"]).collect()[0]["status"] == "red"
    from pyspark.sql import functions as F
    ops = spark.range(1).select(calls.bulk_op_count(F.lit(7), F.lit(3)).alias("n")).collect()[0]["n"]
    assert ops == 5  # 2 index actions (4 lines) + 3 deletes (3 lines)
