"""The manifest of a store: counts, limits, and reads that don't grow with the number of tables (SRC-6, SNK-4, RPT-8)."""

import pytest
from pyspark.sql import functions as F

from docforge.operators.store import DocumentStore
from docforge.spec import FieldSpec


@pytest.fixture
def store(spark, tmp_path):
    s = DocumentStore(spark, database=f"m_{tmp_path.name.replace('-', '_')}", root=str(tmp_path))
    yield s
    s.drop_database()


def _docs(spark, ids):
    return spark.createDataFrame([(str(i), f"t{i}") for i in ids], "id string, title string")


def _counts(store):
    return {r["index"]: r["docs"] for r in store.indexes().collect()}


def test_counts_equal_what_the_aliases_hold(spark, store):
    one, two = store.rebuild("one", _docs(spark, range(10))), store.rebuild("two", _docs(spark, range(4)))
    assert _counts(store) == {one: 10, two: 4}
    changes = lambda ids, seq: _docs(spark, ids).withColumn("_seq", F.lit(seq))
    store.apply_changes("one", changes([8, 9, 10, 11], 5), None)
    store.apply_changes("one", None, changes([0, 10, 77], 6).select("id", "_seq"))  # 77 was never there
    store.apply_changes("two", None, changes(range(4), 6).select("id", "_seq"))
    store.apply_changes("two", changes([2], 7), changes([2], 7).select("id", "_seq"))  # a delete wins
    assert _counts(store) == {one: store.read("one").count(), two: 0} == {one: 10, two: 0}
    left = store.create_generation("one", _docs(spark, []).schema)
    assert store.fill(left, _docs(spark, range(3))) == 3
    folded = store.compact("one")
    assert _counts(store) == {folded: 10, two: 0, left: 3}
    store.delete("one")
    assert _counts(store) == {two: 0} and [r["index"] for r in store.manifest.tables().collect()] == [two]


def test_limits_are_kept_and_enforced(spark, store):
    mapping = {"title": FieldSpec("text", True)}
    limits = {"index.max_result_window": 500, "index.mapping.total_fields.limit": 2}
    first = store.rebuild("one", _docs(spark, range(2)), mapping, settings=limits)
    kept = {r["key"]: r["value"] for r in store.settings().collect()}
    assert kept == {"index.mapping.dynamic": "strict", "index.max_result_window": "500", "index.mapping.total_fields.limit": "2"}
    store.apply_changes("one", _docs(spark, [7]).withColumn("_seq", F.lit(5)), None)
    second = store.compact("one")
    assert second != first and store.declared_settings(second) == {k: str(v) for k, v in limits.items()}
    with pytest.raises(ValueError, match="3 fields"):
        store.rebuild("one", _docs(spark, range(2)), mapping | {"more": FieldSpec("long")}, settings=limits)
    assert store.live_generation("one") == second


def test_catalog_asks_no_table_for_its_properties(spark, store, monkeypatch):
    for n in range(3):
        store.rebuild(f"a{n}", _docs(spark, range(n)))
    store.publish("other", store.live_generation("a2"))
    spark.sql(f"CREATE TABLE {store.qualified('plain')} USING parquet LOCATION '{store.root}/plain' AS SELECT '1' AS id")
    asked = []
    monkeypatch.setattr(store, "properties", lambda name: asked.append(name))
    entries = {e["index"]: e for e in store.catalog()}
    assert not asked and len(entries) == 4
    assert entries[store.live_generation("a2")]["aliases"] == ["a2", "other"] and entries["plain"]["filled"] is None
    assert _counts(store)["plain"] == 1
    store.adopt("plain")
    assert {e["index"]: e["filled"] for e in store.catalog()}["plain"] == 1
    spark.sql(f"DROP TABLE {store.qualified('plain')}")
