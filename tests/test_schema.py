"""Merged schemas of JSON documents against a plain walk (FLT-6)."""

import json

import pytest
from pyspark.sql import functions as F

from docforge.operators import schema, validate

DOCS = [
    '{"a": 1, "b": {"c": [1, 2.5, {"d": "2024-05-06"}]}, "e": null}', '{"a": 2.5, "b": {"c": []}, "f": "2024-02-30"}', '{"f": "2024-02-29", "g": true}',
    '{"g": 1, "h": "x", "b": {"c": [[{"d": "2024/05/06 10:11:12"}]]}}', '{"h": {"i": 1}}', '{"j": {}, "k": [null], "a": [1, 1]}', "{}",
    '{"h": "y"} trailing', "[1]", "17", "no json", "", None, '{"x.y": 1, "": 2}', '{"a": 1, "a ": "2024-01-01T10:00:00Z"}',
]


def _rows(frame):
    return {(r["path"], r["type"] if r["path"] is None else None): (r["type"], r["n_docs"], r["n_object"]) for r in frame.collect()}


def _docs(spark, docs):
    return spark.createDataFrame([(d, "kept") for d in docs], "doc string, path string")


def _walk(value, path, out):
    if isinstance(value, list):
        for v in value or [None]:
            _walk(v, path, out)
    else:
        out.add((path, value if isinstance(value, str) else type(value)))
        if isinstance(value, dict):
            for k, v in value.items():
                _walk(v, f"{path}.{k}" if path else k, out)


def test_counts_follow_a_plain_walk(spark):
    got = _rows(schema.merged_schema(_docs(spark, DOCS), "doc"))
    docs, objects = {}, {}
    for d in DOCS:
        try:
            parsed = json.loads(d or "")
        except ValueError:
            continue
        if isinstance(parsed, dict):
            found = set()
            for k, v in parsed.items():
                _walk(v, k, found)
            for path in {p for p, _ in found}:
                docs[path] = docs.get(path, 0) + 1
            for path in {p for p, k in found if k is dict}:
                objects[path] = objects.get(path, 0) + 1
    assert {p: v[1] for (p, _), v in got.items() if p is not None} == docs
    assert {p: v[2] for (p, _), v in got.items() if p is not None and v[2]} == objects
    assert got[(None, "malformed")][1] == 5  # trailing text, no object (two), no JSON, empty text; a null is neither


def test_types_widen(spark):
    got = {p: v[0] for (p, _), v in _rows(schema.merged_schema(_docs(spark, DOCS), "doc")).items()}
    assert got["a"] == "float" and got["b"] == "object" and got["b.c"] == "conflict" and got["b.c.d"] == "date"
    assert got["e"] == "null" and got["f"] == "text" and got["g"] == "text" and got["h"] == "conflict" and got["h.i"] == "long"
    assert got["j"] == "object" and got["k"] == "null" and got["x.y"] == "long" and got["a "] == "date"
    with pytest.raises(ValueError, match="b.c, h"):
        schema.mapping_of(schema.merged_schema(_docs(spark, DOCS), "doc"))
    clean = schema.mapping_of(schema.merged_schema(_docs(spark, DOCS[1:3]), "doc"))
    assert {k: (v.type, v.has_keyword) for k, v in clean.items()} == {
        "a": ("float", False), "b": (None, False), "f": ("text", True), "g": ("boolean", False)}


def test_loads_merge_without_their_documents(spark):
    parts = [schema.merged_schema(_docs(spark, DOCS[n::3]), "doc") for n in range(3)]
    assert _rows(schema.union_schemas(parts)) == _rows(schema.merged_schema(_docs(spark, DOCS), "doc"))


def test_deep_documents_are_counted(spark):
    deep = '{"o":' * 4 + "1" + "}" * 4
    got = _rows(schema.merged_schema(_docs(spark, [deep, '{"o": 1}']), "doc", depth=3))
    assert got[(None, "too_deep")][1] == 1 and got[("o.o.o", None)] == ("object", 1, 1) and got[("o", None)][0] == "conflict"
    assert _rows(schema.merged_schema(_docs(spark, [deep]), "doc"))[("o.o.o.o", None)] == ("long", 1, 0)
    assert schema.merged_schema(_docs(spark, []), "doc").count() == 0


def test_text_behind_a_document_makes_it_malformed(spark):
    rows = spark.createDataFrame([('{"k":1}}',), ('{"k":1} ',), ('{"k":1}{"k":2}',), (None,), ('{"k":1},"e":0',)], "doc string")
    assert [r[0] for r in rows.select(validate.variant(F.col("doc")).isNotNull()).collect()] == [False, True, False, False, False]


def test_kinds_are_read_once_a_value_and_levels_bounded_by_braces(spark):
    # an expression written several times inside a lambda is evaluated as often
    plan = schema.document_fields(_docs(spark, DOCS), "doc")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("schemaofvariant.") + plan.count("schema_of_variant(") <= 8  # 19 before
    odd = ['{"a":{}}', '{"s":"{{{{"}', '{"a":[{"b":{"c":[[]]}},{"b":1},null]}', "[]", "{}", "7", None, '{"n":1e400,"d":1.0,"":{"":"2024-01-01"}}']
    assert _rows(schema.merged_schema(_docs(spark, odd), "doc", depth=2)) == {
        ("a", None): ("object", 2, 2), ("s", None): ("text", 1, 0), ("a.b", None): ("conflict", 1, 1), ("", None): ("conflict", 1, 1),
        ("d", None): ("float", 1, 0), ("n", None): ("float", 1, 0), (None, "malformed"): ("malformed", 2, 0), (None, "too_deep"): ("too_deep", 1, 0)}
