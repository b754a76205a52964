"""Validation of documents against a declared mapping (FLT-4..6, SNK-3).

JSON documents are parsed once per row into a variant, which keeps every key and the
kind of every value: text that merely starts with a bracket is text. Rows that are
already columns are judged by the same rules from their types. A value is rejected when

* the document is not JSON, or not an object;
* a scalar field holds an object, or an array with one in it (arrays of scalars are
  values of the field, one by one);
* an object field holds a scalar;
* a value can't be read as the declared number, boolean or date;
* the mapping is strict and the document has a key it does not declare.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docforge.spec import FieldSpec

STRICT_ERROR = "strict_dynamic_mapping_exception"
SHAPE_ERROR = "illegal_argument_exception"
PARSE_ERROR = "document_parsing_exception"

# variant/JSON value kinds -> mapping type inferred by dynamic mapping.
INFERRED_TYPES = {"BIGINT": "long", "INT": "long", "SMALLINT": "long", "TINYINT": "long", "DECIMAL": "float",
                  "DOUBLE": "float", "FLOAT": "float", "STRING": "text", "BOOLEAN": "boolean",
                  "OBJECT": "object", "ARRAY": "array", "VOID": "null"}
# Spark types whose try_cast decides whether a text can be read as the mapping type.
CAST_OF = {"long": "double", "integer": "double", "float": "double", "double": "double", "boolean": "boolean", "date": "timestamp"}


def variant(doc: Column) -> Column:
    """The document parsed once; null if it is not JSON. The parser stops at the end of the first value, so what follows it is
    looked at apart: as the first of two members of an object, a document that ends early hides the second."""
    members = F.json_object_keys(F.concat(F.lit('{"d":'), doc, F.lit(',"e":0}')))
    return F.when(members == F.array(F.lit("d"), F.lit("e")), F.try_parse_json(doc))


def kind_of(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, ... of a variant; null where there is no value."""
    return F.regexp_extract(F.schema_of_variant(value), "^([A-Z]+)", 1)


def _path(name: str) -> str:
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def undeclared_keys(doc: Column, declared: list[str], doc_map: Column | None = None) -> Column:
    """Keys of a JSON document that the mapping does not declare, sorted."""
    keys = F.json_object_keys(doc) if doc_map is None else doc_map
    return F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in declared]).cast("array<string>")))


def _scalar_problem(name: str, spec: FieldSpec, kind: Column, text: Column) -> Column:
    """Problem of one scalar value (struct of type and reason), or null."""
    found = F.when(kind == "OBJECT", _problem(SHAPE_ERROR, f"Expected {spec.type} but found START_OBJECT"))
    target = CAST_OF.get(spec.type)
    if target is not None:
        unread = text.isNotNull() & text.try_cast(target).isNull()
        if spec.type == "date":  # epoch numbers are dates too
            unread = unread & text.try_cast("bigint").isNull()
        if spec.type in ("long", "integer", "float", "double"):
            unread = unread | text.try_cast("double").isin(float("inf"), float("-inf")) | F.isnan(text.try_cast("double"))
        found = found.when(unread, _problem(PARSE_ERROR, f"failed to parse field [{name}] of type [{spec.type}]"))
    return found


def _problem(kind: str, reason: str) -> Column:
    return F.struct(F.lit(kind).alias("reject_type"), F.lit(reason).alias("reason"))


def _object_problem(name: str) -> Column:
    return _problem(PARSE_ERROR, f"object mapping for [{name}] tried to parse field [{name}] as object, but found a concrete value")


def _value_problem(name: str, spec: FieldSpec, value: Column) -> Column:
    """Problem of a variant under the declared field, the first of an array's."""
    kind = kind_of(value)
    elements = F.when(kind == "ARRAY", F.try_variant_get(value, "$", "array<variant>")).otherwise(F.array(value))
    if spec.type in (None, "object"):
        bad = F.exists(elements, lambda e: F.coalesce(~kind_of(e).isin("OBJECT", "VOID"), F.lit(False)))
        return F.when(value.isNotNull() & bad, _object_problem(name))
    problems = F.transform(elements, lambda e: _scalar_problem(name, spec, kind_of(e), F.try_variant_get(e, "$", "string")))
    return F.when(value.isNotNull(), F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0)))


def _strict_problem(extra: Column) -> Column:
    reason = F.concat(F.lit("mapping set to strict, dynamic introduction of ["), F.array_join(extra, ","),
                      F.lit("] within [_doc] is not allowed"))
    return F.when(F.size(extra) > 0, F.struct(F.lit(STRICT_ERROR).alias("reject_type"), reason.alias("reason")))


def _with_problem(docs: DataFrame, problem: Column) -> DataFrame:
    return (docs.withColumn("__problem", problem)
            .withColumns({"reject_type": F.col("__problem.reject_type"), "reason": F.col("__problem.reason")}).drop("__problem"))


def classify(docs: DataFrame, doc_col: str, mapping: Mapping[str, FieldSpec], strict: bool = True) -> DataFrame:
    """Add ``reject_type`` and ``reason`` (both null for a valid document) to JSON documents.

    The document is parsed once per row into a hidden variant column, which all checks read.
    """
    parsed = docs.withColumn("__doc", variant(F.col(doc_col)))
    v = F.col("__doc")
    problems = [F.when(v.isNull() | (kind_of(v) != "OBJECT"), _problem(PARSE_ERROR, "failed to parse"))]
    problems += [_value_problem(n, s, F.try_variant_get(v, _path(n), "variant")) for n, s in mapping.items()]
    if strict:
        problems.append(_strict_problem(undeclared_keys(F.col(doc_col), list(mapping))))
    return _with_problem(parsed, F.coalesce(*problems)).drop("__doc")


def classify_rows(rows: DataFrame, mapping: Mapping[str, FieldSpec], strict: bool = True, id_col: str = "id",
                  ignore: tuple[str, ...] = ()) -> DataFrame:
    """Add ``reject_type`` and ``reason`` to documents that are already columns (those of ``ignore`` are no fields).

    Column types settle most of it at plan time; only texts declared as something else are looked at row by row.
    """
    problems: list[Column] = []
    for f in rows.schema.fields:
        if f.name in mapping:
            problems += _column_problem(f, mapping[f.name])
    extra = [f.name for f in rows.schema.fields if f.name not in mapping and f.name != id_col and f.name not in ignore]
    if strict and extra:
        present = F.array_compact(F.array(*[F.when(F.col(f"`{n}`").isNotNull(), F.lit(n)) for n in extra]))
        problems.append(_strict_problem(F.array_sort(present)))
    none = F.lit(None).cast("struct<reject_type:string,reason:string>")
    return _with_problem(rows, F.coalesce(none, *problems))


def _column_problem(f: T.StructField, spec: FieldSpec) -> list[Column]:
    col, kind = F.col(f"`{f.name}`"), f.dataType
    depth_in = kind
    while isinstance(depth_in, T.ArrayType):
        depth_in = depth_in.elementType
    nested = isinstance(depth_in, (T.StructType, T.MapType))
    if spec.type in (None, "object"):
        return [] if nested else [F.when(col.isNotNull(), _object_problem(f.name))]
    if nested:
        shape = _problem(SHAPE_ERROR, f"Expected {spec.type} but found START_OBJECT")
        return [F.when(F.size(col) > 0 if isinstance(kind, T.ArrayType) else col.isNotNull(), shape)]
    if spec.type not in CAST_OF or not isinstance(depth_in, T.StringType):
        return []
    elements = col if isinstance(kind, T.ArrayType) else F.array(col)
    while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        elements, kind = F.flatten(elements), kind.elementType
    bad = F.filter(F.transform(elements, lambda e: _scalar_problem(f.name, spec, F.lit("STRING"), e)), lambda p: p.isNotNull())
    return [F.when(col.isNotNull(), F.get(bad, F.lit(0)))]


def split_valid(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = classified.where(F.col("reject_type").isNull()).drop("reject_type", "reason")
    rejected = classified.where(F.col("reject_type").isNotNull())
    return valid, rejected


def assert_no_rejects(rejected: DataFrame, id_col: str = "id") -> None:
    """SNK-3: fail before publish, naming the first rejected id and its reason."""
    first = rejected.select(id_col, "reject_type", "reason").limit(1).collect()
    if first:
        row = first[0]
        raise RuntimeError(f'rejected document "{row[0]}": {{"type": "{row[1]}", "reason": "{row[2]}"}}')


def inferred_fields(docs: DataFrame, doc_col: str) -> DataFrame:
    """FLT-6: dynamic mapping inference -- per top-level key, the inferred
    type and how many documents carry it, from a variant scan of every doc
    (``variant_explode`` as a lateral join; one partially aggregated group-by). Documents that are no JSON have no
    fields; ``malformed_documents`` counts them."""
    spark = docs.sparkSession
    pairs = docs.select(F.col(doc_col).alias("doc")).lateralJoin(
        spark.tvf.variant_explode(variant(F.col("doc").outer())))
    kinds = pairs.select(F.col("key").alias("field"), kind_of(F.col("value")).alias("kind"))
    mapping = F.create_map(*[x for k, v in INFERRED_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return (kinds.withColumn("inferred_type", F.coalesce(mapping[F.col("kind")], F.lower("kind")))
            .groupBy("field", "inferred_type").agg(F.count("*").alias("n_docs")))


def malformed_documents(docs: DataFrame, doc_col: str) -> DataFrame:
    """``malformed``: documents that are not JSON, or not an object."""
    doc = variant(F.col(doc_col))
    bad = F.col(doc_col).isNotNull() & (doc.isNull() | (kind_of(doc) != "OBJECT"))
    return docs.select(bad.alias("bad")).agg(F.count_if("bad").alias("malformed"))


def evolved_mapping(inferred: DataFrame, mapping: Mapping[str, FieldSpec]) -> dict[str, FieldSpec]:
    """FLT-6: the mapping a non-strict index has after these documents: declared fields as they are, and each new
    field with the type inferred for it (of several kinds: text before float before long, as the wider one holds
    all; nulls alone add nothing). ``inferred`` has one row a field and kind."""
    width = {"long": 1, "boolean": 1, "float": 2, "text": 3, "object": 4}
    out = dict(mapping)
    for r in inferred.where(F.col("inferred_type") != "null").orderBy("field", "inferred_type").collect():  # schema-sized
        name, kind = r["field"], "object" if r["inferred_type"] == "object" else r["inferred_type"]
        if name in mapping or kind == "array":
            continue
        if name not in out or width[kind] > width[out[name].type]:
            both = name in out and "boolean" in (kind, out[name].type) and kind != out[name].type
            out[name] = FieldSpec("text" if both else kind, has_keyword=(both or kind == "text"))
    return out


def id_problems(docs: DataFrame, doc_col: str, id_key: str) -> DataFrame:
    """PRJ-6 as data: rows whose id (a key of the document) is null, missing or not scalar."""
    kind = kind_of(F.try_variant_get(variant(F.col(doc_col)), _path(id_key), "variant"))
    status = (F.when(kind.isNull() | (kind == "VOID"), F.lit("null")).when(kind.isin("OBJECT", "ARRAY"), F.lit("non_scalar")))
    return docs.withColumn("id_status", status).where(F.col("id_status").isNotNull())
