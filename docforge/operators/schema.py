"""The mapping that a set of JSON documents amounts to, nested fields included (FLT-6).

Every document is opened level by level inside one projection: the objects and arrays of a level give the values of the next, a
field of an object in an array has the array's path. A document then has its distinct (path, kind) pairs, and one
aggregate, combined in each task, merges the kinds of a path over all documents:

* whole and fractional numbers: ``float``, whole ones alone ``long``;
* texts that are dates throughout (ISO date, or year/month/day, with or without time; a day that exists): ``date``, else ``text``;
* scalars of several families (number and text, boolean and date, ...): ``text``, which holds them all;
* objects alone: ``object``;
* objects here and scalars there: no type holds both. The type is ``conflict``, and ``n_object`` of ``n_docs`` says how the documents split;
* nulls and empty arrays alone: ``null`` (no field yet).

Rows with a null path count documents: ``malformed`` (no JSON, or no object) and ``too_deep`` (values below ``depth`` levels, the
depth limit of an index; they are counted, not merged). A null document is neither.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.operators.validate import variant
from docforge.spec import FieldSpec

#: Fixed value: levels of objects an index takes unless it declares another limit.
DEPTH = 20
# The texts that dynamic mapping reads as dates.
DATE_PATTERN = (r"^[0-9]{4}(-[0-9]{2}-[0-9]{2}(T[0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,9})?)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?"
                r"|/[0-9]{2}/[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2})?( ?(Z|[+-][0-9]{2}:?[0-9]{2}))?)$")
# Variant kinds -> families of mapping types.
FAMILIES = {"BIGINT": "long", "INT": "long", "SMALLINT": "long", "TINYINT": "long", "DECIMAL": "float", "DOUBLE": "float",
            "FLOAT": "float", "STRING": "text", "BOOLEAN": "boolean", "OBJECT": "object", "VOID": "null"}
_ENTRY = "array<struct<path:string,value:variant,kind:string>>"


def is_date(text: Column) -> Column:
    """A text that is a date by its form, on a day that exists."""
    day = F.translate(F.substring(text, 1, 10), "/", "-")
    return text.rlike(DATE_PATTERN) & day.try_cast("date").isNotNull()


def _members(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _kind(value: Column) -> Column:
    """``kind_of`` for values of JSON: objects and arrays are known by what can be had from them, which is far less work than their whole schema."""
    scalar = F.substring_index(F.schema_of_variant(value), "(", 1)
    return F.when(_members(value).isNotNull(), "OBJECT").when(F.try_variant_get(value, "$", "array<variant>").isNotNull(), "ARRAY").otherwise(scalar)


def _family(entry: Column) -> Column:
    named = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])
    text = F.when(is_date(F.try_variant_get(entry["value"], "$", "string")), "date").otherwise("text")
    return F.when(entry["kind"] == "STRING", text).otherwise(F.coalesce(named[entry["kind"]], F.lower(entry["kind"])))


def _entry(path: Column, value: Column) -> Column:
    """A value with its path and kind. The kind is read off the value here, once, for all that ask for it: expressions inside a lambda
    are evaluated as often as they are written."""
    return F.struct(path.alias("path"), value.alias("value"), _kind(value).alias("kind"))


def _fields(prefix: Column, value: Column) -> Column:
    """The fields of an object, each with its path."""
    entries = F.map_entries(_members(value))
    return F.transform(entries, lambda e: _entry(F.when(prefix == "", e["key"]).otherwise(F.concat(prefix, F.lit("."), e["key"])), e["value"]))


def _elements(entry: Column) -> Column:
    """The entry itself, or for an array one entry an element (a null for an empty one)."""
    null = F.parse_json(F.lit("null"))
    inner = F.try_variant_get(entry["value"], "$", "array<variant>")
    filled = F.when(F.size(inner) == 0, F.array(null)).otherwise(F.transform(inner, lambda v: F.coalesce(v, null)))
    return F.when(entry["kind"] == "ARRAY", F.transform(filled, lambda v: _entry(entry["path"], v))).otherwise(F.array(entry))


def _opened(entries: Column) -> Column:
    """Arrays replaced by their elements, twice, so that arrays of arrays are opened too."""
    return F.flatten(F.transform(F.flatten(F.transform(entries, _elements)), _elements))


def _below(entries: Column) -> Column:
    return F.flatten(F.transform(F.filter(entries, lambda e: e["kind"] == "OBJECT"), lambda e: _fields(e["path"], e["value"])))


def document_fields(docs: DataFrame, doc_col: str, depth: int = DEPTH) -> DataFrame:
    """One row a document, path and family of values found there: ``path``, ``family``, ``first`` (the path's first row of this document).
    A malformed or too deep document has a row with a null path besides. No shuffle."""
    doc = F.col(doc_col)
    # a document has no more levels than opening braces
    levels = F.least(F.lit(depth), F.greatest(F.lit(1), F.length(doc) - F.length(F.replace(doc, F.lit("{"), F.lit("")))))
    rows = docs.select(variant(doc).alias("__doc"), doc.isNotNull().alias("__given"), levels.alias("__levels"))
    rows = rows.withColumn("__ok", _members(F.col("__doc")).isNotNull())
    # one fold over the levels, so that the plan has one size whatever the depth; the state holds a level's values and the pairs found above
    start = F.struct(F.when(F.col("__ok"), _opened(_fields(F.lit(""), F.col("__doc")))).otherwise(F.array().cast(_ENTRY)).alias("level"),
                     F.array().cast("array<struct<path:string,family:string>>").alias("found"))
    rows = rows.withColumn("__end", F.aggregate(F.sequence(F.lit(1), F.col("__levels")), start, lambda state, _: F.struct(
        _opened(_below(state["level"])).alias("level"),
        F.concat(state["found"], F.transform(state["level"], lambda e: F.struct(e["path"].alias("path"), _family(e).alias("family"))))
        .alias("found"))))
    pairs = F.col("__end.found")
    beyond = F.array(F.when(F.col("__given") & ~F.col("__ok"), F.lit("malformed")), F.when(F.size("__end.level") > 0, F.lit("too_deep")))
    counts = F.transform(F.array_compact(beyond), lambda b: F.struct(F.lit(None).cast("string").alias("path"), b.alias("family")))
    rows = rows.select(F.sort_array(F.array_distinct(pairs)).alias("__pairs"), counts.alias("__counts"))
    first = F.transform(F.col("__pairs"), lambda p, i: F.struct(
        p["path"].alias("path"), p["family"].alias("family"),
        ((i == 0) | (F.get(F.col("__pairs"), i - 1)["path"] != p["path"])).alias("first")))
    counted = F.transform(F.col("__counts"), lambda p: F.struct(p["path"].alias("path"), p["family"].alias("family"), F.lit(True).alias("first")))
    return rows.select(F.inline(F.concat(first, counted)))


def merged_type(has: dict[str, Column]) -> Column:
    """The type that holds all families a path was found with."""
    number = has["long"] | has["float"]
    several = number.cast("int") + has["boolean"].cast("int") + has["date"].cast("int") + has["text"].cast("int")
    scalar = several > 0
    return (F.when(has["object"] & scalar, "conflict").when(has["object"], "object").when(has["array"], "array")
            .when(has["text"] | (several > 1), "text").when(has["date"], "date").when(has["boolean"], "boolean")
            .when(has["float"], "float").when(has["long"], "long").otherwise("null"))


def merged_schema(docs: DataFrame, doc_col: str, depth: int = DEPTH) -> DataFrame:
    """``path``, ``type``, ``n_docs`` (documents with a value or null there), ``n_object`` (documents with an object there); one row a path,
    and one for each kind of document that could not be merged (null path). One scan, one partially aggregated group-by."""
    found = document_fields(docs, doc_col, depth)
    key = F.when(F.col("path").isNull(), F.col("family")).alias("unmerged")
    families = sorted(set(FAMILIES.values()) | {"date", "array"})
    merged = found.groupBy("path", key).agg(
        F.count_if("first").alias("n_docs"), F.count_if(F.col("family") == "object").alias("n_object"),
        *[F.bool_or(F.col("family") == f).alias(f"has_{f}") for f in families])
    kind = F.coalesce(F.col("unmerged"), merged_type({f: F.col(f"has_{f}") for f in families}))
    return merged.select("path", kind.alias("type"), "n_docs", "n_object")


def mapping_of(merged: DataFrame) -> dict[str, FieldSpec]:
    """The mapping to declare for these documents; a path without one type is an error, as is an array nested too deep to open."""
    out, odd = {}, []
    for r in merged.where("path IS NOT NULL AND type <> 'null'").orderBy("path").collect():  # schema-sized
        if r["type"] in ("conflict", "array"):
            odd.append(r["path"])
        else:
            out[r["path"]] = FieldSpec(None if r["type"] == "object" else r["type"], r["type"] == "text")
    if odd:
        raise ValueError(f"no one type holds what was found at {', '.join(odd)}")
    return out


def union_schemas(parts: list[DataFrame]) -> DataFrame:
    """Merged schemas of several loads as one (types widen as values do), so that a new load does not read the old ones again."""
    rows = reduce(DataFrame.unionByName, parts)
    families = sorted(set(FAMILIES.values()) | {"date", "array"})
    unmerged = F.when(F.col("path").isNull(), F.col("type"))
    held = {f: F.col("type") == f for f in families}
    held["object"] = F.col("type").isin("object", "conflict")
    held["text"] = F.col("type").isin("text", "conflict")
    merged = rows.groupBy("path", unmerged.alias("unmerged")).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_object").alias("n_object"), *[F.bool_or(c).alias(f"has_{f}") for f, c in held.items()])
    kind = F.coalesce(F.col("unmerged"), merged_type({f: F.col(f"has_{f}") for f in families}))
    return merged.select("path", kind.alias("type"), "n_docs", "n_object")
