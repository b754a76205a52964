"""Document build (SRC-1/2, PRJ-1..7, LIM-1).

``build_documents`` turns a source DataFrame into the document table
``(id STRING NOT NULL, <fields>...)`` as one lazy plan: resolve the source,
project (or map), normalise, resolve the id. No row is pulled to the driver;
the scan reads only the projected columns plus the id.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docforge.functions.normalize import normalize_columns
from docforge.sources.provider import resolve_source
from docforge.spec import DatasetSpec

ID = "id"
_QUALIFIER = re.compile(r"^[a-z]+\.")


def strip_qualifier(name: str) -> str:
    """PRJ-2: drop one leading lower-case ``alias.`` (``e.title`` -> ``title``)."""
    return _QUALIFIER.sub("", name, count=1)


def field_names(fields) -> list[str]:
    """Stripped names in first-seen order; duplicates after stripping collapse."""
    seen: dict[str, None] = {}
    for f in fields:
        seen.setdefault(strip_qualifier(f), None)
    return list(seen)


def read_value(df: DataFrame, name: str) -> Column:
    """PRJ-3: the column if the source has it, else a typed null (never an error)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def checked_id(col: Column, id_field: str) -> Column:
    """PRJ-6: ids are strings and never null; a null id fails the job."""
    as_text = col.cast("string")
    message = f"Unable to resolve scalar id field \"{id_field}\"."
    return F.coalesce(F.assert_true(as_text.isNotNull(), F.lit(message)).cast("string"), as_text)


def build_documents(spark: SparkSession, spec: DatasetSpec, sf_dir: str | None = None,
                    limit: int | None = None, check_ids: bool = True) -> DataFrame:
    source = resolve_source(spark, spec, sf_dir)
    of_source, of_body = "__source_id", "__body_id"
    from_source = read_value(source, spec.id_field)
    if spec.mapper is not None:
        # the source's id rides past the mapper as a hidden column, where the mapper keeps it
        mapped = spec.mapper(source.withColumn(of_source, from_source))
        if not isinstance(mapped, DataFrame):
            raise TypeError("documentMapper must return a DataFrame")
        if spec.id_field not in mapped.columns and of_source not in mapped.columns:
            # a mapper that selects its own columns: give it the id's column to keep by name
            raise LookupError(f"Unable to resolve scalar id field \"{spec.id_field}\": the mapper returns neither it nor \"{of_source}\".")
        body = mapped if of_source in mapped.columns else mapped.withColumn(of_source, F.lit(None).cast("string"))
    else:
        names = field_names(spec.projected_fields())
        cols = [read_value(source, n).alias(n) for n in names]
        body = source.select(*cols, from_source.alias(of_source))
    # the document's own id field wins over the source's (PRJ-6)
    body = body.withColumn(of_body, read_value(body, spec.id_field))
    for name in (of_body, of_source):
        kind = body.schema[name].dataType
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            raise TypeError(f"Unable to resolve scalar id field \"{spec.id_field}\": type {kind.simpleString()}")
    body = normalize_columns(body, exclude=(of_body, of_source))
    if ID in body.columns and spec.id_field != ID:
        raise ValueError(f"the document has a field \"{ID}\" beside its id field \"{spec.id_field}\"; "
                         f"rename it in the mapper: the column \"{ID}\" holds the document id")
    id_col = F.coalesce(F.col(of_body).cast("string"), F.col(of_source).cast("string"))
    id_expr = checked_id(id_col, spec.id_field) if check_ids else id_col
    docs = body.select(id_expr.alias(ID), *[F.col(f"`{c}`") for c in body.columns if c not in (of_body, of_source, ID)])
    return apply_limit(docs, limit)


def apply_limit(docs: DataFrame, limit: int | None) -> DataFrame:
    """LIM-1: ``None`` or ``0`` = all rows; otherwise the first ``n`` by id.

    Ordered by id so the result is deterministic; Spark plans it as a
    ``TakeOrderedAndProject`` (per-partition top-n, no full sort).
    """
    if not limit:
        return docs
    return docs.orderBy(ID).limit(int(limit))


def delete_actions(ids: DataFrame, index: str) -> DataFrame:
    """PRJ-7: ``id`` -> ``(action='delete', index, id)``."""
    return ids.select(F.lit("delete").alias("action"), F.lit(index).alias("index"), F.col(ID),
                      *[c for c in ids.columns if c != ID])
