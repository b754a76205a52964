"""Spec-driven analysis of document fields (TXT-6, TXT-7).

Only ``text`` fields are analysed; ``keyword``/numeric/date fields and the
``.keyword`` subfield of a text field are indexed as their exact value. The
output is the term table ``(id, field, position, term)`` built from ONE scan
of the documents: every field contributes an array of entries, the arrays
are concatenated and exploded once (no per-field union, no shuffle).
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions.text import check_language, stem_column, token_array
from docforge.session import spread
from docforge.spec import AnalyzerSpec, FieldSpec

_ENTRY = "struct<field:string,position:bigint,term:string,analyzed:boolean>"


def _exact(name: str, col: Column) -> Column:
    entry = F.struct(F.lit(name).alias("field"), F.lit(0).cast("bigint").alias("position"),
                     col.cast("string").alias("term"), F.lit(False).alias("analyzed"))
    return F.when(col.isNotNull(), F.array(entry)).otherwise(F.array().cast(f"array<{_ENTRY}>"))


def _analysed(name: str, col: Column, analyzer: AnalyzerSpec) -> Column:
    toks = F.coalesce(token_array(col, analyzer), F.array().cast("array<string>"))
    return F.transform(toks, lambda t, i: F.struct(
        F.lit(name).alias("field"), i.cast("bigint").alias("position"), t.alias("term"),
        F.lit(analyzer.configured).alias("analyzed")))


def analyzed_fields(docs: DataFrame, id_col: str, mapping: Mapping[str, FieldSpec],
                    analyzer: AnalyzerSpec) -> DataFrame:
    check_language(analyzer)
    entries = []
    for name, spec in mapping.items():
        if name not in docs.columns or spec.type in (None, "object"):
            continue
        col = F.col(f"`{name}`")
        if spec.type == "text":
            entries.append(_analysed(name, col, analyzer))
            if spec.has_keyword:
                entries.append(_exact(f"{name}.keyword", col))
        else:
            entries.append(_exact(name, col))
    if not entries:
        raise ValueError("no indexable field in the mapping")
    wanted = [id_col, *[n for n in mapping if n in docs.columns]]
    docs = spread(docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys(wanted)]))
    exploded = docs.select(F.col(id_col).alias("id"), F.explode(F.concat(*entries)).alias("e"))
    terms = exploded.select("id", "e.field", "e.position", "e.term", "e.analyzed")
    if analyzer.configured:
        terms = stem_column(terms, "term", only_if="analyzed", language=analyzer.language)
    return terms.drop("analyzed")


def _dealt_by_word(batches):
    """One row a distinct word of a batch of documents, with every place it has there."""
    for batch in batches:
        ids, words = batch.column(0), batch.column(1)
        places = np.asarray(words.offsets).astype("int64")
        lengths = np.diff(places)
        coded = words.flatten().dictionary_encode()
        codes = np.asarray(coded.indices)
        if not len(codes):
            continue
        order = np.argsort(codes, kind="stable")
        document = np.repeat(np.arange(len(lengths)), lengths)[order]
        position = (np.arange(len(codes)) - np.repeat(places[:-1] - places[0], lengths))[order]
        ends = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))])
        postings = pa.StructArray.from_arrays([ids.take(pa.array(document)), pa.array(position, pa.int64())], ["id", "position"])
        yield pa.RecordBatch.from_arrays([coded.dictionary, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), postings)], ["term", "postings"])


def field_postings(docs: DataFrame, id_col: str, mapping: Mapping[str, FieldSpec], analyzer: AnalyzerSpec) -> dict[str, DataFrame]:
    """The rows of :func:`analyzed_fields` field by field, as the term index is written: those of exact values one by one, those of an
    analysed field as ``(term, postings)``, a row a word of each batch of documents. A word is then stemmed, and put in its place in the
    index, once a batch and not once an occurrence. Nothing is shuffled."""
    check_language(analyzer)
    key, frames = F.col(f"`{id_col}`").alias("id"), {}
    kind = docs.schema[id_col].dataType.simpleString()
    for name, spec in mapping.items():
        if name not in docs.columns or spec.type in (None, "object"):
            continue
        col = F.col(f"`{name}`")
        exact = docs.where(col.isNotNull()).select(key, F.lit(0).cast("bigint").alias("position"), col.cast("string").alias("term"))
        if spec.type != "text":
            frames[name] = exact
            continue
        if spec.has_keyword:
            frames[f"{name}.keyword"] = exact
        texts = spread(docs.where(col.isNotNull()).select(key, col.alias("text")))
        words = texts.select("id", token_array(F.col("text"), analyzer).alias("words"))
        terms = words.mapInArrow(_dealt_by_word, f"term string, postings array<struct<id:{kind},position:bigint>>")
        frames[name] = stem_column(terms, "term", language=analyzer.language) if analyzer.configured else terms
    if not frames:
        raise ValueError("no indexable field in the mapping")
    return frames


def write_term_index(terms: DataFrame | Mapping[str, DataFrame], path: str) -> None:
    """Persist the term table ``(id, field, position, term)`` for lookups.

    Layout: one folder per field (partition pruning on ``field``) and every
    file sorted on ``(term, id)``, or on ``term`` where the rows come as postings
    (``field_postings``), so Parquet row-group min/max statistics
    let a term lookup skip almost every row group. The sort is local to each
    task: no shuffle of the term table (the largest table in the system) and
    no sampling pass over it, and a very frequent term simply spans row
    groups in many files instead of landing in one task. Postings are sorted
    before they are opened: far fewer rows, compared by their term alone.
    """
    if isinstance(terms, DataFrame):
        terms.sortWithinPartitions("field", "term", "id").write.mode("errorifexists").partitionBy("field").parquet(path)
        return
    for field, rows in terms.items():
        if "postings" in rows.columns:
            rows = rows.sortWithinPartitions("term").select(F.inline("postings"), "term")
        else:
            rows = rows.sortWithinPartitions("term", "id")
        escaped = rows.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(field)
        rows.write.mode("errorifexists").parquet(f"{path}/field={escaped}")


def lookup_terms(spark, path: str, field: str, terms: list[str]) -> DataFrame:
    """Read the postings of a few terms: the filters reach the Parquet scan
    (``PartitionFilters`` on field, ``PushedFilters`` on term)."""
    return spark.read.parquet(path).where((F.col("field") == field) & F.col("term").isin(terms))
