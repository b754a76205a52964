"""Check queries over a document table (2.13): match, term facets, stats facets.

Match is a semi join of the analysed query terms against the token table;
the query side is a handful of strings (bounded by the request, not the
data), so it is broadcast explicitly and the token table is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.functions.text import analyze_tokens
from docforge.sources.tables import small_frame
from docforge.spec import AnalyzerSpec


def query_terms(spark: SparkSession, queries: Sequence[str], analyzer: AnalyzerSpec) -> DataFrame:
    """Analyse query strings with the index's analyzer -> ``(query, term)``."""
    q = small_frame(spark, [(s,) for s in queries], "query string")
    return (analyze_tokens(q.withColumn("__text", F.col("query")), ["query"], "__text", analyzer)
            .select("query", F.col("token").alias("term")).distinct())


def match(tokens: DataFrame, terms: DataFrame, id_col: str = "id") -> DataFrame:
    """QRY-1: documents holding any analysed query term -> ``(query, id)``."""
    hits = tokens.select(id_col, F.col("token").alias("term")).join(F.broadcast(terms), "term")
    return hits.select("query", id_col).distinct()


def facet_terms(docs: DataFrame, fields: Sequence[str], id_col: str = "id") -> DataFrame:
    """QRY-2: document count per value of each keyword field, in ONE scan:
    every row contributes one ``(field, value)`` entry per field (arrays are
    exploded), then a single map-side-combined group-by."""
    entries = []
    for f in fields:
        col = F.col(f"`{f}`")
        dtype = dict(docs.dtypes)[f]
        values = col if dtype.startswith("array") else F.array(col)
        entries.append(F.transform(F.array_distinct(values), _facet_entry(f)))
    exploded = docs.select(id_col, F.explode(F.concat(*entries)).alias("e")).where(F.col("e.value").isNotNull())
    return exploded.groupBy(F.col("e.field").alias("field"), F.col("e.value").alias("value")) \
        .agg(F.count("*").alias("doc_count"))


def _facet_entry(name: str):
    return lambda v: F.struct(F.lit(name).alias("field"), v.cast("string").alias("value"))


def facet_stats(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """QRY-3: min / max / count of numeric fields in one aggregate pass."""
    aggs = []
    for f in fields:
        c = F.col(f"`{f}`").cast("double")
        aggs += [F.min(c).alias(f"{f}__min"), F.max(c).alias(f"{f}__max"), F.count(c).alias(f"{f}__n")]
    row = docs.agg(*aggs)
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"{f}__min").alias("min_value"), F.col(f"{f}__max").alias("max_value"),
                 F.col(f"{f}__n").alias("doc_count")) for f in fields])).alias("s")).select("s.*")
