"""Fleet fixture for the audit queries.

Configuration (which datasets exist, their declared mappings, analyzer
settings, the physical indexes and their aliases) is metadata: small,
bounded by configuration, stated here once and rendered both as Spark
DataFrames and as SQL ``VALUES`` for the DuckDB twin. Everything measured --
document counts, fields present, observed types -- is computed by scanning
the source tables, so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.sources.tables import read_table, small_frame

# Datasets (code, entity class, source table, id field,
# configured language, dynamic mapping, provider configured).
DATASETS = [
    ("customer", "App\\Entity\\Customer", "customer", "c_custkey", "english", "strict", False),
    ("part", "App\\Entity\\Part", "part", "p_partkey", "english", "strict", False),
    ("orders", "App\\Entity\\Order", "orders", "o_orderkey", None, "true", False),
    ("documents", "App\\Entity\\Document", "documents", "doc_id", "hungarian", "false", True),
    ("supplier", "App\\Entity\\Supplier", "supplier", "s_suppkey", None, "strict", False),
]

# Projected source fields per dataset.
SOURCE_FIELDS = {
    "customer": ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_phone"],
    "part": ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "o_custkey"],
    "documents": ["text", "lang", "source", "n_chars"],
    "supplier": ["s_name", "s_acctbal"],
}

# Projected fields the source table does not have (read as null).
ABSENT_FIELDS = {("customer", "c_phone")}

# Declared mapping (code, field, type, has_keyword).
DECLARED = [
    ("customer", "c_name", "text", True), ("customer", "c_nationkey", "long", False),
    ("customer", "c_acctbal", "float", False), ("customer", "c_mktsegment", "keyword", False),
    ("customer", "c_phone", "keyword", False),
    ("part", "p_name", "text", True), ("part", "p_brand", "keyword", False), ("part", "p_type", "keyword", False),
    ("part", "p_size", "long", False), ("part", "p_retailprice", "long", False),
    ("orders", "o_orderstatus", "keyword", False), ("orders", "o_totalprice", "float", False),
    ("orders", "o_orderdate", "date", False), ("orders", "o_orderpriority", "keyword", False),
    ("documents", "text", "text", False), ("documents", "lang", "keyword", False),
    ("documents", "source", "keyword", False), ("documents", "n_chars", "long", False),
    ("supplier", "s_name", "text", True), ("supplier", "s_acctbal", "float", False),
]

# Physical indexes (position, index, source table, aliases).
INDEXES = [
    (1, "customer_20240101000000", "customer", ["customer"]),
    (2, "part_20240101000000", "part", ["part", "catalog"]),
    (3, "orders", "orders", []),
    (4, "documents_20231201000000", "documents", []),
    (5, "documents_20240101000000", "documents", ["documents", "docs_all"]),
    (6, "legacy_products", "part", ["catalog"]),
    (7, ".tasks", "events", []),
]

# Flat index settings (index, key, value).
SETTINGS = [
    ("customer_20240101000000", "index.number_of_shards", "1"),
    ("customer_20240101000000", "index.analysis.analyzer.docforge_text.tokenizer", "standard"),
    ("customer_20240101000000", "index.analysis.filter.docforge_stemmer.language", "english"),
    ("part_20240101000000", "index.number_of_shards", "1"),
    ("orders", "index.number_of_shards", "1"),
    ("orders", "index.max_result_window", "20000"),
    ("documents_20240101000000", "index.analysis.analyzer.docforge_text.tokenizer", "standard"),
    ("documents_20240101000000", "index.analysis.filter.docforge_stemmer.language", "english"),
    ("documents_20240101000000", "index.mapping.total_fields.limit", "5"),
]

# Field intents (code, name, facet, filterable, searchable, sortable).
INTENTS = [
    ("part", "p_brand", True, False, False, False), ("part", "p_type", False, True, False, False),
    ("part", "p_name", True, False, True, True), ("part", "p_size", False, False, False, True),
    ("part", "p_color", True, False, False, False), ("part", "p_retailprice", False, False, False, False),
    ("part", "p_comment", False, False, False, False),
    ("customer", "c_name", False, False, True, False), ("customer", "c_phone", False, False, True, False),
    ("customer", "c_mktsegment", True, False, False, False),
    ("supplier", "s_name", False, False, True, False),
]
# Resolved adapter parameters per dataset.
FACET_FIELDS = [("part", "p_brand", "p_brand"), ("part", "p_type", "p_type"), ("part", "p_name", "p_name"),
                ("customer", "c_mktsegment", "c_mktsegment"), ("customer", "c_name", "c_name.keyword")]
SEARCH_FIELDS = [("part", "p_name"), ("customer", "c_name"), ("supplier", "s_name")]
SORT_FIELDS = [("part", "p_name"), ("customer", "c_name")]

DEFAULT_RESULT_WINDOW = 10000
DEFAULT_FIELD_LIMIT = 1000
STEMMER_SETTING = "index.analysis.filter.docforge_stemmer.language"


# ---------------------------------------------------------------- Spark side
def datasets_df(spark: SparkSession) -> DataFrame:
    return small_frame(
        spark, DATASETS, "code string, entity string, source_table string, id_field string, language string, "
                  "dynamic string, has_provider boolean")


def declared_df(spark: SparkSession) -> DataFrame:
    return small_frame(spark, DECLARED, "code string, field string, type string, has_keyword boolean")


def indexes_df(spark: SparkSession) -> DataFrame:
    return small_frame(spark, INDEXES, "position int, index string, source_table string, aliases array<string>")


def settings_df(spark: SparkSession) -> DataFrame:
    return small_frame(spark, SETTINGS, "index string, key string, value string")


def intents_df(spark: SparkSession) -> DataFrame:
    return small_frame(spark, INTENTS, "code string, name string, facet boolean, filterable boolean, "
                                          "searchable boolean, sortable boolean")


def facet_fields_df(spark):
    return small_frame(spark, FACET_FIELDS, "code string, name string, target string")


def search_fields_df(spark):
    return small_frame(spark, SEARCH_FIELDS, "code string, name string")


def sort_fields_df(spark):
    return small_frame(spark, SORT_FIELDS, "code string, name string")


def source_fields_df(spark: SparkSession) -> DataFrame:
    rows = [(code, f) for code, fields in SOURCE_FIELDS.items() for f in fields]
    return small_frame(spark, rows, "code string, field string")


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source table: row count and non-null count of every projected
    column, from one aggregate pass per table; written once to the shared
    folder and read back so that the audit's many joins never rescan data."""
    from docforge.operators.audit import field_stats
    from docforge.operators.sync import new_session_scoped_dir

    tables = sorted({d[2] for d in DATASETS} | {i[2] for i in INDEXES})
    frames = {}
    for t in tables:
        src = read_table(spark, sf_dir, t)
        wanted = [f for d in DATASETS if d[2] == t for f in SOURCE_FIELDS[d[0]] if f in src.columns]
        frames[t] = src.select(*dict.fromkeys(wanted))
    path = new_session_scoped_dir(spark, "audit-stats")
    field_stats(frames).withColumnRenamed("key", "source_table").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


def observed_stats(spark: SparkSession, stats: DataFrame) -> DataFrame:
    """``(code, field, kind, present_docs)`` for each dataset's projected fields."""
    ds = datasets_df(spark).select("code", "source_table")
    # configuration- and schema-sized on both sides
    return (source_fields_df(spark).join(F.broadcast(ds), "code")
            .join(F.broadcast(stats.where(F.col("field") != "*")), ["source_table", "field"])
            .select("code", "field", "kind", F.col("present").alias("present_docs")))


def counts_from_stats(spark: SparkSession, stats: DataFrame) -> DataFrame:
    rows = stats.where(F.col("field") == "*").select("source_table", F.col("present").alias("docs"))
    return indexes_df(spark).join(F.broadcast(rows), "source_table").drop("source_table")


def index_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document count of every physical index: one aggregate per source table
    (Parquet footers answer ``count(*)``), joined to the index list."""
    tables = sorted({i[2] for i in INDEXES})
    counts = None
    for t in tables:
        c = read_table(spark, sf_dir, t).groupBy().count().select(F.lit(t).alias("source_table"),
                                                                  F.col("count").alias("docs"))
        counts = c if counts is None else counts.unionByName(c)
    return indexes_df(spark).join(counts, "source_table").drop("source_table")


# ---------------------------------------------------------------- SQL side
def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return str(v)
    if isinstance(v, list):
        return "[" + ", ".join(_lit(x) for x in v) + "]::VARCHAR[]" if v else "[]::VARCHAR[]"
    return "'" + str(v).replace("'", "''") + "'"


def values_sql(rows, columns: list[str]) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(columns)}))"


DATASETS_SQL = values_sql(DATASETS, ["code", "entity", "source_table", "id_field", "language", "dynamic",
                                     "has_provider"])
DECLARED_SQL = values_sql(DECLARED, ["code", "field", "type", "has_keyword"])
INDEXES_SQL = values_sql(INDEXES, ["position", "index", "source_table", "aliases"])
SETTINGS_SQL = values_sql(SETTINGS, ["index", "key", "value"])
INTENTS_SQL = values_sql(INTENTS, ["code", "name", "facet", "filterable", "searchable", "sortable"])
FACET_FIELDS_SQL = values_sql(FACET_FIELDS, ["code", "name", "target"])
SEARCH_FIELDS_SQL = values_sql(SEARCH_FIELDS, ["code", "name"])
SORT_FIELDS_SQL = values_sql(SORT_FIELDS, ["code", "name"])
