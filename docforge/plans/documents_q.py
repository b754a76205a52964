"""Queries for document build, projection and normalisation (2.1, 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docforge.operators.documents import build_documents
from docforge.plans.registry import query
from docforge.sources.tables import read_table
from docforge.spec import DatasetSpec

DOCUMENTS_SPEC = DatasetSpec(
    code="documents", entity="document", table="documents", id_field="doc_id",
    source_fields=("d.text", "d.lang", "d.source", "n_chars", "d.lang"),
)


@query("build_documents", """
SELECT CAST(doc_id AS VARCHAR) AS id, text, lang, source, n_chars FROM documents
""", ("SRC-1", "PRJ-1", "PRJ-2", "PRJ-6"))
def build_documents_q(spark, sf_dir):
    return build_documents(spark, DOCUMENTS_SPEC, sf_dir)


def _conversation_provider(sf_dir):
    def provide(spark):
        conv = read_table(spark, sf_dir, "conversations")
        return conv.select(F.concat_ws("-", "conv_id", "turn").alias("key"), "conv_id", "turn", "role", "text")
    return provide


@query("provider_documents", """
SELECT conv_id || '-' || turn AS id, role, text, conv_id FROM conversations
""", ("SRC-2", "UDF-1", "PRJ-1"))
def provider_documents_q(spark, sf_dir):
    # A configured (callable) provider wins over the table; the id is a
    # composite key the provider builds, since (conv_id, turn) is unique.
    spec = DatasetSpec(code="conversations", entity="conversation", table="customer",
                       provider=_conversation_provider(sf_dir), id_field="key",
                       search_fields=("c.role", "c.text", "conv_id"))
    return build_documents(spark, spec, sf_dir)


@query("missing_field_nulls", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name, CAST(NULL AS VARCHAR) AS c_phone,
       c_acctbal, CAST(NULL AS VARCHAR) AS c_comment
FROM customer
""", ("PRJ-3",))
def missing_field_nulls_q(spark, sf_dir):
    spec = DatasetSpec(code="customer", entity="customer", table="customer", id_field="c_custkey",
                       source_fields=("c.c_name", "c_phone", "c.c_acctbal", "c_comment"))
    return build_documents(spark, spec, sf_dir)


@query("normalize_orders", """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS o_orderdate,
       o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' || ',' ||
       strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS review_window
FROM orders
""", ("PRJ-5",))
def normalize_orders_q(spark, sf_dir):
    def provider(spark_):
        orders = read_table(spark_, sf_dir, "orders")
        return orders.withColumn(
            "review_window",
            F.array(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")))
    spec = DatasetSpec(code="orders", entity="order", table="orders", provider=provider,
                       id_field="o_orderkey",
                       source_fields=("o.o_orderdate", "o.o_orderstatus", "o.o_totalprice", "review_window"))
    docs = build_documents(spark, spec, sf_dir)
    # arrays are normalised element-wise; joined to text only for the oracle compare
    return docs.withColumn("review_window", F.array_join("review_window", ","))


def _page_mapper(pages):
    """PRJ-4: a custom mapper, expressed as built-in column functions."""
    html = F.col("html")
    no_code = F.regexp_replace(html, r"(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", " ")
    plain = F.regexp_replace(F.regexp_replace(no_code, r"<[^>]*>", " "), r"[ \t\n\r]+", " ")
    return pages.select(
        F.col("page_id"),
        F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1).alias("host"),
        F.regexp_extract(html, r"<html[^>]*lang=\"([^\"]*)\"", 1).alias("lang"),
        F.regexp_extract(html, r"<title>(.*?)</title>", 1).alias("title"),
        F.trim(plain).alias("body"),
    )


@query("mapped_documents", r"""
SELECT CAST(page_id AS VARCHAR) AS id,
       regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host,
       regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
       trim(regexp_replace(regexp_replace(
           regexp_replace(html, '(?s)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g'),
           '<[^>]*>', ' ', 'g'), '[ \t\n\r]+', ' ', 'g')) AS body
FROM pages
""", ("PRJ-4", "UDF-2"))
def mapped_documents_q(spark, sf_dir):
    spec = DatasetSpec(code="pages", entity="page", table="pages", id_field="page_id", mapper=_page_mapper)
    return build_documents(spark, spec, sf_dir).drop("page_id")


@query("nested_documents", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS placed, o_orderstatus AS status,
       strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS due,
       strftime(o_orderdate, '%Y-%m-%dT') || '00:00:00+00:00' AS day
FROM orders
""", ("PRJ-5",))
def nested_documents_q(spark, sf_dir):
    # date-times inside structs, maps and arrays of structs
    def provider(spark_):
        at = F.col("o_orderdate")
        return read_table(spark_, sf_dir, "orders").select(
            "o_orderkey", F.struct(at.alias("placed"), F.col("o_orderstatus").alias("status")).alias("state"),
            F.create_map(F.lit("due"), at + F.expr("INTERVAL 1 DAY")).alias("dates"),
            F.array(F.struct(at.cast("date").alias("day"))).alias("steps"))
    spec = DatasetSpec(code="orders", entity="order", provider=provider, id_field="o_orderkey", source_fields=("state", "dates", "steps"))
    return build_documents(spark, spec, sf_dir).select(
        "id", "state.placed", "state.status", F.col("dates")["due"].alias("due"), F.col("steps")[0]["day"].alias("day"))


@query("mapper_without_id", """
SELECT CAST(page_id AS VARCHAR) AS id, upper(url) AS url FROM pages
""", ("PRJ-6", "PRJ-4"))
def mapper_without_id_q(spark, sf_dir):
    # the mapper drops the id field: the id is the source row's
    spec = DatasetSpec(code="pages", entity="page", table="pages", id_field="page_id",
                       mapper=lambda pages: pages.withColumn("url", F.upper("url")).drop("page_id", "html"))
    return build_documents(spark, spec, sf_dir)


@query("own_id_first", """
SELECT CASE WHEN page_id % 2 = 0 THEN 'even-' || page_id ELSE CAST(page_id AS VARCHAR) END AS id, url FROM pages
""", ("PRJ-6",))
def own_id_first_q(spark, sf_dir):
    # the document's own id field wins; where it is null the source row's counts
    spec = DatasetSpec(code="pages", entity="page", table="pages", id_field="page_id",
                       mapper=lambda pages: pages.withColumn("page_id", F.when(
                           F.col("page_id") % 2 == 0, F.concat(F.lit("even-"), F.col("page_id")))).drop("html"))
    return build_documents(spark, spec, sf_dir).drop("page_id")
