"""Queries for validation of raw documents (FLT-4/5/6, SNK-3, PRJ-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docforge.operators import validate
from docforge.plans.fixtures import RAW_JSON_SQL, raw_json
from docforge.plans.registry import query
from docforge.spec import FieldSpec

EVENT_MAPPING = {"k": FieldSpec("long")}


@query("strict_rejects", f"""
SELECT CAST(event_id AS VARCHAR) AS id,
       array_to_string(list_sort(list_filter(json_keys(doc), lambda x: x <> 'k')), ',') AS undeclared
FROM ({RAW_JSON_SQL}) j
WHERE len(list_filter(json_keys(doc), lambda x: x <> 'k')) > 0
""", ("FLT-4",))
def strict_rejects_q(spark, sf_dir):
    docs = raw_json(spark, sf_dir)
    extra = validate.undeclared_keys(F.col("doc"), list(EVENT_MAPPING))
    return (docs.select(F.col("event_id").cast("string").alias("id"), F.array_join(extra, ",").alias("undeclared"))
            .where(F.length("undeclared") > 0))


@query("rejected_documents", f"""
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN json_type(doc, '$.k') IN ('OBJECT', 'ARRAY') THEN 'illegal_argument_exception'
            ELSE 'strict_dynamic_mapping_exception' END AS reject_type,
       CASE WHEN json_type(doc, '$.k') IN ('OBJECT', 'ARRAY') THEN 'Expected long but found START_OBJECT'
            ELSE 'mapping set to strict, dynamic introduction of ['
                 || array_to_string(list_sort(list_filter(json_keys(doc), lambda x: x <> 'k')), ',')
                 || '] within [_doc] is not allowed' END AS reason
FROM ({RAW_JSON_SQL}) j
WHERE json_type(doc, '$.k') IN ('OBJECT', 'ARRAY') OR len(list_filter(json_keys(doc), lambda x: x <> 'k')) > 0
""", ("SNK-3", "FLT-5"))
def rejected_documents_q(spark, sf_dir):
    docs = raw_json(spark, sf_dir).withColumn("id", F.col("event_id").cast("string"))
    _, rejected = validate.split_valid(validate.classify(docs, "doc", EVENT_MAPPING, strict=True))
    return rejected.select("id", "reject_type", "reason")


@query("inferred_fields", f"""
SELECT key AS field,
       CASE json_type(doc, '$."' || key || '"') WHEN 'UBIGINT' THEN 'long' WHEN 'BIGINT' THEN 'long'
            WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean'
            WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'null' END AS inferred_type,
       count(*) AS n_docs
FROM (SELECT doc, unnest(json_keys(doc)) AS key FROM ({RAW_JSON_SQL}) j) k
GROUP BY 1, 2
""", ("FLT-6",))
def inferred_fields_q(spark, sf_dir):
    return validate.inferred_fields(raw_json(spark, sf_dir), "doc")


@query("bad_ids", f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CASE WHEN json_type(doc, '$.k') IS NULL THEN 'null' ELSE 'non_scalar' END AS id_status
FROM ({RAW_JSON_SQL}) j
WHERE json_type(doc, '$.k') IS NULL OR json_type(doc, '$.k') IN ('OBJECT', 'ARRAY')
""", ("PRJ-6",))
def bad_ids_q(spark, sf_dir):
    docs = raw_json(spark, sf_dir)
    bad = validate.id_problems(docs, "doc", "k")
    return bad.select(F.col("event_id").cast("string").alias("event_id"), "id_status")


# bracketed text, arrays of numbers and of objects, no JSON at all, numbers in text that can and can't be read
_ODD = {0: '{"k":1,"t":"[Draft] {x}"}', 1: '{"k":[1,2]}', 2: '{"k":[{"n":1}]}', 3: "not json", 4: '{"k":"abc"}', 5: '{"k":"12"}',
        6: '{"t":{"a":1}}', 7: '{"k":["1","x"]}'}
_ODD_SQL = ("SELECT event_id, CASE event_id % 17 " + " ".join(f"WHEN {n} THEN '{doc}'" for n, doc in _ODD.items())
            + " ELSE props END AS doc FROM events")


@query("rejected_odd_documents", f"""
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN shape IS NOT NULL THEN 'illegal_argument_exception' ELSE 'document_parsing_exception' END AS reject_type,
       CASE WHEN NOT json_valid(doc) THEN 'failed to parse' WHEN shape IS NOT NULL THEN 'Expected ' || shape || ' but found START_OBJECT'
            ELSE 'failed to parse field [k] of type [long]' END AS reason
FROM (SELECT *, CASE WHEN NOT json_valid(doc) THEN NULL WHEN json_type(doc, '$.k') = 'OBJECT' OR json_type(doc, '$.k[0]') = 'OBJECT' THEN 'long'
                     WHEN json_type(doc, '$.t') = 'OBJECT' THEN 'text' END AS shape,
             CASE WHEN NOT json_valid(doc) THEN false WHEN json_type(doc, '$.k') = 'ARRAY'
                  THEN len(list_filter(json_extract_string(doc, '$.k[*]'), lambda x: TRY_CAST(x AS DOUBLE) IS NULL)) > 0
                  ELSE json_extract_string(doc, '$.k') IS NOT NULL AND TRY_CAST(json_extract_string(doc, '$.k') AS DOUBLE) IS NULL END AS unread
      FROM ({_ODD_SQL}) o) c
WHERE NOT json_valid(doc) OR shape IS NOT NULL OR unread
""", ("SNK-3", "FLT-4", "FLT-5"))
def rejected_odd_documents_q(spark, sf_dir):
    from docforge.sources.tables import read_table
    case = F.coalesce(*[F.when(F.col("event_id") % 17 == n, F.lit(doc)) for n, doc in _ODD.items()], F.col("props"))
    docs = read_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), case.alias("doc"))
    mapping = {"k": FieldSpec("long"), "t": FieldSpec("text")}
    _, rejected = validate.split_valid(validate.classify(docs, "doc", mapping, strict=True))
    return rejected.select("id", "reject_type", "reason")


@query("malformed_documents", f"""
SELECT 'malformed' AS field, CAST(NULL AS VARCHAR) AS inferred_type, count(*) FILTER (WHERE NOT json_valid(doc)) AS n_docs FROM ({_ODD_SQL}) o
UNION ALL SELECT key, CASE json_type(doc, '$."' || key || '"') WHEN 'UBIGINT' THEN 'long' WHEN 'BIGINT' THEN 'long' WHEN 'DOUBLE' THEN 'float'
                           WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' ELSE 'null' END,
                 count(*)
FROM (SELECT doc, unnest(json_keys(doc)) AS key FROM ({_ODD_SQL}) o WHERE json_valid(doc)) k GROUP BY 1, 2
""", ("FLT-6",))
def malformed_documents_q(spark, sf_dir):
    # fields are inferred from what can be read; what can't is counted
    from docforge.sources.tables import read_table
    case = F.coalesce(*[F.when(F.col("event_id") % 17 == n, F.lit(doc)) for n, doc in _ODD.items()], F.col("props"))
    docs = read_table(spark, sf_dir, "events").select(case.alias("doc"))
    bad = validate.malformed_documents(docs, "doc").select(
        F.lit("malformed").alias("field"), F.lit(None).cast("string").alias("inferred_type"), F.col("malformed").alias("n_docs"))
    return bad.unionByName(validate.inferred_fields(docs, "doc"))


@query("evolved_mapping", f"""
SELECT key AS field, CASE WHEN bool_or(kind = 'VARCHAR') THEN 'text' WHEN bool_or(kind = 'OBJECT') AND key <> 'k' THEN 'object'
       WHEN key = 'k' THEN 'keyword' ELSE 'long' END AS type
FROM (SELECT key, json_type(doc, '$."' || key || '"') AS kind
      FROM (SELECT doc, unnest(json_keys(doc)) AS key FROM ({RAW_JSON_SQL}) j) x) y
GROUP BY key
""", ("FLT-6",))
def evolved_mapping_q(spark, sf_dir):
    # the declared field keeps its type, fields of the documents are added
    from docforge.sources.tables import small_frame
    out = validate.evolved_mapping(validate.inferred_fields(raw_json(spark, sf_dir), "doc"), {"k": FieldSpec("keyword")})
    return small_frame(spark, [(k, v.type) for k, v in out.items()], "field string, type string")


# nested, repeated, dated, widening and clashing values made of the events' own columns; one row in 13 is no JSON
_NESTED_SQL = """
SELECT CASE WHEN event_id % 13 = 0 THEN props || '}'
            WHEN event_id % 5 = 0 THEN '{"at":"' || strftime(ts, '%Y-%m-%d') || '","user":{"id":' || user_id || ',"tags":["a",' || (event_id % 3) || ']},"items":[{"n":1.5},{"n":2}],"mixed":{"a":1}}'
            WHEN event_id % 5 = 1 THEN '{"at":"' || strftime(ts, '%Y/%m/%d') || '","user":{"id":"' || user_id || '","name":null},"items":[],"mixed":1,"day":"2023-02-31"}'
            WHEN event_id % 5 = 2 THEN '{"user":{"deep":{"er":[[true],[false]]}},"day":"2024-02-29","x.y":0.5,"flag":true}'
            WHEN event_id % 5 = 3 THEN NULL ELSE props END AS doc FROM events
"""


def _nested_json(spark, sf_dir):
    from docforge.sources.tables import read_table
    n, user = F.col("event_id"), F.col("user_id").cast("string")
    day = lambda form: F.date_format("ts", form)
    doc = (F.when(n % 13 == 0, F.concat("props", F.lit("}")))
           .when(n % 5 == 0, F.concat(F.lit('{"at":"'), day("yyyy-MM-dd"), F.lit('","user":{"id":'), user, F.lit(',"tags":["a",'),
                                      (n % 3).cast("string"), F.lit(']},"items":[{"n":1.5},{"n":2}],"mixed":{"a":1}}')))
           .when(n % 5 == 1, F.concat(F.lit('{"at":"'), day("yyyy/MM/dd"), F.lit('","user":{"id":"'), user,
                                      F.lit('","name":null},"items":[],"mixed":1,"day":"2023-02-31"}')))
           .when(n % 5 == 2, F.lit('{"user":{"deep":{"er":[[true],[false]]}},"day":"2024-02-29","x.y":0.5,"flag":true}'))
           .when(n % 5 == 3, F.lit(None)).otherwise(F.col("props")))
    return read_table(spark, sf_dir, "events").select(doc.alias("doc"))


@query("merged_schema", f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc, json_valid(doc) AND json_type(TRY_CAST(doc AS JSON)) = 'OBJECT' AS ok FROM ({_NESTED_SQL}) d),
found AS (
  SELECT n, replace(regexp_replace(substr(fullkey, 3), '\\[[0-9]+\\]', '', 'g'), '"', '') AS path, type,
         CASE WHEN type IN ('UBIGINT', 'BIGINT') THEN 'long' WHEN type = 'DOUBLE' THEN 'float' WHEN type = 'BOOLEAN' THEN 'boolean' WHEN type = 'OBJECT' THEN 'object'
              WHEN type = 'VARCHAR' AND TRY_CAST(replace(json_extract_string(atom, '$'), '/', '-') AS DATE) IS NOT NULL THEN 'date'
              WHEN type = 'VARCHAR' THEN 'text' ELSE 'null' END AS family
  FROM (SELECT n, doc FROM docs WHERE ok) d, json_tree(d.doc::JSON) t
  WHERE fullkey <> '$' AND (type <> 'ARRAY' OR json_array_length(t.value) = 0)),
merged AS (
  SELECT path, count(DISTINCT n) AS n_docs, count(DISTINCT CASE WHEN family = 'object' THEN n END) AS n_object,
         bool_or(family = 'object') AS o, bool_or(family = 'text') AS t, bool_or(family = 'date') AS d, bool_or(family = 'boolean') AS b,
         bool_or(family = 'float') AS f, bool_or(family = 'long') AS l FROM found GROUP BY path)
SELECT path, CASE WHEN o AND (t OR d OR b OR f OR l) THEN 'conflict' WHEN o THEN 'object' WHEN t OR d::INT + b::INT + (f OR l)::INT > 1 THEN 'text'
                  WHEN d THEN 'date' WHEN b THEN 'boolean' WHEN f THEN 'float' WHEN l THEN 'long' ELSE 'null' END AS type, n_docs, n_object
FROM merged
UNION ALL SELECT NULL, 'malformed', count(*), 0 FROM docs WHERE doc IS NOT NULL AND NOT ok HAVING count(*) > 0
""", ("FLT-6",))
def merged_schema_q(spark, sf_dir):
    from docforge.operators.schema import merged_schema
    return merged_schema(_nested_json(spark, sf_dir), "doc")
