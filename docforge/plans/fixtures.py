"""Fixture conventions shared by the Spark queries and their SQL twins.

* Change rows come from ``events``: ``user_id`` is the id; ``signup`` is a
  persist, ``purchase`` an update, ``error`` a remove of the customer
  entity; ``view``/``click`` belong to an entity class that backs no
  dataset. The flush boundary is the event's day.
* The source entity ``customer`` is keyed by ``c_custkey``.
* Raw JSON documents are ``events.props`` with two manufactured defects:
  an object value for ``k`` on every 11th event and an undeclared key
  ``zz`` on every 7th other one. All rows are kept and processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.sources.tables import read_table, small_frame

CUSTOMER_ENTITY = "App\\Entity\\Customer"
SESSION_ENTITY = "App\\Entity\\Session"

# Event type -> change operation.
EVENT_OPS = {"signup": "persist", "purchase": "update", "error": "remove", "view": "update", "click": "update"}


def change_rows(spark: SparkSession, sf_dir: str, extra: tuple = ()) -> DataFrame:
    """``(flush TIMESTAMP_NTZ, entity, key ARRAY<STRING>, op)`` from events, with the columns ``extra`` of them."""
    ev = read_table(spark, sf_dir, "events")
    op = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_OPS.items()])
    entity = (F.when(F.col("event_type").isin("signup", "purchase", "error"), F.lit(CUSTOMER_ENTITY))
              .otherwise(F.lit(SESSION_ENTITY)))
    return ev.select(F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("flush"),
                     entity.alias("entity"),
                     F.array(F.col("user_id").cast("string")).alias("key"),
                     op.alias("op"), *extra)


def dataset_entities(spark: SparkSession) -> DataFrame:
    """The spec table: which entity class backs which dataset."""
    return small_frame(spark, [("customer", CUSTOMER_ENTITY)], "code string, entity string")


CHANGES_SQL = f"""
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS flush,
       '{CUSTOMER_ENTITY}' AS entity, CAST(user_id AS VARCHAR) AS id,
       CASE event_type WHEN 'signup' THEN 'persist' WHEN 'purchase' THEN 'update' ELSE 'remove' END AS op
FROM events WHERE event_type IN ('signup', 'purchase', 'error')
"""

RECONCILED_SQL = f"""
SELECT flush, entity, id,
       CASE WHEN max(CASE WHEN op = 'remove' THEN 1 ELSE 0 END) = 1 THEN 'delete' ELSE 'upsert' END AS action
FROM ({CHANGES_SQL}) c GROUP BY flush, entity, id
"""

FINAL_SQL = f"SELECT entity, id, max_by(action, flush) AS action FROM ({RECONCILED_SQL}) r GROUP BY entity, id"


def raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, doc)``: the manufactured JSON documents."""
    ev = read_table(spark, sf_dir, "events")
    doc = (F.when(F.col("event_id") % 11 == 0, F.lit('{"k":{"n":1}}'))
           .when(F.col("event_id") % 7 == 0,
                 F.concat(F.expr("substr(props, 1, length(props) - 1)"), F.lit(', "zz": 1}')))
           .otherwise(F.col("props")))
    return ev.select("event_id", doc.alias("doc"))


RAW_JSON_SQL = """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 THEN '{"k":{"n":1}}'
            WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) || ', "zz": 1}'
            ELSE props END AS doc
FROM events
"""
