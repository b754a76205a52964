"""Readers for the source tables (SRC-1).

A source is any DataFrame; the test tables are one Parquet file each.
Column pruning and filter push-down are left to Catalyst: callers select
only what they need and the scan's ``ReadSchema`` shrinks accordingly.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def small_frame(spark: SparkSession, rows: list, ddl: str) -> DataFrame:
    """A configuration-sized table as a local relation: planned without tasks of its own and broadcast as it is."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [[]] * len(schema.fields)
    arrow = to_arrow_schema(schema)
    data = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(data, schema)
