"""Source resolution (SRC-2): a configured provider wins over the table.

* a DataFrame provider is used as is;
* a callable provider is called with the session and must return a DataFrame;
* a provider that yields something else falls back to the dataset's table;
* no provider and no table is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docforge.sources.tables import read_table
from docforge.spec import DatasetSpec


def resolve_source(spark: SparkSession, spec: DatasetSpec, sf_dir: str | None = None) -> DataFrame:
    provider = spec.provider
    if callable(provider) and not isinstance(provider, DataFrame):
        provider = provider(spark)
    if isinstance(provider, DataFrame):
        return provider
    if spec.table is None:
        raise LookupError(f"dataset {spec.code!r}: no provider and no source table")
    if sf_dir is None:
        return spark.table(spec.table)
    return read_table(spark, sf_dir, spec.table)
