"""What a store holds, readable without asking its tables one by one (SRC-6, RPT-8).

Each table has a folder of small numbered records (``versions``): one from its creation (owner, mapping, analyzer, strictness, settings
with their limits), one from every fill with the documents written. Aliases are in their own version logs. A
catalog of any number of tables is therefore two reads of small files; the records of a table go with it.

Documents of a table with a change log are its fills plus the signed effect of the log: ids that the log leaves alive, less those
of the generation that it touches. All logs of the store are reduced in one job, joined to the ids of their generations; tables without a
log are not read at all.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.operators.versions import VersionLog

RECORD = ("kind string, index string, owner string, mapping string, analyzer string, dynamic string, settings string, id_type string, "
          "docs bigint")


class Manifest:
    def __init__(self, spark, root: str, database: str) -> None:
        self.spark, self.root, self.db = spark, root, database

    def folder(self, index: str = "") -> str:
        return f"{self.root}/manifest/{self.db}/{index}".rstrip("/")

    def _log(self, index: str) -> VersionLog:
        return VersionLog(self.spark, self.folder(index))

    def enter(self, index: str, **record) -> None:
        """Add a record of a table; writers at the same time get numbers of their own."""
        log = self._log(index)
        number = log.head()[0]
        while not log.enter(number + 1, {"index": index, **record}):
            number += 1

    def drop(self, index: str) -> None:
        self._log(index).drop()

    def drop_all(self) -> None:
        VersionLog(self.spark, self.folder()).drop()

    def _records(self, pattern: str, ddl: str) -> DataFrame:
        log = VersionLog(self.spark, pattern)
        found = log.fs.globStatus(log.path)
        if found is None or not len(found):
            return self.spark.createDataFrame([], f"{ddl}, __path string")
        return self.spark.read.schema(ddl).json(pattern).withColumn("__path", F.col("_metadata.file_path"))

    def tables(self) -> DataFrame:
        """One row a table: ``index``, ``owner``, ``mapping``, ``analyzer``, ``dynamic``, ``settings`` (JSON), ``id_type``, ``filled``."""
        rows = self._records(f"{self.folder()}/*/*.json", RECORD)
        made = [F.max(c).alias(c) for c in ("owner", "mapping", "analyzer", "dynamic", "settings", "id_type")]
        return rows.groupBy("index").agg(*made, F.coalesce(F.sum("docs"), F.lit(0)).alias("filled"))

    def aliases(self) -> DataFrame:
        """``alias``, ``index``: the generation each alias's newest record names."""
        rows = self._records(f"{self.root}/versions/{self.db}/*/*.json", "generation string")
        place = F.element_at(F.split("__path", "/"), -2)
        number = F.element_at(F.split("__path", "/"), -1).substr(1, 12).cast("bigint")
        alias = F.url_decode(F.replace(place, F.lit("+"), F.lit("%2B")))
        return (rows.groupBy(alias.alias("alias")).agg(F.max_by("generation", number).alias("index")).where("index IS NOT NULL"))

    def log_effect(self, logs: dict[str, str], paths: dict[str, str], id_types: dict[str, str]) -> DataFrame:
        """``index``, ``effect``: documents the change log adds to its generation, or takes from it. ``logs`` and ``paths`` name the folders of
        each table's log and files. One plan a type of id."""
        found = []
        for kind in sorted({id_types[i] for i in logs}):
            own = [i for i in logs if id_types[i] == kind]
            name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
            log = (self.spark.read.option("recursiveFileLookup", True).schema(f"id {kind}, _seq bigint, _deleted boolean").parquet(*[logs[i] for i in own])
                   .select(F.regexp_replace(name, "__log$", "").alias("index"), "id", "_seq", "_deleted"))
            last = log.groupBy("index", "id").agg(F.max_by("_deleted", F.struct("_seq", "_deleted")).alias("gone"))
            base = (self.spark.read.schema(f"id {kind}").parquet(*[paths[i] for i in own])
                    .select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("index"), "id", F.lit(1).alias("was")))
            both = last.join(base, ["index", "id"], "left")
            found.append(both.groupBy("index").agg((F.count_if(~F.col("gone")) - F.count("was")).alias("effect")))
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], "index string, effect bigint")


def created(mapping: dict, analyzer, strict: bool, settings: dict, id_type: str) -> dict:
    """The record of a creation."""
    return {"kind": "created", "mapping": json.dumps({k: [v.type, v.has_keyword] for k, v in mapping.items()}),
            "analyzer": json.dumps({"language": analyzer.language, "ascii_folding": analyzer.ascii_folding}),
            "dynamic": "strict" if strict else "true", "settings": json.dumps(settings), "id_type": id_type}
