"""The id spool: JSON lines ``{"id": ...}`` partitioned by entity (SRC-4, SRC-5, SNK-10).

Writing is an ordinary partitioned append; reading tolerates blank,
malformed and id-less lines (they parse to a null id and are dropped), casts
ids to strings (``1`` and ``"1"`` merge) and de-duplicates per entity with a
map-side-combined aggregate. Entity class names contain ``\\``; on disk the
partition value uses ``.`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY_DIR = "entity"


def encode_entity(col):
    return F.replace(col, F.lit("\\"), F.lit("."))


def entity_folder(entity: str) -> str:
    return entity.replace("\\", ".")


def decode_entity(col):
    return F.replace(col, F.lit("."), F.lit("\\"))


def append_spool(ids: DataFrame, path: str) -> None:
    """SNK-10: append ``(entity, id)`` rows as JSON lines under ``entity=<name>``."""
    (ids.select(F.col("id").cast("string").alias("id"), encode_entity(F.col("entity")).alias(ENTITY_DIR))
        .write.mode("append").partitionBy(ENTITY_DIR).json(path))


def read_spool(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: distinct ``(entity, id)`` of every well-formed line.

    A missing spool directory reads as empty.
    """
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField(ENTITY_DIR, T.StringType())])
    if not _exists(spark, path):
        return spark.createDataFrame([], schema).select(ENTITY_DIR, "id")
    raw = (spark.read.schema(schema).option("mode", "PERMISSIVE")
           .option("recursiveFileLookup", "false").json(path))
    # a missing or null id is skipped; any other value -- the empty string
    # included -- is kept as its string form
    return (raw.where(F.col("id").isNotNull())
            .select(decode_entity(F.col(ENTITY_DIR)).alias("entity"), "id")
            .dropDuplicates(["entity", "id"]))


def spool_classes(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: entity classes that have a spool folder (missing dir -> empty). Folder names
    alone are listed; no spool line is read."""
    names = []
    if _exists(spark, path):
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = [(unescape(n.split("=", 1)[1]),) for n in names if n.startswith(f"{ENTITY_DIR}=")]
    return spark.createDataFrame(found, f"{ENTITY_DIR} string").select(decode_entity(F.col(ENTITY_DIR)).alias("entity"))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)
