"""Corpus pipeline: language ID, near duplicates, repeated passages, packing.

``STAGES`` lists the stages in order. A stage takes the documents that its predecessor kept and returns a table, which is written
as Parquet to the shared folder and read again as the next one's documents. All but the last return the columns of the documents
table they got.

* ``language_id``: learns from the labelled documents it gets and gives those without a label the predicted language (unless it is
  ambiguous). Documents that have no language, as they have no letter, go. Documents whose language
  is merely uncertain stay, and so do all with a letter if there is no label to learn from.
* ``jaccard_join``: of documents linked by a Jaccard similarity of 0.8 or more of their sets of five words one stays, that of the
  smallest id; a row that repeats another's id and text goes too.
* ``difference_cover``: 50-byte strings that an earlier document has too are cut out (whole characters only); ``n_chars`` is
  counted anew, and documents of which nothing is left go.
* ``packing``: sequences of 2048 ids along the curve; one row a piece.

Null ids, null texts and extra columns follow the operators' own rules; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.llm import jaccard_join, langid, pack, repeats
from docforge.llm.common import table
from docforge.llm.queries import BYTE_BPE
from docforge.session import scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs)
    names = [f"c{k}" for k in range(len(docs.columns))]  # the predictions' columns may be named as the documents' own
    of = dict(zip(docs.columns, names))
    found = langid.identify(docs.toDF(*names), model, text_col=of["text"], keep=tuple(names))
    told = F.when(F.col("lang_pred") != langid.UNKNOWN, F.col("lang_pred"))
    lang = F.coalesce(of["lang"], F.when(~F.col("ambiguous"), told))
    return found.where("has_letter").select(*((lang if c == "lang" else F.col(n)).alias(c) for c, n in of.items()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    rest = F.struct(*(F.col(c) for c in others)) if others else F.lit(None).cast("string")
    left = repeats.remove_repeats(docs.select("doc_id", "text", rest.alias("rest")), width=50, carry=("rest",), whole_characters=True,
                                  shard_bytes=8 << 20)  # workers still hold the earlier stages' modules, so less than by itself
    own = {"doc_id": F.col("doc_id"), "text": F.col("kept").cast("string"), "n_chars": F.char_length(F.col("kept").cast("string")).cast("long")}
    return left.where((F.octet_length("kept") > 0) | (F.col("n_bytes") == 0)).select(
        *((own[c] if c in own else F.col("rest")[c]).alias(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack(docs, BYTE_BPE, end_id=1, length=2048)


STAGES = [("language_id", language_id), ("jaccard_join", near_duplicates), ("difference_cover", repeated_passages), ("packing", packing)]

#: Neither the tokenizer nor the classifier can be told in SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
