"""Document fingerprints by I-Match over randomised lexicons, with DataFrame functions only.

A term is a run of letters and digits in lower case. The lexicon holds the terms whose document frequency lies in a band
of inverse document frequency (``LOW`` to ``HIGH`` of all documents). ``SUBSETS`` random parts of the lexicon are drawn, by
hash of the term and at several densities. A text's distinct terms in a part are sorted and hashed: that is the part's
signature, none if the text has no term of it. The fingerprint is the row of signatures; a text without any has the hash
of all its sorted terms instead. The likeness of two fingerprints is the number of parts in which both have the same
signature, as a share of the parts in which either has one. Dense parts tell short texts apart, sparse ones find long texts
that share most of their terms.

The lexicon has at most (mean number of distinct terms a text) / ``LOW`` entries of two longs, whatever the number of documents.
It is broadcast up to ``BROADCAST_ENTRIES`` entries; beyond them the join is left to Spark.

Defined results: a null text is empty. Texts without any term have equal fingerprints. A null id orders first, equal ids by
text. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docforge.llm.common import partitions, stored

#: Band of document frequency as shares of the documents.
LOW, HIGH = 0.01, 0.1
#: A part takes one of so many terms of the lexicon; 32 parts.
RATES = (8,) * 4 + (32,) * 8 + (128,) * 12 + (512,) * 8
SUBSETS = len(RATES)
BROADCAST_ENTRIES = 1_000_000
#: Stands for "this text" among its terms, so that a text without lexicon terms keeps its row.
SELF = 0


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str, documents: int) -> DataFrame:
    """``term`` (hash) and ``parts`` (bits of the parts that have it) of the terms in the band."""
    df = docs.select(F.explode(term_hashes(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    band = df.where((F.col("df") >= max(1, LOW * documents)) & (F.col("df") <= max(1, HIGH * documents)) & (F.col("term") != SELF))
    parts = sum((F.when(F.pmod(F.xxhash64("term", F.lit(k)), F.lit(rate)) == 0, F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
                 for k, rate in enumerate(RATES)), F.lit(0).cast("long"))
    return band.select("term", parts.alias("parts")).where("parts <> 0")


def signatures(terms: Column, whole: Column) -> Column:
    """Signature of each part from sorted (term, parts) pairs; the hash of all terms if no part has one."""
    def part(k: Column) -> Column:
        own = F.filter(terms, lambda t: F.getbit(t["parts"], k) == 1)
        name = F.xxhash64(F.transform(own, lambda t: t["term"])).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(F.size(own) > 0, F.lpad(F.lower(F.hex(name)), 8, "0")).otherwise(F.lit(""))

    return F.when(F.size(terms) > 0, F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), part)).otherwise(
        F.array(F.lower(F.hex(whole))))


def likeness(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when((x != "") & (x == y), 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    either = F.aggregate(F.zip_with(a, b, lambda x, y: F.when((x != "") | (y != ""), 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
    return F.when(F.size(a) == F.size(b), same / F.greatest(either, F.lit(1))).otherwise(F.lit(0.0))


def fingerprinted(texts: DataFrame, entries: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``keys`` and ``signatures`` of every row (``text``). The keys tell the rows apart; if the rows are dealt by some of them,
    nothing is shuffled (the lexicon is broadcast)."""
    terms = texts.withColumn("terms", term_hashes(F.coalesce("text", F.lit("")))).drop("text")
    terms = terms.withColumn("whole", F.xxhash64(F.array_sort("terms")))
    each = terms.select(*keys, "whole", F.explode(F.concat(F.array(F.lit(SELF).cast("long")), "terms")).alias("term"))
    known = entries.unionByName(entries.sparkSession.range(1).select(F.lit(SELF).cast("long").alias("term"), F.lit(0).cast("long").alias("parts")))
    if size <= BROADCAST_ENTRIES:
        known = F.broadcast(known)
    found = F.collect_list(F.when(F.col("parts") != 0, F.struct("term", "parts")))
    return (each.join(known, "term").groupBy(*keys, "whole").agg(F.sort_array(found).alias("found"))
            .select(*keys, signatures(F.col("found"), F.col("whole")).alias("signatures")))


def fitted_lexicon(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, int]:
    """The lexicon of all documents, written to the shared folder, and its size."""
    entries = stored(lexicon(docs, text_col, docs.count()), "lexicon")
    return entries, entries.count()


def fingerprint(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fingerprint`` (signatures joined by dots) of every row."""
    entries, size = fitted_lexicon(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    out = fingerprinted(rows, entries, ["id", "row"], size)
    return out.select(F.col("id").alias(id_col), F.array_join("signatures", ".").alias("fingerprint"))


def next_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``shard``, ``row`` (number in its shard), ``id``, ``text`` and ``next``: the text of the next row in order of id, the
    first after the last.

    Rows are dealt once, by ranges of id; a shard's last row gets the first text of the next shard from a table
    of one row a shard.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.coalesce("id", F.lit(-(1 << 63))))
    count = 2 * partitions(spark)
    cuts = rows.agg(F.percentile_approx("place", [k / count for k in range(1, count)], max(10_000, 100 * count))).first()[0] or []
    rows = rows.withColumn("shard", F.size(F.filter(F.lit(sorted(set(cuts)) or [0]), lambda c: c < F.col("place"))))
    order = Window.partitionBy("shard").orderBy("place", "text")
    firsts = rows.groupBy("shard").agg(F.min("place").alias("place"))  # one row a shard, of which there are ``count`` at most
    first_texts = rows.join(F.broadcast(firsts), ["shard", "place"]).groupBy("shard").agg(F.min("text").alias("first"))
    chain = Window.orderBy("shard")
    whole = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = first_texts.select("shard", F.coalesce(F.lead("first").over(chain), F.first("first").over(whole)).alias("after"))
    return (rows.select("shard", "id", "text", F.row_number().over(order).alias("row"), F.lead("text").over(order).alias("follows"))
            .join(after, "shard").select("shard", "row", "id", "text", F.coalesce("follows", "after").alias("next")))


def edit_test(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half of the code points (rounded down) replaced by the first as many of
    the next text. ``id_col``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` (likeness to the edited and to the next text)."""
    entries, size = fitted_lexicon(docs, text_col)
    half = F.floor(F.col("n") / 2).cast("int")
    pairs = next_texts(docs, id_col, text_col).withColumn("n", F.char_length("text"))
    pairs = pairs.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n") - half), F.substr("next", F.lit(1), half)))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("text"), s.alias("sha"))
                      for k, (c, s) in enumerate((("text", F.lit(None).cast("string")), ("edited", F.sha2(F.col("edited").cast("binary"), 256)),
                                                  ("next", F.lit(None).cast("string"))))))
    texts = pairs.select("shard", "row", "id", "n", F.explode(kinds).alias("x")).select("shard", "row", "id", "n", "x.kind", "x.sha", "x.text")
    found = fingerprinted(texts, entries, ["shard", "row", "kind", "id", "n", "sha"], size)
    of = lambda kind, c: F.first(F.when(F.col("kind") == kind, F.col(c)), ignorenulls=True)
    rows = found.groupBy("shard", "row", "id", "n").agg(
        of(1, "sha").alias("edited_sha256"), of(0, "signatures").alias("own"), of(1, "signatures").alias("edited"), of(2, "signatures").alias("following"))
    return rows.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        F.array_join("own", ".").alias("fingerprint"), F.array_join("edited", ".").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"))
