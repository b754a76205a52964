"""Registered queries of the training-data operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docforge.llm import encode as encoding
from docforge.llm import ann, byte_bpe, extract, imatch, jaccard_join, langid, pack, repair, repeats, resample, rollup, whiten
from docforge.llm.common import stored, table
from docforge.session import scratch

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found of every vector whose id is divisible by 20."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and of the text decoded from them."""
    ids = encoding.encode(table(spark, sf_dir, "documents"), BYTE_BPE)
    return encoding.decode(ids, BYTE_BPE).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after four batches: every document comes in, the ones labelled toxic go, the remaining ones labelled as good are
    counted anew with another tokenizer, and the second batch is delivered again."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))

    def counted(tokenizer: str, version: str) -> DataFrame:
        # one narrow pass over the texts; what is joined afterwards are counts
        counts = encoding.encode(docs, tokenizer, keep=("doc_id", "source", "lang"), with_ids=False)
        return stored(counts.withColumn("tokenizer", F.lit(version)), "counts")

    old, new = counted(BYTE_BPE, "byte_bpe_50k"), counted(WORD_BPE, "word_bpe_49k")
    toxic = labels.where("toxic = 1").select("doc_id")
    good = labels.where("quality = 1 and toxic = 0").select("doc_id")
    path = scratch(spark, "rollup")
    gone = old.join(toxic, "doc_id", "left_semi")
    rollup.commit(rollup.inserts(old), path, 1)
    rollup.commit(rollup.deletes(gone), path, 2)
    rollup.commit(rollup.revisions(old.join(good, "doc_id", "left_semi"), new.join(good, "doc_id", "left_semi")), path, 3)
    rollup.commit(rollup.deletes(gone), path, 2)
    return rollup.totals(spark, path).select("source", "lang", "tokenizer", "n_docs", "n_tokens")


def op4_grouped_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of word triples and its class at a Jaccard similarity of 0.9 or more."""
    return jaccard_join.classes(table(spark, sf_dir, "documents"), size=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op5_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.fit(docs.where(~F.coalesce(held_out, F.lit(True))))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its half-edited text."""
    return imatch.edit_test(table(spark, sf_dir, "documents"))


def op8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, count and checksum of every document's ids, read back from Re-Pair files."""
    path = scratch(spark, "repair")
    repair.write(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=1)
    docs = repair.read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return docs.join(repair.block_starts(spark, path), ["shard", "block"]).select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op9_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens along the curve."""
    pieces = pack.pack(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=1, length=2048)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 50-byte strings of earlier ones."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"), width=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark's distribution, with exact ranks."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def _crc_steps() -> str:
    """The checksum's table of 256 entries from its rule, one bit a step."""
    steps = ["c0 AS (SELECT range AS b, range AS c FROM range(256))"]
    steps += [f"c{k} AS (SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM c{k - 1})" for k in range(1, 9)]
    return ", ".join(steps) + ", crc AS (SELECT list(c ORDER BY b) AS entry FROM c8)"


def _sql_features(name: str, source: str) -> str:
    """CTEs: the words of every row of ``source``, and its features."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (f"{name}_words AS (SELECT *, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {source}), "
            f"{name}_f AS (SELECT nth, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM {name}_words)")


OP11_SQL = f"""
WITH {_crc_steps()},
{_sql_features("d", "(SELECT row_number() OVER () AS nth, doc_id, text FROM documents)")},
{_sql_features("b", "(SELECT row_number() OVER () AS nth, text FROM benchmark)")},
counted AS (SELECT f, sum(s) AS s, sum(t) AS t FROM (SELECT f, 1 AS s, 0 AS t FROM d_f UNION ALL SELECT f, 0, 1 FROM b_f) GROUP BY f),
spelled AS (SELECT f, s, t, hex(encode(f)) AS h FROM counted),
hashed AS (SELECT f, s, t, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h) // 2 + 1),
    lambda i: 16 * (strpos('0123456789ABCDEF', h[2 * i - 1]) - 1) + strpos('0123456789ABCDEF', h[2 * i]) - 1)),
    lambda a, x: xor(a >> 8, entry[(xor(a, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM spelled, crc),
sizes AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket),
whole AS (SELECT sum(s) AS sa, sum(t) AS ta FROM sizes),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sa + 10000) AS DOUBLE) / CAST((s + 1) * (ta + 10000) AS DOUBLE))) AS BIGINT) AS g
         FROM sizes, whole),
sums AS (SELECT nth, count(*) AS n_features, sum(g) AS total FROM d_f JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY nth),
weighed AS (SELECT doc_id, nth, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
                   coalesce(CAST(floor(CAST(total AS DOUBLE) / n_features) AS BIGINT), 0) AS weight
            FROM d_words LEFT JOIN sums USING (nth)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT)
                  AS score FROM weighed),
able AS (SELECT nth, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN place <= 25 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM scored LEFT JOIN able USING (nth)
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight leading whitened components of every usable vector."""
    return whiten.whiten(table(spark, sf_dir, "embeddings"), components_wanted=8)


def op13_tiktoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids by the rank file and of the bytes decoded from them."""
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(ids, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_hilbert_ann": (op1_hilbert_ann, None),
    "op2_bpe": (op2_bpe, None),
    "op3_rollup": (op3_rollup, None),
    "op4_grouped_prefix": (op4_grouped_prefix, None),
    "op5_line_blocks": (op5_line_blocks, None),
    "op6_ecoc": (op6_ecoc, None),
    "op9_hilbert_packing": (op9_hilbert_packing, None),
    "op10_difference_cover": (op10_difference_cover, None),
    "op7_imatch": (op7_imatch, None),
    "op8_repair": (op8_repair, None),
    "op11_importance": (op11_importance, OP11_SQL),
    "op12_whitening": (op12_whitening, None),
    "op13_tiktoken": (op13_tiktoken, None),
}
