"""Queries for text analysis (2.9 TXT-*): token tables over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docforge.functions import french, german, hungarian, spanish
from docforge.functions.porter import duckdb_stem_query
from docforge.functions.folding import fold, fold_sql
from docforge.functions.text import analyze_tokens
from docforge.functions.words import SPARK_PATTERN, words_sql
from docforge.operators.analysis import analyzed_fields
from docforge.plans.registry import query
from docforge.sources.tables import read_table
from docforge.spec import AnalyzerSpec, FieldSpec

ENGLISH = AnalyzerSpec("english")
ENGLISH_NO_FOLD = AnalyzerSpec("english", ascii_folding=False)


def _duck_tokens(table: str, keys: str, text_expr: str) -> str:
    return (f"SELECT {keys}, CAST(pos - 1 AS BIGINT) AS position, tok AS token FROM ("
            f"SELECT {keys}, unnest(toks) AS tok, unnest(generate_series(1, len(toks))) AS pos FROM ("
            f"SELECT {keys}, {words_sql(text_expr)} AS toks FROM {table}) a "
            f"WHERE len(toks) > 0) b")


@query("tokens", _duck_tokens("documents", "doc_id", "lower(text)"), ("TXT-1", "TXT-2", "TXT-7"))
def tokens_q(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return analyze_tokens(docs, ["doc_id"], "text", AnalyzerSpec())


def _folded_tokens(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(
        F.regexp_extract_all(fold(F.lower("text")), F.lit(SPARK_PATTERN), 0)).alias("position", "token")
    ).withColumn("position", F.col("position").cast("bigint"))


@query("tokens_folded", _duck_tokens("documents", "doc_id", fold_sql("lower(text)")), ("TXT-3",))
def tokens_folded_q(spark, sf_dir):
    return _folded_tokens(spark, sf_dir)


@query("tokens_stemmed",
       duckdb_stem_query(_duck_tokens("documents", "doc_id", fold_sql("lower(text)")), ["doc_id", "position"]),
       ("TXT-4", "TXT-5"))
def tokens_stemmed_q(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return analyze_tokens(docs, ["doc_id"], "text", ENGLISH)


_GERMAN_TOKENS = _duck_tokens("(SELECT * FROM documents WHERE lang = 'de')", "doc_id", "%s")


@query("tokens_stemmed_de", f"""
SELECT doc_id, position, 'folded' AS chain, token FROM ({duckdb_stem_query(
    _GERMAN_TOKENS % fold_sql("lower(text)"), ["doc_id", "position"], module=german, least=0)}) f
UNION ALL SELECT doc_id, position, 'plain', token FROM ({duckdb_stem_query(
    _GERMAN_TOKENS % "lower(text)", ["doc_id", "position"], module=german, least=0)}) p
""", ("TXT-4", "TXT-5"))
def tokens_stemmed_de_q(spark, sf_dir):
    # the language of the dataset chooses the stemmer; with folding umlauts are gone before it, without they are its own
    docs = read_table(spark, sf_dir, "documents").where("lang = 'de'")
    both = [analyze_tokens(docs, ["doc_id"], "text", AnalyzerSpec("german", ascii_folding=fold)).withColumn("chain", F.lit(name))
            for name, fold in (("folded", True), ("plain", False))]
    return both[0].unionByName(both[1]).select("doc_id", "position", "chain", "token")


_SPANISH_TOKENS = _duck_tokens("(SELECT * FROM documents WHERE lang = 'es')", "doc_id", "lower(text)")


@query("tokens_stemmed_es", duckdb_stem_query(_SPANISH_TOKENS, ["doc_id", "position"], module=spanish, least=0), ("TXT-4", "TXT-5"))
def tokens_stemmed_es_q(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").where("lang = 'es'")
    return analyze_tokens(docs, ["doc_id"], "text", AnalyzerSpec("spanish", ascii_folding=False))


_FRENCH_TOKENS = _duck_tokens("(SELECT * FROM documents WHERE lang = 'fr')", "doc_id", "lower(text)")


@query("tokens_stemmed_fr", duckdb_stem_query(_FRENCH_TOKENS, ["doc_id", "position"], module=french, least=0), ("TXT-4", "TXT-5"))
def tokens_stemmed_fr_q(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").where("lang = 'fr'")
    return analyze_tokens(docs, ["doc_id"], "text", AnalyzerSpec("french", ascii_folding=False))


# Endings that Hungarian joins to names, and the words of part names that get them (a name ends in one by its key)
_ENDINGS = ("ban", "nak", "ért", "k", "kal", "ként", "ja", "jaitok", "ánként", "át", "")
_ENDED = "CASE p_partkey % 11 " + " ".join(f"WHEN {n} THEN '{e}'" for n, e in enumerate(_ENDINGS)) + " END"
_HUNGARIAN_TEXT = f"replace(lower(p_name), ' ', {_ENDED} || ' ') || {_ENDED}"


@query("tokens_stemmed_hu", duckdb_stem_query(_duck_tokens("part", "p_partkey", _HUNGARIAN_TEXT), ["p_partkey", "position"], module=hungarian, least=0),
       ("TXT-4", "TXT-5"))
def tokens_stemmed_hu_q(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select("p_partkey", F.expr(_HUNGARIAN_TEXT).alias("text"))
    return analyze_tokens(part, ["p_partkey"], "text", AnalyzerSpec("hungarian", ascii_folding=False))


@query("analyzed_tokens",
       duckdb_stem_query(_duck_tokens("conversations", "conv_id, turn", "lower(text)"),
                         ["conv_id", "turn", "position"]),
       ("TXT-5", "UDF-3"))
def analyzed_tokens_q(spark, sf_dir):
    # chain with folding switched off: [lowercase, stemmer]
    conv = read_table(spark, sf_dir, "conversations")
    return analyze_tokens(conv, ["conv_id", "turn"], "text", ENGLISH_NO_FOLD)


PART_MAPPING = {
    "p_name": FieldSpec("text", has_keyword=True),
    "p_brand": FieldSpec("keyword"),
    "p_type": FieldSpec("keyword"),
    "p_size": FieldSpec("long"),
}

_PART_TEXT = duckdb_stem_query(_duck_tokens("part", "p_partkey", fold_sql("lower(p_name)")),
                               ["p_partkey", "position"])


@query("analyzed_fields", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id, 'p_name' AS field, position, token AS term FROM ({_PART_TEXT}) t
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_name.keyword', CAST(0 AS BIGINT), p_name FROM part WHERE p_name IS NOT NULL
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_brand', CAST(0 AS BIGINT), p_brand FROM part WHERE p_brand IS NOT NULL
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_type', CAST(0 AS BIGINT), p_type FROM part WHERE p_type IS NOT NULL
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'p_size', CAST(0 AS BIGINT), CAST(p_size AS VARCHAR) FROM part WHERE p_size IS NOT NULL
""", ("TXT-6",))
def analyzed_fields_q(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id")
    part = part.withColumn("id", F.col("id").cast("string"))
    return analyzed_fields(part, "id", PART_MAPPING, ENGLISH)


# ASCII letters -> a letter that folds back to them, of several Latin blocks; then pairs of letters -> ligatures
_MARKED = ("aeioudnylhtz", "ạễıợưđṇỳłħŧẕ")
_WIDE = ("bcfgjkmpqrsvwx", "ｂｃｆｇｊｋｍｐｑｒｓｖｗｘ")
_LIGATURES = (("ffi", "ﬃ"), ("fi", "ﬁ"), ("fl", "ﬂ"), ("ae", "ǽ"), ("oe", "œ"), ("th", "þ"), ("ss", "ß"), ("nj", "ǌ"), ("ij", "ĳ"))


@query("folded_forms", """
SELECT CAST(p_partkey AS VARCHAR) AS id, unnest(['marked', 'wide', 'ligatures', 'plain']) AS form, lower(p_name) AS folded FROM part
""", ("TXT-3",))
def folded_forms_q(spark, sf_dir):
    # names spelt with letters of other Latin blocks fold back to what they were
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.lower("p_name").alias("name"))
    tied = F.col("name")
    for plain, ligature in _LIGATURES:
        tied = F.replace(tied, F.lit(plain), F.lit(ligature))
    forms = {"marked": F.translate("name", *_MARKED), "wide": F.translate("name", *_WIDE), "ligatures": tied, "plain": F.col("name")}
    spelt = part.select("id", F.explode(F.array(*[F.struct(F.lit(k).alias("form"), v.alias("text")) for k, v in forms.items()])).alias("f"))
    return spelt.select("id", "f.form", fold(F.col("f.text")).alias("folded"))


_ODD_WORDS = ("{p}: 漢字かな {n},000 and 3.14; can't", "カタカナ{n} {p}_x _{n}_ ___", "{p}🙂👩‍👩‍👧 🇩🇪🇫🇷 ☺️", "été co­op {p}'s {n}.{n}.{n}", "ภาษาไทย한국어 {p}’s a:b 1:2", "")


@query("word_forms", _duck_tokens(f"""(SELECT p_partkey, CASE p_partkey % 7 {' '.join(
    f"WHEN {k} THEN replace(replace('{t.replace("'", "''")}', '{{p}}', p_name), '{{n}}', CAST(p_size AS VARCHAR))" for k, t in enumerate(_ODD_WORDS))}
    ELSE p_name END AS text FROM part)""", "p_partkey", "lower(text)"), ("TXT-1",))
def word_forms_q(spark, sf_dir):
    n, size = F.col("p_partkey") % 7, F.col("p_size").cast("string")
    text = F.coalesce(*[F.when(n == k, F.replace(F.replace(F.lit(t), F.lit("{p}"), F.col("p_name")), F.lit("{n}"), size))
                        for k, t in enumerate(_ODD_WORDS)], F.col("p_name"))
    return analyze_tokens(read_table(spark, sf_dir, "part").withColumn("text", text), ["p_partkey"], "text", AnalyzerSpec())
