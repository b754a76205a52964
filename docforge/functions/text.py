"""Text analysis as native column expressions (TXT-1..7).

Chain order is fixed in one place (:func:`analyze_tokens`): tokenise,
lowercase, fold, stem. All steps are built-in Spark functions (regex
extraction, ``translate``, ``CASE``), so the analysis of a partition never
leaves the JVM and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docforge.functions import french, german, hungarian, porter, spanish
from docforge.functions.folding import fold
from docforge.functions.words import ASCII_PATTERN, SPARK_PATTERN
from docforge.session import spread
from docforge.spec import STEMMER_LANGUAGES, AnalyzerSpec

STEMMERS = {"english": porter, "french": french, "german": german, "hungarian": hungarian, "spanish": spanish}
#: Stages of the stemmer in one generated method: all of them in one exceed the JVM's limit of 8000 bytes for compiled
#: methods, and what exceeds it is interpreted. A stemmer of larger stages has its own number.
CODEGEN_STAGES = 4
MAX_PARTITIONS = (1 << 31) - 1


def token_array(col: Column, analyzer: AnalyzerSpec | None = None) -> Column:
    """Lower-cased (and, when configured, folded) word tokens as an array."""
    text = F.lower(col)
    plain = F.octet_length(text) == F.length(text)
    folded = fold(text) if analyzer is not None and analyzer.configured and analyzer.ascii_folding else text
    return (F.when(plain, F.regexp_extract_all(text, F.lit(ASCII_PATTERN), 0))
            .otherwise(F.regexp_extract_all(folded, F.lit(SPARK_PATTERN), 0)))


def check_language(analyzer: AnalyzerSpec) -> None:
    if analyzer.configured and analyzer.language not in STEMMER_LANGUAGES:
        raise NotImplementedError(f"no stemmer for language {analyzer.language!r}")


def stem_column(df: DataFrame, column: str = "token", only_if: str | None = None, language: str = "english") -> DataFrame:
    """Replace ``column`` by its stem: one projection per stage of the language's stemmer.

    ``only_if`` names a boolean column; rows where it is false keep their value.
    """
    keep = [f"`{c}`" for c in df.columns if c != column]
    module = STEMMERS[language]
    names = porter.state_names(module, "__")
    together = getattr(module, "CODEGEN_STAGES", CODEGEN_STAGES)
    w = names["w"]
    out = df.selectExpr(*keep, f"`{column}` AS __t0", f"`{column}` AS {w}", *[f"0 AS {c}" for c in names.values() if c != w])
    for n, stage in enumerate(module.stages(porter.SPARK, **names), 1):
        if n % together == 0:
            out = out.coalesce(MAX_PARTITIONS)  # changes no partition, but generated code ends here
        out = out.selectExpr(*keep, "__t0", *[f"{stage.get(c, c)} AS {c}" for c in names.values()])
    skip = "length(__t0) < 3" if language == "english" else "false"
    if only_if is not None:
        skip = f"{skip} OR NOT `{only_if}`"
    # The stem leaves through a one-element explode: a filter or join key on
    # the stemmed column then stops at the Generate instead of being pushed
    # down (and substituted) through every stage, which would copy each
    # stage's expression once per reference.
    return out.selectExpr(*keep, f"explode(array(CASE WHEN {skip} THEN __t0 ELSE {w} END)) AS `{column}`")


def analyze_tokens(df: DataFrame, key_cols: list[str], text_col: str,
                   analyzer: AnalyzerSpec | None = None) -> DataFrame:
    """Token table ``(keys..., position BIGINT, token STRING)``.

    No language: standard analysis only (tokenise + lowercase). With a
    language: lowercase, optional ASCII folding, then the stemmer.
    """
    analyzer = analyzer or AnalyzerSpec()
    check_language(analyzer)
    df = spread(df.select(*key_cols, text_col))
    exploded = df.select(*[F.col(k) for k in key_cols],
                         F.posexplode(token_array(F.col(text_col), analyzer)).alias("position", "token"))
    exploded = exploded.withColumn("position", F.col("position").cast("bigint"))
    if analyzer.configured:
        exploded = stem_column(exploded, "token", language=analyzer.language)
    return exploded
