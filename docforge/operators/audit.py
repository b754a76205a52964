"""Set-based audit of a fleet of datasets (2.10, 2.5 JON-1/4/5/6, 2.6 AGG-2..4/8..10, 2.8).

The "actual" side of every dataset is measured by scanning its documents
(fields present, observed type, counts) -- one partially-aggregated pass per
dataset -- and all datasets are audited together in one DataFrame. The
metadata inputs (datasets, declared mapping, indexes, settings) are small
configuration tables; they are joined, never looped over on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Check order of one report.
CHECK_ORDER = ["alias", "analysis", "dynamic", "drift", "fields", "paging"]
CHECK_LABELS = {"alias": "Alias", "analysis": "Analyzers", "dynamic": "Dynamic mapping", "drift": "Schema drift",
                "fields": "Field count", "paging": "Deep paging", "index": "Index"}
CHECK_ISSUES = {"alias": 1, "analysis": 2, "dynamic": 2, "drift": 9, "fields": 2, "paging": 7}
ATOM_TEXT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d[+-]\d\d:\d\d$"
ANALYZER_KEY = r"^index\.analysis\.analyzer\.([^.]+)\."


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a configuration-sized side. Every audit input is bounded by
    configuration (datasets, indexes, settings, declared fields) or by schema
    width (one stats row per source column), never by row counts, so these
    joins need no shuffle."""
    return F.broadcast(df)


def spark_kind(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integral"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "fractional"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "timestamp"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.ArrayType):
        return spark_kind(dtype.elementType)
    return "object"


# ------------------------------------------------------------------ aliases
def alias_resolution(indexes: DataFrame) -> DataFrame:
    """AGG-9: invert index -> aliases into alias -> index; the last index in
    listing order wins."""
    exploded = indexes.select("position", "index", F.explode("aliases").alias("alias"))
    return exploded.groupBy("alias").agg(F.max_by("index", "position").alias("index"))


def live_indexes(datasets: DataFrame, indexes: DataFrame) -> DataFrame:
    """JON-6: dataset -> live index by alias, else a concrete index with the
    dataset's own name; ``index`` falls back to the code when none exists."""
    by_alias = alias_resolution(indexes).select(F.col("alias").alias("code"), F.col("index").alias("by_alias"))
    by_name = indexes.select(F.col("index").alias("code"), F.col("index").alias("by_name"))
    joined = datasets.select("code").join(_small(by_alias), "code", "left").join(_small(by_name), "code", "left")
    live = F.coalesce("by_alias", "by_name")
    return joined.select("code", F.coalesce(live, F.col("code")).alias("index"), live.isNotNull().alias("exists"))


# ------------------------------------------------------------------ observed
def field_stats(frames: dict[str, DataFrame], skip: tuple[str, ...] = ()) -> DataFrame:
    """One partially-aggregated pass per frame: ``(key, field, kind, present)``
    where ``present`` = non-null rows of the column and the row
    ``field = '*'`` carries the frame's row count. The union of all frames
    runs as one plan; the result has one row per column."""
    parts = []
    for key, df in frames.items():
        fields = [f for f in df.schema.fields if f.name not in skip]
        # built documents hold date-times as ATOM text; a field of nothing else is a date
        dated = [F.count_if(F.col(f"`{f.name}`").rlike(ATOM_TEXT)).alias(f"d{i}")
                 for i, f in enumerate(fields) if isinstance(f.dataType, T.StringType)]
        agg = df.agg(F.count(F.lit(1)).alias("n"),
                     *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)], *dated)
        entries = [F.struct(F.lit("*").alias("field"), F.lit(None).cast("string").alias("kind"),
                            F.col("n").alias("present"))]
        for i, f in enumerate(fields):
            kind = F.lit(spark_kind(f.dataType))
            if isinstance(f.dataType, T.StringType):
                kind = F.when((F.col(f"c{i}") > 0) & (F.col(f"d{i}") == F.col(f"c{i}")), "timestamp").otherwise(kind)
            entries.append(F.struct(F.lit(f.name).alias("field"), kind.alias("kind"), F.col(f"c{i}").alias("present")))
        parts.append(agg.select(F.lit(key).alias("key"), F.explode(F.array(*entries)).alias("s"))
                     .select("key", "s.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed_from_stats(stats: DataFrame, declared: DataFrame) -> DataFrame:
    """Fields present in each dataset's documents with their mapped type.

    ``stats`` is ``(code, field, kind, present_docs)``. The actual type is the
    declared type where it fits the observed data, else what dynamic mapping
    would infer; object-valued fields have no type.
    """
    observed = stats.where(F.col("present_docs") > 0)
    d = declared.select("code", "field", F.col("type").alias("d_type"), F.col("has_keyword").alias("d_kw"))
    j = observed.join(_small(d), ["code", "field"], "left")
    kind, dt = F.col("kind"), F.col("d_type")
    fits = (((kind == "string") & dt.isin("text", "keyword")) | ((kind == "integral") & dt.isin("long", "integer"))
            | ((kind == "fractional") & dt.isin("float", "double")) | ((kind == "timestamp") & (dt == "date"))
            | ((kind == "boolean") & (dt == "boolean")))
    inferred = (F.when(kind == "string", "text").when(kind == "integral", "long").when(kind == "fractional", "float")
                .when(kind == "timestamp", "date").when(kind == "boolean", "boolean"))
    actual = F.when(kind == "object", F.lit(None).cast("string")).when(F.coalesce(fits, F.lit(False)), dt) \
        .otherwise(inferred)
    has_kw = F.when(F.coalesce(fits, F.lit(False)), F.coalesce(F.col("d_kw"), F.lit(False))) \
        .otherwise(kind == "string")
    return j.select("code", "field", actual.alias("actual_type"), has_kw.alias("has_keyword"), "present_docs")


def observed_fields(docs_by_code: dict[str, DataFrame], declared: DataFrame, id_col: str = "id") -> DataFrame:
    """Observed mapping of document tables given directly (one pass each)."""
    stats = field_stats(docs_by_code, skip=(id_col,)).where(F.col("field") != "*")
    return observed_from_stats(stats.withColumnRenamed("key", "code").withColumnRenamed("present", "present_docs"),
                               declared)


# ------------------------------------------------------------------ comparison
def field_comparison(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """RPT-9 / JON-1 / SCL-4: every field declared or present, both types, status."""
    d = declared.select("code", "field", F.col("type").alias("declared"))
    a = actual.select("code", "field", F.col("actual_type").alias("actual"))
    j = d.join(a, ["code", "field"], "full_outer")
    status = (F.when(F.col("actual").isNull(), "missing").when(F.col("declared").isNull(), "undeclared")
              .when(F.col("declared") != F.col("actual"), "mismatch").otherwise("ok"))
    return j.select("code", "field", "declared", "actual", status.alias("status"))


def _outer(declared: DataFrame, actual: DataFrame) -> DataFrame:
    d = declared.select("code", "field", F.col("type").alias("declared"), F.lit(True).alias("in_declared"))
    a = actual.select("code", "field", F.col("actual_type").alias("actual"), F.lit(True).alias("in_actual"))
    return d.join(a, ["code", "field"], "full_outer")


def _drift_kind() -> Column:
    return (F.when(F.col("in_actual").isNull(), "missing").when(F.col("in_declared").isNull(), "unexpected")
            .when(F.col("declared").isNotNull() & F.col("actual").isNotNull() & (F.col("declared") != F.col("actual")),
                  "retyped"))


def drift_sets(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """SET-2/SET-3: missing (declared minus present keys), unexpected (present
    minus declared), retyped (both typed and different), from ONE full outer
    join. A present field without a type counts as present here."""
    j = _outer(declared, actual).withColumn("kind", _drift_kind())
    return j.where(F.col("kind").isNotNull()).select("code", "kind", "field", "declared", "actual")


# ------------------------------------------------------------------ checks
def _sorted_join(col: Column, sep: str = ", ") -> Column:
    return F.array_join(F.array_sort(F.collect_list(col)), sep)


def schema_audit(datasets: DataFrame, live: DataFrame, indexes: DataFrame, settings: DataFrame,
                 declared: DataFrame, actual: DataFrame, counts: DataFrame,
                 default_window: int = 10000, default_field_limit: int = 1000,
                 stemmer_setting: str = "index.analysis.filter.docforge_stemmer.language") -> DataFrame:
    """RPT-1..8: long-form checks ``(code, position, check_id, label, status, detail, issue)``.

    A dataset whose index does not exist gets exactly one ``na`` row.
    """
    idx = live.join(_small(indexes.select("index", "aliases")), "index", "left") \
        .join(_small(counts.select("index", "docs")), "index", "left")
    s = settings.groupBy("index").agg(
        F.max(F.when(F.col("key") == stemmer_setting, F.col("value"))).alias("indexed_language"),
        F.max(F.when(F.col("key") == "index.max_result_window", F.col("value"))).alias("window"),
        F.max(F.when(F.col("key") == "index.mapping.total_fields.limit", F.col("value"))).alias("field_limit"))
    # distinct analyzer names (AGG-10)
    names = (settings.where(F.col("key").rlike(ANALYZER_KEY))
             .select("index", F.regexp_extract("key", ANALYZER_KEY, 1).alias("name")).distinct()
             .groupBy("index").agg(_sorted_join(F.col("name")).alias("analyzers")))
    # drift lists and both field counts from one full outer join + one aggregate
    kind = _drift_kind()
    drift_summary = _outer(declared, actual).groupBy("code").agg(
        _sorted_join(F.when(kind == "retyped", F.concat(
            F.col("field"), F.lit(" (declared "), F.col("declared"), F.lit(", actual "), F.col("actual"),
            F.lit(")")))).alias("retyped"),
        _sorted_join(F.when(kind == "missing", F.col("field"))).alias("missing"),
        _sorted_join(F.when(kind == "unexpected", F.col("field"))).alias("unexpected"),
        F.count("in_declared").alias("n_declared"), F.count("in_actual").alias("n_actual"))
    base = (datasets.select("code", F.nullif(F.col("language"), F.lit("")).alias("wanted"), "dynamic")
            .join(_small(idx), "code").join(_small(s), "index", "left").join(_small(names), "index", "left")
            .join(_small(drift_summary), "code", "left"))

    aliases = F.coalesce(F.col("aliases"), F.array().cast("array<string>"))
    alias_ok = F.size(aliases) > 0
    alias_row = F.struct(F.lit("alias").alias("check_id"), F.when(alias_ok, "ok").otherwise("warn").alias("status"),
                         F.when(alias_ok, F.concat(F.lit("served through "), F.array_join(aliases, ", ")))
                         .otherwise(F.lit("addressed directly, no alias")).alias("detail"))

    wanted, indexed = F.col("wanted"), F.col("indexed_language")
    lang_drift = wanted.isNotNull() & ~wanted.eqNullSafe(indexed)
    has_analyzers = F.coalesce(F.length("analyzers"), F.lit(0)) > 0
    analysis_status = F.when(lang_drift, "warn").when(has_analyzers, "ok").otherwise("warn")
    analysis_detail = (F.when(lang_drift, F.concat(F.lit("configured for "), wanted, F.lit(" but built with "),
                                                   F.coalesce(indexed, F.lit("no custom analyzer"))))
                       .when(has_analyzers, F.concat(F.lit("custom analyzer: "), F.col("analyzers"),
                                                     F.coalesce(F.concat(F.lit(" ("), indexed, F.lit(" stemming)")),
                                                                F.lit(""))))
                       .otherwise(F.lit("default analyzer only")))
    analysis_row = F.struct(F.lit("analysis").alias("check_id"), analysis_status.alias("status"),
                            analysis_detail.alias("detail"))

    dyn = F.coalesce(F.lower(F.col("dynamic")), F.lit("true"))
    dynamic_row = F.struct(F.lit("dynamic").alias("check_id"),
                           F.when(dyn.isin("strict", "false"), "ok").otherwise("warn").alias("status"),
                           F.concat(F.lit("dynamic: "), dyn).alias("detail"))

    parts = F.array_compact(F.array(
        F.when(F.length("retyped") > 0, F.concat(F.lit("type mismatch on "), F.col("retyped"))),
        F.when(F.length("missing") > 0, F.concat(F.lit("declared but absent: "), F.col("missing"))),
        F.when(F.length("unexpected") > 0, F.concat(F.lit("present but never declared: "), F.col("unexpected")))))
    n_decl = F.coalesce(F.col("n_declared"), F.lit(0))
    drift_row = F.struct(F.lit("drift").alias("check_id"),
                         F.when(F.size(parts) == 0, "ok").otherwise("warn").alias("status"),
                         F.when(F.size(parts) == 0, F.concat(n_decl.cast("string"), F.lit(" declared fields, all present")))
                         .otherwise(F.array_join(parts, "; ")).alias("detail"))

    limit = F.coalesce(F.col("field_limit").cast("bigint"), F.lit(default_field_limit).cast("bigint"))
    n_act = F.coalesce(F.col("n_actual"), F.lit(0)).cast("bigint")
    fields_row = F.struct(F.lit("fields").alias("check_id"),
                          F.when(n_act >= F.floor(limit * F.lit(0.8)), "warn").otherwise("ok").alias("status"),
                          F.concat(n_act.cast("string"), F.lit(" of "), limit.cast("string"),
                                   F.lit(" mapped fields used")).alias("detail"))

    window = F.coalesce(F.col("window").cast("bigint"), F.lit(default_window).cast("bigint"))
    docs = F.coalesce(F.col("docs"), F.lit(0)).cast("bigint")
    paging_row = F.struct(F.lit("paging").alias("check_id"),
                          F.when(docs <= window, "ok").otherwise("warn").alias("status"),
                          F.concat(F.format_number(docs, 0), F.lit(" documents, window "),
                                   F.format_number(window, 0)).alias("detail"))

    na_row = F.struct(F.lit("index").alias("check_id"), F.lit("na").alias("status"),
                      F.lit("not created yet").alias("detail"))
    checks = F.when(F.col("exists"), F.array(alias_row, analysis_row, dynamic_row, drift_row, fields_row, paging_row)) \
        .otherwise(F.array(na_row))
    out = base.select("code", F.posexplode(checks).alias("pos", "c"))
    label = F.create_map(*[x for k, v in CHECK_LABELS.items() for x in (F.lit(k), F.lit(v))])
    issue = F.create_map(*[x for k, v in CHECK_ISSUES.items() for x in (F.lit(k), F.lit(v))])
    return out.select("code", (F.col("pos") + 1).cast("bigint").alias("position"), F.col("c.check_id").alias("check_id"),
                      label[F.col("c.check_id")].alias("label"), F.col("c.status").alias("status"),
                      F.col("c.detail").alias("detail"),
                      F.when(F.col("c.status") == "warn", issue[F.col("c.check_id")]).cast("bigint").alias("issue"))


# ------------------------------------------------------------------ intents
def field_intents(intents: DataFrame, facet_fields: DataFrame, search_fields: DataFrame, sort_fields: DataFrame,
                  actual: DataFrame, live: DataFrame) -> DataFrame:
    """RPT-10 / JON-5 / SCL-1..3 / FLT-9: trace each declared intent through
    the adapter parameters into the live mapping; first broken hop wins."""
    f = facet_fields.select("code", "name", F.col("target").alias("facet_field"), F.lit(True).alias("in_facet"))
    se = search_fields.select("code", "name", F.lit(True).alias("in_search")).distinct()
    so = sort_fields.select("code", "name", F.lit(True).alias("in_sort")).distinct()
    a = actual.select("code", F.col("field").alias("name"),
                      F.when((F.col("actual_type") == "text") & F.col("has_keyword"), F.lit("text + .keyword"))
                      .otherwise(F.col("actual_type")).alias("actual_type"))
    j = (intents.join(_small(f), ["code", "name"], "left").join(_small(se), ["code", "name"], "left")
         .join(_small(so), ["code", "name"], "left").join(_small(a), ["code", "name"], "left")
         .join(_small(live.select("code", F.col("exists").alias("index_exists"))), "code", "left"))
    in_facet = F.coalesce("in_facet", F.lit(False))
    in_search = F.coalesce("in_search", F.lit(False))
    in_sort = F.coalesce("in_sort", F.lit(False))
    wants_facet = F.col("facet") | F.col("filterable")
    atype = F.col("actual_type")
    aggregatable = atype.isNotNull() & (atype != "text")
    problem = (F.when(wants_facet & ~in_facet, "facet dropped before facetFields")
               .when(F.col("searchable") & ~in_search, "searchable but not in searchFields")
               .when(F.col("sortable") & ~in_sort, "sortable but not in sortFields")
               .when(~F.coalesce("index_exists", F.lit(False)), F.lit(None))
               .when((in_facet | in_search | in_sort) & atype.isNull(), "used but not mapped; needs a rebuild")
               .when(in_facet & ~aggregatable, F.concat(F.lit("faceted on a "), atype, F.lit(" field"))))
    wanted = wants_facet | F.col("searchable") | F.col("sortable")
    return (j.where(wanted | atype.isNotNull())
            .select("code", "name", wants_facet.alias("wants_facet"), F.col("searchable").alias("wants_searchable"),
                    F.col("sortable").alias("wants_sortable"), in_facet.alias("in_facet_fields"),
                    in_search.alias("in_search_fields"), in_sort.alias("in_sort_fields"), "facet_field",
                    atype.alias("actual_type"), aggregatable.alias("aggregatable"), problem.alias("problem")))


def problems_only(intents: DataFrame) -> DataFrame:
    """FLT-10: traced intents with a broken hop."""
    return intents.where(F.col("problem").isNotNull())


def unclaimed_only(inventory: DataFrame) -> DataFrame:
    """FLT-10: visible indexes that no dataset claims."""
    return inventory.where(F.col("claimed_by").isNull())


# ------------------------------------------------------------------ fleet
def like_pattern(pattern: str) -> str:
    """A name pattern in which only ``*`` is special, as a LIKE pattern (escape character ``\\``)."""
    for special in ("\\", "%", "_"):
        pattern = pattern.replace(special, "\\" + special)
    return pattern.replace("*", "%")


def fleet_inventory(indexes: DataFrame, counts: DataFrame, datasets: DataFrame, pattern: str = "*") -> DataFrame:
    """RPT-11 / JON-4 / FLT-7: visible indexes matching ``pattern`` with the
    dataset that claims each (own name first, then the first alias, in alias
    order, that names a dataset), or null when unclaimed."""
    visible = indexes.where(~F.col("index").startswith(".") & F.col("index").like(like_pattern(pattern)))
    codes = datasets.select(F.col("code"))
    by_name = codes.select(F.col("code").alias("index"), F.col("code").alias("by_name"))
    by_alias = (visible.select("index", F.posexplode("aliases").alias("apos", "code")).join(_small(codes), "code")
                .groupBy("index").agg(F.min_by("code", "apos").alias("by_alias")))
    return (visible.join(_small(counts.select("index", "docs")), "index", "left")
            .join(_small(by_name), "index", "left").join(_small(by_alias), "index", "left")
            .select("index", F.coalesce("docs", F.lit(0)).alias("docs"),
                    F.array_join("aliases", ",").alias("aliases"),
                    F.coalesce("by_name", "by_alias").alias("claimed_by")))


def pattern_misses(indexes: DataFrame, pattern: str) -> DataFrame:
    """RPT-12: visible indexes the pattern matches, and -- when it matches none
    and is not ``*`` -- the count of all visible indexes (what was missed)."""
    visible = indexes.where(~F.col("index").startswith("."))
    matched = F.count(F.when(F.col("index").like(like_pattern(pattern)), 1))
    return visible.agg(
        matched.alias("matched"),
        F.when((matched == 0) & F.lit(pattern != "*"), F.count("*")).otherwise(F.lit(0)).cast("bigint")
        .alias("missed"))


def dataset_status(live: DataFrame, counts: DataFrame, actual: DataFrame) -> DataFrame:
    """AGG-2/AGG-3 / QRY-4: code, index, exists, documents, mapped fields."""
    n_fields = actual.groupBy("code").agg(F.count("*").alias("mapped_fields"))
    return (live.join(_small(counts.select("index", "docs")), "index", "left").join(_small(n_fields), "code", "left")
            .select("code", "index", "exists",
                    F.when(F.col("exists"), F.coalesce("docs", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
                    .alias("documents"),
                    F.when(F.col("exists"), F.coalesce("mapped_fields", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
                    .alias("mapped_fields")))


def dataset_report(datasets: DataFrame, status: DataFrame, indexes: DataFrame, checks: DataFrame) -> DataFrame:
    """RPT-8 / AGG-4 / SCL-10: one row per dataset with its checks folded in order."""
    folded = checks.groupBy("code").agg(
        F.count_if(F.col("status") == "warn").cast("bigint").alias("warnings"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "check_id", "status"))),
                                 lambda c: F.concat(c["check_id"], F.lit(":"), c["status"])), ",").alias("checks"))
    source = F.when(F.col("has_provider"), "provider").when(F.col("source_table").isNotNull(), "table") \
        .otherwise("none")
    al = indexes.select("index", F.array_join("aliases", ",").alias("aliases"))
    return (datasets.select("code", "entity", "has_provider", "source_table")
            .join(_small(status), "code").join(_small(al), "index", "left").join(_small(folded), "code", "left")
            .select("code", "entity", "index", "exists", "documents",
                    F.when(F.col("exists"), F.coalesce("aliases", F.lit(""))).otherwise(F.lit("")).alias("aliases"),
                    F.coalesce("warnings", F.lit(0)).cast("bigint").alias("warnings"),
                    source.alias("document_source"), "checks"))


def select_datasets(datasets: DataFrame, selector: str | None = None) -> DataFrame:
    """FLT-8: datasets whose code **or** name (short entity class) equals the
    selector; ``None`` selects all."""
    if selector is None:
        return datasets
    short = F.regexp_extract(F.col("entity"), r"([^\\]+)$", 1)
    return datasets.where((F.col("code") == selector) | (short == selector))
