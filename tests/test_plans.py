"""Plan invariants of the data-heavy queries (checked on the smallest tables)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from show_plans import summarise  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["tokens_stemmed", "analyzed_fields", "flush_reconcile", "reconcile_counts",
                                  "match_stemmed", "facet_terms", "call_summary", "strict_rejects"])
def test_no_python_udf_no_cartesian(spark, name):
    s = summarise(entry.queries()[name](spark, SF))
    assert s["python_udfs"] == 0
    assert not {"BroadcastNestedLoopJoin", "CartesianProduct"} & set(s["joins"])


def test_narrow_queries_do_not_shuffle(spark):
    for name in ["build_documents", "strict_rejects", "normalize_orders", "mapped_documents"]:
        assert summarise(entry.queries()[name](spark, SF))["shuffles"] == 0, name


def test_scan_reads_only_needed_columns(spark):
    s = summarise(entry.queries()["facet_terms"](spark, SF))
    assert s["read_schemas"] == ["struct<p_brand:string,p_type:string>"]


def test_generated_methods_stay_below_the_jit_limit(spark):
    """Methods of more than 8000 bytes are interpreted; the stemmers' chains are split so that none is."""
    from docforge.functions.text import STEMMERS, stem_column

    for language in STEMMERS:
        df = stem_column(spark.createDataFrame([("w", "w")], "w string, token string"), "token", language=language)
        code = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [code.apply(k)._3().maxMethodCodeSize() for k in range(code.size())]
        assert sizes and max(sizes) < 8000, (language, sizes)


def test_package_never_counts_partitions_through_an_rdd():
    import pathlib

    import docforge

    for path in pathlib.Path(docforge.__file__).parent.rglob("*.py"):
        assert ".rdd" not in path.read_text(), path
