"""Every registered query against its DuckDB twin on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck_connection  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
# queries that SQL can't express have brute-force tests of their own
QUERIES = {name: fn for name, fn in entry.queries().items() if name in SQL}


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


def test_every_query_has_operators_and_most_have_sql():
    from docforge.plans import load_all
    reg = load_all()
    assert all(q.ops for q in reg.values())
    assert set(reg) <= set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, QUERIES[name], SQL.get(name), SF)
    assert res["status"] in ("ok", "rows-only"), res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["doc_id", "position", "token"]
