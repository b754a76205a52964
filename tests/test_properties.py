"""Randomised equivalence checks (seeded, bounded size)."""

import random

import duckdb
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docforge.functions.porter import duckdb_stem_query
from docforge.functions.text import stem_column
from docforge.operators import sync


def _words(n, seed):
    rnd = random.Random(seed)
    letters = "aeiouybcdfghjklmnprstvwxz"
    suffixes = ["", "s", "es", "ies", "ed", "ing", "ational", "ization", "ness", "ful", "ement", "ly", "e", "ll",
                "ion", "tion", "ible", "ous", "ive", "ize", "iti", "bli", "logi", "eed", "y"]
    out = set()
    while len(out) < n:
        stem = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8)))
        out.add(stem + rnd.choice(suffixes))
    return sorted(out)


def test_stemmer_spark_equals_duckdb_on_random_words(spark):
    words = _words(3000, 7)
    got = {r["w"]: r["token"] for r in
           stem_column(spark.createDataFrame([(w, w) for w in words], "w string, token string"), "token").collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($1) AS w", [words])
    rows = con.execute(duckdb_stem_query("SELECT w, w AS token FROM t", ["w"])).fetchall()
    want = dict(rows)
    assert got == want


def test_numbering_equals_row_number_on_random_groups(spark):
    rnd = random.Random(11)
    rows = []
    for g in range(12):
        size = rnd.choice([1, 2, 5, 40, 400, 2500])
        rows += [(g % 3, f"e{g}", f"{rnd.randrange(10**6):07d}-{i}") for i in range(size)]
    df = spark.createDataFrame(rows, "flush int, entity string, id string")
    got = sync.number_within_groups(df, ["flush", "entity"], "id", partitions=5)
    want = df.withColumn("rank", (F.row_number().over(Window.partitionBy("flush", "entity").orderBy("id")) - 1)
                         .cast("bigint"))
    cols = ["flush", "entity", "id", "rank"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_hot_id_is_combined_before_the_shuffle(spark):
    # one id holds a third of all change rows: the reduction must be partial
    # (map-side) so the hot id never reaches one reducer as raw rows
    rows = [(1, "E", ["hot"], "update")] * 3000 + [(1, "E", [str(i)], "update") for i in range(6000)]
    changes = spark.createDataFrame(rows, "flush int, entity string, key array<string>, op string")
    rec = sync.reconcile_flushes(sync.scalar_ids(changes))
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    final = sync.final_state(rec)
    assert "partial_max_by" in final._jdf.queryExecution().executedPlan().toString()
    assert final.count() == 6001
