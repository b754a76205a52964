"""Nearest neighbours: exact on small tables, recall against brute force on a larger one."""

import numpy as np
from pyspark.sql import functions as F

from docforge.llm import ann
from docforge.llm.queries import op1_hilbert_ann

INF = float("inf")


def brute(rows, k, asks):
    good = [(i, np.asarray(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) == 2 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, x in good:
        if asks(q):
            best = sorted((-float(x @ y), i) for i, y in good if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.integers(-3, 4, 2).astype(float).tolist()) for k in range(150)]
    rows += [(200, None), (201, [0.0, 0.0]), (202, [None, 1.0]), (203, [INF, 1.0]), (204, [float("nan"), 1.0]), (205, [1.0]), (None, [1.0, 1.0]),
             (206, [-0.0, 2.0]), (207, [0.0, 2.0])]
    rows += rows[:3] + rows[3:4] * 20
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit("x")).repartition(4)
    got = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id") % 3 == 0, k=7).collect())
    want = brute(dict(rows).items(), 7, lambda i: i % 3 == 0)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want])


def test_few_candidates_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0])], "vec_id int, embedding array<float>")
    assert [tuple(r) for r in ann.nearest(df, F.col("vec_id") == 0, k=5).collect()] == [(0, 1, 1, 0.5)]
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(df, F.col("vec_id") == 9).count() == 0


def test_a_vector_that_most_rows_have(spark):
    rows = [(k, [1.0, 2.0]) for k in range(400)] + [(1000 + k, [1.0, float(k)]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id").isin(0, 7, 1039), k=5).collect())
    want = brute(rows, 5, lambda i: i in (0, 7, 1039))
    assert [r[:3] for r in got] == [r[:3] for r in want]


def recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    got = op1_hilbert_ann(spark, sf).toPandas()
    hits = total = 0
    for q, part in got.groupby("query_id"):
        row = int(np.flatnonzero(ids == q)[0])
        score = x @ x[row]
        score[row] = -INF
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(1, 21))
        assert np.allclose(score[np.searchsorted(ids, part.vec_id)], part.score, rtol=1e-12)
        best = ids[np.lexsort((ids, -score))[:20]]
        hits += len(set(best) & set(part.vec_id))
        total += 20
    assert total == 20 * (ids % 20 == 0).sum()
    return hits / total


def test_recall(spark):
    assert recall(spark, "/root/testdata/sf0.001") == 1.0
    assert recall(spark, "/root/testdata/sf0.1") >= 0.9


def test_recall_of_longer_vectors(spark):
    """Lengths differ: the largest inner product isn't the smallest angle."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6000, 16)) * rng.lognormal(0, 0.4, (6000, 1))
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = ann.nearest(df, F.col("vec_id") < 100, k=10).toPandas()
    hits = 0
    for q, part in got.groupby("query_id"):
        score = x @ x[q]
        score[q] = -INF
        hits += len(set(np.argsort(-score)[:10]) & set(part.vec_id))
    assert hits / 1000 >= 0.9
