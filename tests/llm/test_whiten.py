"""Rank-one updates against a dense solver; whitening against numpy on all rows."""

import math

import numpy as np
import pytest

from docforge.llm import whiten
from docforge.llm.queries import op12_whitening
from docforge.llm.spectrum import Spectrum, rank_one, secular_roots

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("size", [1, 2, 3, 8, 40])
def test_rank_one_updates(size):
    rng = np.random.default_rng(size)
    whole, values, vectors = np.zeros((size, size)), np.zeros(size), np.eye(size)
    for k in range(200):
        v = rng.normal(size=size) * rng.choice([1, 100, 1e-6])
        if k % 7 == 0:
            v[rng.integers(size)] = 0
        if k % 11 == 0:  # equal poles, single coordinates
            v = 3 * np.eye(size)[rng.integers(size)]
        values, vectors = rank_one(values, vectors, v)
        whole += np.outer(v, v)
        assert np.all(np.diff(values) >= 0)
    assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-13)
    assert np.abs(vectors * values @ vectors.T - whole).max() <= 1e-13 * values[-1]
    assert np.abs(values - np.linalg.eigvalsh(whole)).max() <= 1e-13 * values[-1]


def test_secular_roots_interlace():
    rng = np.random.default_rng(1)
    for gap in (1.0, 1e-6, 1e-12):
        d = np.sort(np.concatenate([[1.0, 1.0 + gap], 2 + rng.random(10)]))
        z2 = rng.random(12) ** 4 + 1e-12
        roots, _ = secular_roots(d, z2)
        assert np.all(roots >= d) and np.all(roots[:-1] <= d[1:]) and roots[-1] <= d[-1] + z2.sum() * (1 + 1e-12)
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
        assert np.allclose(np.sort(roots), want, rtol=1e-13)


def test_deflation_leaves_what_does_not_change():
    values, vectors = np.array([1.0, 2.0, 2.0, 5.0]), np.eye(4)
    got, q = rank_one(values, vectors, np.array([0.0, 3.0, 4.0, 0.0]))
    assert np.allclose(got, [1, 2, 5, 27]) and np.allclose(np.abs(q[:, 0]), [1, 0, 0, 0]) and np.allclose(np.abs(q[:, 3]), [0, 0.6, 0.8, 0])
    assert rank_one(values, vectors, np.zeros(4))[0] is values


def test_spectra_combined_equal_all_rows():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) * 1000).astype(np.int64) + 100_000
    one = Spectrum.empty(6)
    for a, b in ((0, 3), (3, 3), (3, 200), (200, 500)):
        part = Spectrum.empty(6)
        for k in range(a, b, 50):
            part.add_rows(x[k : min(b, k + 50)])
        one.add(part)
    centred = x - x.mean(axis=0)
    assert one.n == 500 and one.sums.tolist() == x.sum(axis=0).tolist()
    assert np.allclose(one.values, np.linalg.eigvalsh(centred.T @ centred), rtol=1e-11)


def plain(rows, wanted=8):
    """vec_id -> (n, deviation, whitened by component), and explained, by a dense solver over all rows in one place."""
    fine = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in fine], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    y = np.array([[float(n * c - t) / n for c, t in zip(r, sums)] for r in x])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    m = int((values[:wanted] > 1e-12 * values.sum()).sum())
    return [k for k, _ in fine], n, deviation, y @ vectors[:, :m] / np.sqrt(values[:m]), values[:m] / values.sum()


def check(got, rows, wanted=8):
    ids, n, deviation, white, explained = plain(rows, wanted)
    m = white.shape[1]
    assert len(got) == len(ids) * m
    by = {}
    for r in got:
        assert r.n == n and math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9) and 0 <= r.identity_error < 1e-9
        by.setdefault((r.component, r.deviation_exact), []).append(r.whitened)
        assert r.deviation == (int(r.deviation_exact) if r.deviation_exact < 2**63 else None)
    for c in range(m):
        mine = sorted((int(d), w) for (k, d), ws in by.items() if k == c + 1 for w in ws)
        want, turned = (sorted(zip(deviation, sign * white[:, c])) for sign in (1, -1))
        assert any(all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-8 for a, b in zip(mine, w)) for w in (want, turned))


def test_op12_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = op12_whitening(spark, SF).collect()
    check(got, rows)
    assert sorted({r.vec_id for r in got}) == sorted(k for k, v in rows if v)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whiten, "FAN", 2)
    monkeypatch.setattr(whiten, "SPARE", 0)
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=12) * np.arange(1, 13)).tolist()) for k in range(90)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, rows[7][1]), (1000, None), (1001, [1.0] * 11 + [None]), (1002, [float("nan")] * 12),
             (1003, [float("inf")] * 12), (1004, [])]
    df = spark.createDataFrame([(k, v, 9, "x") for k, v in rows], "vec_id long, embedding array<float>, component int, v string").repartition(11)
    held = [(r.vec_id, r.embedding) for r in df.collect()]
    check(whiten.whiten(df).collect(), held)
    check(whiten.whiten(df, components_wanted=3).collect(), held, 3)
    assert {r.vec_id for r in whiten.whiten(df.unionByName(df.limit(1).selectExpr(
        "777L as vec_id", "array(1f, 2f) as embedding", "component", "v"))).collect()}.isdisjoint({777, 1000, 1001, 1002, 1003, 1004})


def test_degenerate_tables(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        assert whiten.whiten(spark.createDataFrame(rows, schema)).count() == 0
    flat = [(1, [1.0, 2.0, 0.0]), (2, [4.0, 2.0, 1.0]), (3, [9.0, 2.0, 5.0])]  # one dimension without variance
    got = whiten.whiten(spark.createDataFrame(flat, schema)).collect()
    assert len(got) == 6
    check(got, flat)
    far = [(1, [1e11, 0.0]), (2, [-1e11, 1.0]), (3, [5e10, 2.0])]  # deviations beyond a long
    check(whiten.whiten(spark.createDataFrame(far, schema), components_wanted=1).collect(), far, 1)
