"""Near-duplicate classes against brute force."""

import random
import re

import numpy as np
import pytest

from docforge.llm import jaccard_join
from docforge.llm.components import components
from docforge.llm.queries import op4_grouped_prefix
from docforge.llm.shingles import bits_apart, parity_bits

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = [w.lower() for w in WORD.findall((text or "").encode())]  # bytes.lower() is A-Z only
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        least.setdefault(find(k), []).append(d)
    return [(d, len(sets[k]), min((x for x in least[find(k)] if x is not None), default=None)) for k, (d, _) in enumerate(rows)]


def order(rows):
    return sorted(rows, key=str)


def got(df, **kw):
    return order([tuple(r)[:3] for r in jaccard_join.classes(df, **kw).collect()])


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)]
    root = {}
    for u, v in edges:
        a, b = root.setdefault(u, {u}), root.setdefault(v, {v})
        if a is not b:
            a |= b
            for x in b:
                root[x] = a
    want = {u: min(root[u]) for e in edges for u in e if len(root[u]) > 1}
    found = [tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect()]
    assert dict(found) == want and len(found) == len(want)


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(2)
    for n, m in ((5, 300), (100, 100), (700, 650), (64, 2000)):
        pool = rng.integers(0, 1 << 63, n + m).astype(np.uint64)
        a, b = pool[:n], pool[n // 2 : n // 2 + m]
        assert bits_apart(parity_bits(a), parity_bits(b)) <= len(set(a.tolist()) ^ set(b.tolist()))


@pytest.mark.parametrize("seed, size, percent, limits", [
    (0, 3, 90, {}), (1, 5, 80, {"LONG_LIST": 2, "LIST_BLOCK": 7, "CLUSTER_BLOCK": 400, "LEAST_WEIGHT": 16}),
    (2, 3, 90, {"LONG_LIST": 3, "LIST_BLOCK": 4, "CLUSTER_BLOCK": 150, "LEAST_WEIGHT": 1, "COLUMNS": 8, "STAND_OUT": 0}),
    (3, 2, 50, {"CHARS": 200, "STAND_OUT": -1})])
def test_random_families_equal_brute_force(spark, monkeypatch, seed, size, percent, limits):
    for k, v in limits.items():
        monkeypatch.setattr(jaccard_join, k, v)
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    for family in range(8):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 4, 30, 80, 150]))]
        for _ in range(rnd.choice([1, 3, 25])):
            words = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                words.append("tail")
            rows.append((rnd.randrange(10_000), (" " if rnd.random() < 0.5 else "\n").join(words)))
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "oNE "), (6, "one two"), (7, "É x y"), (8, "é x y"), (9, "a\xa0b c"),
             (None, rows[0][1]), (None, "only null"), (rows[3][0], rows[3][1]), (rows[4][0], "other text of a repeated id"), (10, "x " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df, size=size, percent=percent) == order(brute(rows, size, percent))


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(2, "a b c", 1, "x"), (1, "a b c", 2, "y")], "doc_id int, text string, node int, mark string")
    assert got(df) == [(1, 1, 1), (2, 1, 1)]
    assert got(df.limit(0)) == []


def test_op4_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert order([tuple(r) for r in op4_grouped_prefix(spark, SF).collect()]) == order(brute(rows, 3, 90))


def test_unlinked_texts_of_one_id_or_none_all_stay(spark):
    text = {k: " ".join(f"{k}{j}" for j in range(40)) for k in "abcd"}
    rows = [(None, text["a"]), (None, text["b"]), (7, text["c"]), (7, text["d"]), (7, text["d"]), (None, text["a"] + " x"), (8, text["c"] + " x"),
            (None, None), (None, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "") for r in jaccard_join.one_of_each(df).collect())
    a = [t for i, t in got if i == 0 and t.startswith("a0")]
    assert len(a) == 1 and a[0] in (text["a"], text["a"] + " x")  # one class without an id: either row
    assert [x for x in got if x[1] not in a] == sorted([(0, ""), (0, " "), (0, text["b"]), (7, text["c"]), (7, text["d"])])


def test_words_that_collide_in_a_polynomial_are_different(spark):
    for n in (1024, 2048, 4096):
        bits = [bin(k).count("1") & 1 for k in range(n)]
        pair = ["".join(x[b] for b in bits) for x in ("ab", "ba")]
        df = spark.createDataFrame([(1, pair[0]), (2, pair[1])], "doc_id long, text string")
        assert sorted(r.component_id for r in jaccard_join.classes(df, size=3, percent=90).collect()) == [1, 2]
