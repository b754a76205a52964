"""Importance resampling against a plain version; the sort by regular sampling against sorted()."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docforge.llm import resample
from docforge.llm.common import stored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, target, percent=25, min_words=20, seed=7, buckets=10_000):
    of = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(of(f) for _, t in docs for f in features(t)[1])
    t = Counter(of(f) for x in target for f in features(x)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in s}
    rows = []
    for d, text in docs:
        n, fs = features(text)
        weight = sum(gain[of(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r.append(k)
    return [tuple(r) if len(r) == 6 else (*r, None) for r in rows]


def rows_of(df):
    return [(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()]


def test_checksums_of_words_and_pairs():
    rng = random.Random(3)
    texts = ["", None, "A", "a b", "x" * 200 + " y " + "z" * 49 + " " + "w" * 48 + " é" * 3, "--", "Ünï-cödé 日本 9z"]
    texts += ["".join(rng.choice("aB9 é-日\n") for _ in range(rng.randrange(200))) for _ in range(300)]
    one, of_one, two, of_two = resample.word_features(pa.array(texts))
    got = sorted([*zip(of_one.tolist(), one.tolist()), *zip(of_two.tolist(), two.tolist())])
    assert got == sorted((k, zlib.crc32(f.encode())) for k, t in enumerate(texts) for f in features(t)[1])


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(1)
    words = ["alpha", "Beta", "gamma9", "δέλτα", "the", "of", "x" * 60]
    docs = [(k, " ".join(rng.choices(words, k=rng.choice([0, 3, 19, 20, 60])))) for k in range(300)]
    docs += [(7, docs[7][1]), (None, "the of alpha " * 10), (None, "the of alpha " * 10), (400, None), (401, ""), (402, "the " * 30_000)]
    target = ["alpha beta", "BETA the", None, "δέλτα δέλτα"]
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in docs], "doc_id long, text string, score int, id string").repartition(7)
    aim = spark.createDataFrame([(t, 2) for t in target], "text string, rank int")
    got = rows_of(resample.resample(df, aim))
    assert sorted(got, key=str) == sorted(brute(docs, target), key=str)
    monkeypatch.setattr(resample, "CHARS", 50)
    got = rows_of(resample.resample(df, aim, percent=60, min_words=3, seed=11, buckets=16))
    assert sorted(got, key=str) == sorted(brute(docs, target, 60, 3, 11, 16), key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resample.resample(docs.limit(0), docs).count() == 0
    assert rows_of(resample.resample(docs, docs.limit(0), min_words=0, percent=100)) == brute([(1, "a b c")], [], 100, 0)


@pytest.mark.parametrize(("sample", "fan", "draw"), [(64, 64, 9000), (4, 3, 900), (4, 2, 0), (8, 2, 20_000)])
def test_ranks_of_a_hot_key(spark, monkeypatch, sample, fan, draw):
    """A third of the rows share score and id; still no segment gets them all, and ranks are those of sorted()."""
    monkeypatch.setattr(resample, "SAMPLE", sample)
    monkeypatch.setattr(resample, "FAN", fan)
    n = 9000
    rows = spark.range(n, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(9)) - 4).cast("long").alias("score"),
        F.when(F.col("id") % 3 == 0, None).otherwise(F.pmod(F.hash("id"), F.lit(200))).cast("long").alias("id"), F.col("id").alias("row"))
    rows = stored(rows, "rows")
    cuts = resample.splitters(rows, 8)
    assert cuts == sorted(cuts) and len(cuts) == 7
    got = resample.ranks(rows, draw).collect()
    order = sorted(((r.score, r.id, r.row) for r in rows.collect()), key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    want = {r[2]: k if k <= draw else None for k, r in enumerate(order, 1)}
    assert {r.row: r["rank"] for r in got} == want and len(got) == n
    keys = sorted(resample._keys(*(f([r[i] for r in order]) for i, f in ((0, _long), (1, lambda x: pa.array(x, pa.int64())), (2, _long)))).tolist())
    sizes = [sum(1 for k in keys if (i == 0 or k.ljust(25, b"\0") > cuts[i - 1]) and (i == 7 or k.ljust(25, b"\0") <= cuts[i])) for i in range(8)]
    assert max(sizes) < n / 8 * (1.3 if sample == 64 else 2.5)


def _long(x):
    import numpy as np

    return np.array(x, np.int64)
