"""Removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from docforge.llm import repeats
from docforge.llm.queries import op10_difference_cover

SF = "/root/testdata/sf0.001"


def brute(rows, width=50):
    """(id, bytes, removed places) of each (id, text); a null id is the smallest."""
    rank = lambda d: float("-inf") if d is None else d
    first = {}
    for d, t in sorted(rows, key=lambda r: rank(r[0])):
        b = (t or "").encode()
        for i in range(len(b) - width + 1):
            first.setdefault(b[i : i + width], rank(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = set()
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < rank(d):
                gone.update(range(i, i + width))
        spans = sum(i - 1 not in gone for i in gone)
        kept = bytes(c for i, c in enumerate(b) if i not in gone)
        out.append((d, len(b), len(gone), spans, kept))
    return out


def result(df, width=50, **kw):
    rows = repeats.remove_repeats(df, width=width, **kw).collect()
    return [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in rows]


def key(r):
    return (r[0] is not None, r[0] or 0, r[1], r[4])


def test_cover_gives_every_difference():
    assert {(a - b) % repeats.PERIOD for a in repeats.COVER for b in repeats.COVER} == set(range(repeats.PERIOD))


def test_packed_names():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        v = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        assert repeats.unpack_sorted(repeats.pack_sorted(v)).tolist() == v.tolist()


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_equal_brute_force(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(repeats, "SHARD_BYTES", [1 << 30, 2000, 700, 5000][seed])
    monkeypatch.setattr(repeats, "CHUNK_BYTES", [1 << 20, 300, 1 << 20, 64][seed])
    words = ["ä", "b ", "cc", "d\n", "eé"]
    text = lambda n: "".join(rnd.choice(words) for _ in range(n))
    passages = [text(n) for n in (30, 24, 60, 200)]
    rows = []
    for k in range(60):
        parts = [rnd.choice(passages)[rnd.randrange(4):] if rnd.random() < 0.5 else text(rnd.randrange(80)) for _ in range(3)]
        rows.append((rnd.randrange(45), "".join(parts)))
    rows += [(None, passages[2] + "x"), (None, passages[2]), (7, None), (8, ""), (9, "a" * 400), (3, "a" * 49), (2, "a" * 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(result(df), key=key) == sorted(brute(rows), key=key)


def test_carried_columns_and_empty_table(spark):
    rows = [(2, "x" * 80, "k2", 5), (1, "x" * 60, None, 6)]
    df = spark.createDataFrame(rows, "doc_id int, text string, kept string, n_bytes long")
    out = repeats.remove_repeats(df.withColumnRenamed("kept", "own"), carry=("own",))
    got = {r.doc_id: (r.own, bytes(r.kept)) for r in out.collect()}
    assert got == {1: (None, b"x" * 60), 2: ("k2", b"")}
    assert out.columns == ["doc_id", "own", "n_bytes", "spans", "kept"]
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_op10_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op10_difference_cover(spark, SF).collect()}
    want = {d: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, n, gone, spans, kept in brute(rows)}
    assert got == want


def test_whole_texts_that_collide_in_a_polynomial_are_different():
    import numpy as np

    for n in (1024, 2048, 4096):
        bits = np.array([bin(k).count("1") & 1 for k in range(n)], np.uint8)
        data = np.concatenate([97 + bits, 98 - bits])
        found = repeats.digests(data, np.array([0, n]), np.array([n, n]))
        assert found[0] != found[1]
