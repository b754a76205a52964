"""Fingerprints against a plain version of the same rules."""

import hashlib
import re

import pytest

from docforge.llm import imatch
from docforge.llm.queries import op7_imatch


def test_op7_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    rows = {r.doc_id: r for r in op7_imatch(spark, sf).collect()}
    assert len(rows) == len(texts)
    by_text = {}
    for k, (d, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
    # next documents are others, half-edited ones share half
    near = [r.near_edited for r in rows.values() if r.n_chars > 200]
    other = [r.near_next for r in rows.values() if r.n_chars > 200]
    assert sum(near) / len(near) > 3 * sum(other) / len(other)


def test_signatures_follow_the_rules(spark):
    """Each part's signature depends on the text's set of lexicon terms in the part alone."""
    texts = [" ".join(f"w{k % 37}" for k in range(n, n + 12)) for n in range(120)] + ["", "!!", "Zz zz", "zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    entries, size = imatch.fitted_lexicon(df)
    parts = {r.term: r.parts for r in entries.collect()}
    assert size == len(parts)
    words = sorted({w for t in texts for w in re.findall(r"\w+", t.lower())})
    hashes = dict(zip(words, (r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").selectExpr("xxhash64(w)").collect())))
    frequency = {w: sum(w in re.findall(r"\w+", t.lower()) for t in texts) for w in words}
    low, high = imatch.LOW * len(texts), imatch.HIGH * len(texts)
    assert set(parts) <= {hashes[w] for w in words if low <= frequency[w] <= high}
    rows = imatch.fingerprinted(df, entries, ["doc_id"], size).collect()
    seen = {}
    for r in rows:
        terms = {hashes[w] for w in re.findall(r"\w+", texts[r.doc_id].lower())}
        if not terms & set(parts):
            assert len(r.signatures) == 1
            key = (-1, frozenset(terms))
            assert seen.setdefault(key, r.signatures[0]) == r.signatures[0]
            continue
        for k, s in enumerate(r.signatures):
            own = frozenset(t for t in terms if t in parts and parts[t] >> k & 1)
            assert (s == "") == (not own)
            assert seen.setdefault((k, own), s) == s


def test_edge_cases(spark):
    rows = [(3, None, "x"), (1, "a b", "y"), (1, "a b", "y"), (None, "c", "z"), (2, "", "z"), (9, "x" * 20_000 + " tail", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string").repartition(3)
    got = sorted(((r.doc_id or 0), r.n_chars, r.edited_sha256) for r in imatch.edit_test(df).collect())
    order = ["c", "a b", "a b", "", "", "x" * 20_000 + " tail"]
    ids = [0, 1, 1, 2, 3, 9]
    want = []
    for k, t in enumerate(order):
        half = len(t) // 2
        want.append((ids[k], len(t), hashlib.sha256((t[: len(t) - half] + order[(k + 1) % 6][:half]).encode()).hexdigest()))
    assert got == sorted(want)
    assert imatch.edit_test(df.limit(0)).count() == 0
    alone = imatch.edit_test(spark.createDataFrame([(5, "a b c d")], "doc_id int, text string")).collect()
    assert alone[0].n_chars == 7 and alone[0].near_next == 1
    prints = {r.doc_id: r.fingerprint for r in imatch.fingerprint(df).collect()}
    assert prints[3] == prints[2] and len(prints) == 5


@pytest.mark.parametrize("limit", [0])
def test_a_lexicon_too_large_to_broadcast(spark, monkeypatch, limit):
    df = spark.createDataFrame([(k, f"w{k % 7} w{k % 5}") for k in range(40)], "doc_id long, text string")
    want = sorted(tuple(r) for r in imatch.fingerprint(df).collect())
    monkeypatch.setattr(imatch, "BROADCAST_ENTRIES", limit)
    assert sorted(tuple(r) for r in imatch.fingerprint(df).collect()) == want
