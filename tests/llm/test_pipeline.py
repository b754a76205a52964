"""The pipeline against brute force, its stages on odd rows, and the token rollup."""

import uuid

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from docforge.llm import rollup
from docforge.llm.queries import BYTE_BPE, WORD_BPE, op3_rollup
from docforge.session import shared_root
from tests.llm.test_jaccard_join import brute as brute_classes

SF = "/root/testdata/sf0.001"


def cut(rows, width=50):
    """Texts without whole characters of strings that an earlier document has; rows are (id, text) with distinct ids."""
    first, out = {}, {}
    for d, t in sorted(rows):
        b = t.encode()
        for i in range(len(b) - width + 1):
            first.setdefault(b[i : i + width], d)
    for d, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < d:
                gone[i : i + width] = True
        left, at = [], 0
        for c in t:
            n = len(c.encode())
            if not gone[at : at + n].all():
                left.append(c)
            at += n
        out[d] = "".join(left)
    return out


def test_pipeline_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    rows = [(d, t) for (d, t), (_, _, c) in zip(rows, brute_classes(rows, 5, 80)) if d == c]
    left = {d: t for d, t in cut(rows).items() if t}
    ref = Tokenizer.from_file(BYTE_BPE)
    want = {d: [*ref.encode(t, add_special_tokens=False).ids, 1] for d, t in left.items()}
    got = {}
    for p in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda p: p.start):
        got.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    assert got == want


def test_stages_on_odd_rows(spark):
    long = " ".join(f"word{k}" for k in range(80))
    rows = [(1, long, "en", "s", 9, "u"), (2, long + " x", "en", "s", 9, "u"), (2, long + " x", "en", "s", 9, "u"), (3, None, None, None, None, None),
            (4, "12 34", "de", "s", 5, "u"), (None, "alpha beta", None, "s", 5, "u"), (5, "É" * 60 + "q", "fr", "s", 61, "u"),
            (6, "z" + "É" * 60, "fr", "s", 61, "u"), (7, "", "en", "s", 0, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
            seen[name] = sorted((r.doc_id or 0, r.text, r.n_chars, r.lang_pred) for r in docs.collect())
    assert [r[0] for r in seen["language_id"]] == [0, 1, 2, 2, 5, 6]
    assert [r[0] for r in seen["jaccard_join"]] == [0, 1, 5, 6]
    assert [r[:3] for r in seen["difference_cover"]] == [(0, "alpha beta", 10), (1, long, len(long)), (5, "É" * 60 + "q", 61), (6, "z", 1)]
    assert out.count() >= 1


def test_documents_without_any_label_stay(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    texts = {1: "alpha beta", 2: "12 34", 3: None, 4: "É", 5: ""}
    docs = spark.createDataFrame([(k, t, None, "s", len(t or "")) for k, t in texts.items()], kind)
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, SF).collect()) == [1, 4]
    odd = spark.createDataFrame([(1, "alpha beta", None, "s", 10), (2, "12 34", "en", "s", 5)], kind)  # no labelled trigram
    assert [r.doc_id for r in corpus_pipeline.language_id(spark, odd, SF).collect()] == [1]


def test_the_model_decides_the_language_of_unlabelled_documents(spark, monkeypatch):
    """Null labels are filled by the classifier: with another one the stage gives another result. Labels stay, no clean text goes."""
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(k, "the house and the garden " * 3, "en") for k in range(4)] + [(k, "das haus und der garten " * 3, "de") for k in range(4, 8)]
    rows += [(8, "the garden and the house", None), (9, "der garten und das haus", None), (10, "the house", "de")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t)) for d, t, lang in rows], kind)
    run = lambda: {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, docs, SF).collect()}
    got = run()
    assert got == {d: lang for d, _, lang in rows} | {8: "en", 9: "de"}
    fit = corpus_pipeline.langid.fit
    monkeypatch.setattr(corpus_pipeline.langid, "fit", lambda d: fit(d.replace({"en": "de", "de": "en"}, subset="lang")))
    assert run() == got | {8: "de", 9: "en"}


def test_near_duplicates_of_repeated_rows(spark):
    """One text and one null id on many rows, columns of clashing names, rows that don't come from files."""
    from docforge.llm import jaccard_join

    long = " ".join(f"w{k}" for k in range(40))
    rows = [(None, long, k, "f") for k in range(50)] + [(None, "another text of some words here", 50, "f")] * 3
    rows += [(1, long + " x", 60, None), (1, "unlike all the others it is", 61, None), (2, "", 62, None), (2, "", 63, None), (None, None, 64, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line long, file string")
    for frame in (docs, docs.withColumnsRenamed({"line": "_metadata"})):
        got = jaccard_join.one_of_each(frame, size=5, percent=80)
        assert got.columns == frame.columns
        left = sorted(((r.doc_id or 0), r.text or "") for r in got.collect())
        assert left == sorted([(1, long + " x"), (0, "another text of some words here"), (1, "unlike all the others it is"), (2, ""), (2, ""), (0, "")])


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


# -- token rollup ------------------------------------------------------------------------------------------


def test_op3_whole_table(spark):
    byte, word = Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        label = labels.get(r.doc_id)
        if label and label.toxic:
            continue
        good = label and label.quality
        ref, name = (word, "word_bpe_49k") if good else (byte, "byte_bpe_50k")
        total = want.setdefault((r.source, r.lang, name), [0, 0])
        total[0] += 1
        total[1] += len(ref.encode(r.text or "", add_special_tokens=False).ids)
    got = {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in op3_rollup(spark, SF).collect()}
    assert got == want


def rows_of(spark, path):
    return sorted((tuple(r) for r in rollup.totals(spark, path).collect()), key=str)


def test_batches_are_idempotent_and_additive(spark):
    path = f"{shared_root(spark)}/t-{uuid.uuid4().hex}"
    kind = "source string, lang string, tokenizer string, n_tokens long, extra int"
    counts = lambda *rows: spark.createDataFrame([(*r, 1) for r in rows], kind)
    assert rows_of(spark, path) == []
    rollup.commit(rollup.inserts(counts(("a", "en", "v1", 5), ("a", "en", "v1", 7), (None, None, "v1", None))), path, 0)
    rollup.commit(rollup.deletes(counts(("a", "en", "v1", 5))), path, 2)
    for _ in range(2):
        rollup.commit(rollup.revisions(counts(("a", "en", "v1", 7)), counts(("a", "en", "v2", 9))), path, 1)
    want = [("a", "en", "v2", 1, 9), (None, None, "v1", 1, 0)]
    assert rows_of(spark, path) == want
    rollup.compact(spark, path, 1)
    assert rows_of(spark, path) == want
    with pytest.raises(ValueError):
        rollup.commit(rollup.inserts(counts(("a", "en", "v1", 5))), path, 1)
    rollup.commit(rollup.inserts(counts(("b", "fr", "v1", 1))), path, 3)
    rollup.compact(spark, path, 3)
    rollup.compact(spark, path, 2)
    assert rows_of(spark, path) == [("a", "en", "v2", 1, 9), ("b", "fr", "v1", 1, 1), (None, None, "v1", 1, 0)]


def test_an_unfinished_batch_is_not_read(spark, tmp_path):
    path = str(tmp_path / "r")
    counts = spark.createDataFrame([("a", "en", "v1", 5)], "source string, lang string, tokenizer string, n_tokens long")
    rollup.commit(rollup.inserts(counts), path, 1)
    rollup.commit(rollup.inserts(counts), path, 2)
    (tmp_path / "r/batches/2/_SUCCESS").unlink()
    assert rows_of(spark, path) == [("a", "en", "v1", 1, 5)]


def test_a_redelivery_that_dies_leaves_the_committed_batch(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    kind = "source string, lang string, tokenizer string, n_tokens long"
    counts = spark.createDataFrame([("a", "en", "v1", 5)], kind)
    rollup.commit(rollup.inserts(counts), path, 1)
    broken = counts.selectExpr("source", "lang", "tokenizer", "cast(assert_true(n_tokens < 0, 'executor lost') as long) as n_tokens")
    with pytest.raises(Exception, match="executor lost"):
        rollup.commit(rollup.inserts(broken), path, 1)
    assert rows_of(spark, path) == [("a", "en", "v1", 1, 5)]

    def dies(*_):
        raise KeyboardInterrupt

    put = rollup._put
    monkeypatch.setattr(rollup, "_put", dies)
    with pytest.raises(KeyboardInterrupt):
        rollup.commit(rollup.inserts(counts), path, 1)
    assert rows_of(spark, path) == [("a", "en", "v1", 1, 5)]
    monkeypatch.setattr(rollup, "_put", put)
    more = spark.createDataFrame([("a", "en", "v1", 7)], kind)
    for _ in range(2):
        rollup.commit(rollup.inserts(more), path, 1)
        assert rows_of(spark, path) == [("a", "en", "v1", 1, 7)]
