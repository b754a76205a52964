"""Concurrent writers, carried changes, kept rejects and resumed loads of a document store."""

import threading

import pytest
from pyspark.sql import functions as F

from docforge.operators import store as store_module
from docforge.operators.store import DocumentStore, PublishConflict, RejectedDocuments
from docforge.operators.versions import VersionLog
from docforge.spec import FieldSpec


def _docs(spark, n, name="n", first=0):
    return spark.createDataFrame([(str(i), f"{name}{i}") for i in range(first, first + n)], "id string, name string")


def _ids(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def _held(store, alias):
    return {r["id"]: r["name"] for r in store.read(alias).collect()}


def test_a_number_is_committed_once(spark, tmp_path):
    logs = [VersionLog(spark, str(tmp_path / "v")) for _ in range(2)]
    assert logs[0].head() == (0, None) and logs[0].commit(1, {"a": 1}) and not logs[1].commit(1, {"a": 2})
    assert logs[1].head() == (1, {"a": 1}) and logs[1].commit(2, {"a": 3})
    assert not logs[0].commit(2, {"a": 4}) and logs[0].after(1) == [(2, {"a": 3})]
    won = []

    def race(k):
        for n in range(3, 13):
            if VersionLog(spark, str(tmp_path / "v")).enter(n, {"by": k}):
                won.append((n, k))

    threads = [threading.Thread(target=race, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(n for n, _ in won) == list(range(3, 13))
    assert all(logs[0].read(n)["by"] == k for n, k in won)
    assert not [p for p in (tmp_path / "v").iterdir() if not p.name.endswith(".json")]


def test_a_writer_whose_base_was_trimmed_has_lost(spark, tmp_path, monkeypatch):
    from docforge.operators import versions

    monkeypatch.setattr(versions, "KEPT", 2)
    log = VersionLog(spark, str(tmp_path / "v"))
    for n in range(1, 9):
        assert log.commit(n, {"n": n})
    log.trim(8)
    assert log.numbers() == [6, 7, 8]
    assert not log.commit(3, {"n": "late"}) and log.numbers() == [6, 7, 8]


def test_changes_during_compact_and_rebuild_are_kept(spark):
    store = DocumentStore(spark, database="t_carry")
    store.rebuild("c", _docs(spark, 4))
    store.apply_changes("c", None, _ids(spark, "1"), seq_col=None)

    def meanwhile(_):
        store.apply_changes("c", _docs(spark, 1, "new", 3), _ids(spark, "2"), seq_col=None, batch="late")

    old = store.live_generation("c")
    new = store.compact("c", accept=meanwhile)
    assert _held(store, "c") == {"0": "n0", "3": "new3"} and store.generations("c") == [new] and old != new
    meanwhile(None)  # the batch comes again under its name
    assert _held(store, "c") == {"0": "n0", "3": "new3"}
    for keep in (False, True):
        store.rebuild("c", _docs(spark, 4, "r"), keep_old=keep, accept=meanwhile)
        assert _held(store, "c") == {"0": "r0", "1": "r1", "3": "new3"}
    assert len(store.generations("c")) == 2  # the kept one


def test_carried_changes_fit_the_new_columns_or_stop_the_publish(spark):
    store = DocumentStore(spark, database="t_shape")
    store.rebuild("c", _docs(spark, 2))
    wider = _docs(spark, 2).withColumn("extra", F.lit(1))
    store.rebuild("c", wider, accept=lambda _: store.apply_changes("c", _docs(spark, 1, "late"), None, seq_col=None))
    assert {(r["id"], r["name"], r["extra"]) for r in store.read("c").collect()} == {("0", "late0", None), ("1", "n1", 1)}
    live = store.live_generation("c")
    with pytest.raises(RejectedDocuments):
        store.rebuild("c", wider.withColumn("name", F.lit("5")), {"name": FieldSpec("long"), "extra": FieldSpec("long")},
                      accept=lambda _: store.apply_changes("c", wider.withColumn("name", F.lit("word")), None, seq_col=None))
    assert store.live_generation("c") == live and store.generations("c") == [live]


def test_of_two_rebuilds_the_slower_one_is_refused(spark):
    store = DocumentStore(spark, database="t_two")
    store.rebuild("c", _docs(spark, 1))
    fast = []
    with pytest.raises(PublishConflict):
        store.rebuild("c", _docs(spark, 2, "slow"), accept=lambda _: fast.append(store.rebuild("c", _docs(spark, 3, "fast"))))
    assert store.live_generation("c") == fast[0] and len(_held(store, "c")) == 3 and store.generations("c") == fast


def test_a_writer_retries_on_the_new_generation(spark, monkeypatch):
    for keep in (False, True):
        store = DocumentStore(spark, database=f"t_retry_{keep}")
        store.rebuild("c", _docs(spark, 3))
        commit, done = store._commit_batch, []

        def late(alias, head, *rest, **kw):
            if not done:
                done.append(store.rebuild(alias, _docs(spark, 3, "r"), keep_old=keep))
            return commit(alias, head, *rest, **kw)

        monkeypatch.setattr(store, "_commit_batch", late)
        got = store.apply_changes("c", _docs(spark, 1, "w"), _ids(spark, "2", "77"), seq_col=None)
        assert (got.upserts, got.deletes, got.rejected) == (1, 2, 0)
        assert store.live_generation("c") == done[0]  # never back to the old one
        assert _held(store, "c") == {"0": "w0", "1": "r1"}


def test_threads_write_while_others_rebuild(spark):
    store = DocumentStore(spark, database="t_threads")
    store.rebuild("c", _docs(spark, 5))
    failed = []

    def write(k):
        try:
            for n in range(3):
                store.apply_changes("c", _docs(spark, 1, f"w{n}-", 100 + k), None, seq_col=None)
        except BaseException as exc:  # noqa: BLE001
            failed.append(exc)

    def fold():
        try:
            for _ in range(3):
                store.compact("c")
        except BaseException as exc:  # noqa: BLE001
            failed.append(exc)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(3)] + [threading.Thread(target=fold)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    held = _held(store, "c")
    assert {k: held[str(100 + k)] for k in range(3)} == {k: f"w2-{100 + k}" for k in range(3)} and len(held) == 8


def test_a_batch_whose_writer_died_is_finished_by_the_next_one(spark, monkeypatch):
    store = DocumentStore(spark, database="t_died")
    store.rebuild("c", _docs(spark, 3))
    place, delete = DocumentStore._place, DocumentStore._delete_path

    def dies(self, alias, number, record):
        if record["kind"] == "batch":
            raise KeyboardInterrupt

    monkeypatch.setattr(DocumentStore, "_place", dies)
    monkeypatch.setattr(DocumentStore, "_delete_path", lambda *_: None)  # a dead writer cleans nothing up
    with pytest.raises(KeyboardInterrupt):
        store.apply_changes("c", _docs(spark, 1, "w"), None, seq_col=None)
    monkeypatch.setattr(DocumentStore, "_place", place)
    monkeypatch.setattr(DocumentStore, "_delete_path", delete)
    assert _held(store, "c")["0"] == "w0"


def test_repeated_source_rows_need_an_order(spark):
    store = DocumentStore(spark, database="t_order")
    store.rebuild("c", _docs(spark, 2))
    twice = _docs(spark, 1, "a").withColumn("at", F.lit(1)).unionByName(_docs(spark, 1, "b").withColumn("at", F.lit(2)))
    with pytest.raises(ValueError, match="occurs 2 times"):
        store.reindex("c", _ids(spark, "0", "1"), twice)
    assert _held(store, "c") == {"0": "n0", "1": "n1"}
    got = store.reindex("c", _ids(spark, "0", "1"), twice, order_by="at")
    assert (got.upserts, got.deletes) == (1, 1) and _held(store, "c") == {"0": "b0"}


def test_rejects_are_all_kept_and_told_in_one_scan(spark, tmp_path):
    store = DocumentStore(spark, database="t_rejects")
    mapping = {"n": FieldSpec("long")}
    rows = spark.createDataFrame([(str(k), "x" if k % 3 == 0 else str(k)) for k in range(10)], "id string, n string")
    source = str(tmp_path / "rows")
    rows.write.parquet(source)
    store.rebuild("c", rows.where("n <> 'x'"), mapping)
    live = store.live_generation("c")
    with pytest.raises(RejectedDocuments, match="rejected document \"0\".*4 rejected") as failed:
        store.rebuild("c", spark.read.parquet(source), mapping)
    assert failed.value.count == 4 and store.live_generation("c") == live
    assert sorted(r["id"] for r in store.rejects("c", failed.value.load).collect()) == ["0", "3", "6", "9"]
    reads = []
    plain = store._deal
    store._deal = lambda frame, *a, **k: (reads.append(frame._jdf.queryExecution().executedPlan().toString().count("FileScan")), plain(frame, *a, **k))[1]
    store.rebuild("c", spark.read.parquet(source), mapping, on_reject="accept")
    assert reads == [1] and store.read("c").count() == 6 and store.rejects("c").count() == 4
    got = store.apply_changes("c", rows, None, seq_col=None, batch="all of them", on_reject="accept")
    assert (got.upserts, got.rejected) == (6, 4) and store.rejects("c", "all%20of%20them").count() == 4
    assert store.rejects("nothing").count() == 0


def test_a_load_goes_on_where_it_stopped(spark):
    store = DocumentStore(spark, database="t_resume")
    mapping = {"n": FieldSpec("long"), "v": FieldSpec("text")}
    frame = lambda v, bad: spark.createDataFrame(
        [(str(k), "x" if k == bad else str(k), v) for k in range(40)], "id string, n string, v string")
    store.create("c", frame("a", None).schema, mapping=mapping)
    number = F.floor(F.col("id").cast("int") / 10)
    with pytest.raises(RejectedDocuments, match='"25"'):
        store.populate_batches("c", frame("a", 25), "load", batch_of=number)
    assert store.read("c").count() == 20  # two batches are visible
    assert store.populate_batches("c", frame("b", None), "load", batch_of=number) == {"written": 2, "skipped": 2, "documents": 20}
    assert {(int(r["id"]) // 20, r["v"]) for r in store.read("c").collect()} == {(0, "a"), (1, "b")}
    assert store.populate_batches("c", frame("c", None), "load", batch_of=number)["documents"] == 0
    store.compact("c")  # the ledger outlives the log
    assert store.populate_batches("c", frame("d", None), "load", batch_of=number)["written"] == 0
    assert store.populate_batches("c", frame("e", None), "other/run", batches=7) == {"written": 7, "skipped": 0, "documents": 40}
    assert {r["v"] for r in store.read("c").collect()} == {"e"} and store.read("c").count() == 40
    with pytest.raises(ValueError):
        store.populate_batches("c", frame("f", None).unionByName(frame("f", None)), "twice")
    assert store_module.VersionLog(spark, f"{store.root}/runs/{store.db}/c/load").numbers() == [1, 2, 3, 4]
