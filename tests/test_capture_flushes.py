"""Change capture by hash trees and flushes completed by streaming state, on small literals."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from docforge.operators import capture, sync
from docforge.streaming.flushes import heartbeat, late_rows, start_flushes


def _snapshot(spark, path, rows, schema="id string, name string, n int"):
    capture.write_snapshot(spark.createDataFrame(rows, schema).repartition(3), str(path), bits=8)
    return str(path)


def _found(spark, old, new):
    return sorted((r["id"], r["op"]) for r in capture.changes(spark, old, new).collect())


def test_capture_equals_a_plain_comparison(spark, tmp_path):
    rng = random.Random(3)
    old = {str(k): (rng.choice(["a", "b", None]), rng.choice([1, None])) for k in range(400)}
    new = {k: v for k, v in old.items() if int(k) % 50}
    new |= {str(k): ("a", 2) for k in range(400, 405)} | {"7": (None, 1), "8": (None, None)}
    old |= {"7": (None, None), "8": (None, 1)}  # a null and a value change places
    paths = [_snapshot(spark, tmp_path / n, [(k, *v) for k, v in d.items()]) for n, d in (("old", old), ("new", new))]
    want = [(k, "persist" if k not in old else "remove" if k not in new else "update") for k in {*old, *new} if old.get(k) != new.get(k)]
    assert _found(spark, *paths) == sorted(want)
    assert _found(spark, paths[0], paths[0]) == []


def test_equal_ranges_are_not_read(spark, tmp_path):
    rows = [(str(k), "x", k) for k in range(3000)]
    old = _snapshot(spark, tmp_path / "old", rows)
    new = _snapshot(spark, tmp_path / "new", [(i, "y" if i == "1234" else n, k) for i, n, k in rows])
    leaves, bits = capture.unequal_leaves(spark, old, new)
    assert len(leaves) == 1 and bits == 8
    found = capture.changes(spark, old, new)
    assert [tuple(r) for r in found.collect()] == [("1234", "update")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[[^\]]*_range#\d+ = \d+", plan)
    assert len(set(scans)) == 2  # one folder of each snapshot (the adaptive plan shows them twice)


def test_repeated_and_null_ids_maps_and_empty_snapshots(spark, tmp_path):
    schema = "id string, m map<string,int>, a array<struct<k:string>>"
    one = [("1", {"a": 1, "b": 2}, [("x",)]), ("1", {"a": 3}, None), (None, None, None), ("2", {}, [])]
    two = [("1", {"a": 3}, None), ("1", {"b": 2, "a": 1}, [("x",)]), (None, {}, None), ("2", {}, []), ("2", {}, [])]
    empty, a, b = (_snapshot(spark, tmp_path / n, r, schema) for n, r in (("e", []), ("a", one), ("b", two)))
    ops = lambda x, y: sorted((str(r["id"]), r["op"]) for r in capture.changes(spark, x, y).collect())
    assert ops(empty, a) == [("1", "persist"), ("2", "persist"), ("None", "persist")]
    assert ops(a, empty) == [("1", "remove"), ("2", "remove"), ("None", "remove")]
    assert ops(empty, empty) == [] and ops(a, b) == [("2", "update"), ("None", "update")]
    rows = capture.change_rows(capture.changes(spark, a, b), "E", F.lit("2024-01-01 00:00:00"))
    assert [r["id"] for r in sync.scalar_ids(rows).collect()] == ["2"]
    with pytest.raises(ValueError):
        capture.write_snapshot(spark.createDataFrame(one, schema), str(tmp_path / "odd"), bits=7)


CHANGE = "flush timestamp_ntz, entity string, key array<string>, op string"


def test_a_flush_split_over_micro_batches_with_restarts(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 1, d)
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    entities = spark.createDataFrame([("E",)], "entity string")
    files = [
        [(day(1), "E", ["1"], "update"), (day(2), "E", ["1"], "remove"), (day(2), "E", ["2"], "update")],
        [(day(2), "E", ["1"], "update"), (day(2), "Other", ["1"], "update"), (day(2), "E", ["a", "b"], "update"), (day(2), "E", [None], "update")],
        [(day(2), "E", ["2"], "update"), (day(2), "E", ["3"], "persist"), (day(3), "E", ["1"], "update")],
        [(day(1), "E", ["9"], "update")],  # too late: counted
        None,
    ]
    seen, late = [], 0
    for rows in files:
        frame = heartbeat(spark, "2024-02-01 00:00:00") if rows is None else spark.createDataFrame(rows, CHANGE)
        frame.coalesce(1).write.mode("append").parquet(landing)
        q = start_flushes(spark, landing, out, check, entities)
        q.awaitTermination()
        late += late_rows(q)
        seen.append(sorted((r["flush"].day, r["id"], r["action"]) for r in spark.read.parquet(out).collect()))
    first, second = [(1, "1", "upsert")], [(2, "1", "delete"), (2, "2", "upsert"), (2, "3", "upsert")]
    assert seen[0] == seen[1] == first  # the second flush is open until a later one shows up
    assert seen[2] == seen[3] == first + second
    assert seen[4] == [*first, *second, (3, "1", "upsert")]
    assert late == 1


def test_continuous_trigger_keeps_running(spark, tmp_path):
    from docforge.streaming.sync_stream import action_log_state, start_sync

    entities = spark.createDataFrame([("E",)], "entity string")
    landing, log = str(tmp_path / "landing"), str(tmp_path / "log")
    rows = [(dt.datetime(2024, 1, 1), "E", ["1"], "update")]
    spark.createDataFrame(rows, CHANGE).write.parquet(landing)
    q = start_sync(spark, landing, log, str(tmp_path / "check"), entities, max_files_per_trigger=10, available_now=False)
    try:
        q.processAllAvailable()
        spark.createDataFrame([(dt.datetime(2024, 1, 2), "E", ["1"], "remove")], CHANGE).write.mode("append").parquet(landing)
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert [tuple(r) for r in action_log_state(spark, log).collect()] == [("E", "1", "delete")]
