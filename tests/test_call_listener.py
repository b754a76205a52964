"""Calls recorded by Spark's listeners, and the continuous trigger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docforge.streaming.call_listener import CallLog
from docforge.streaming.sync_stream import CHANGE_SCHEMA, action_log_state, start_sync


def _land(spark, path, rows):
    spark.createDataFrame([(dt.datetime(2024, 1, d), "E", [k], op) for d, k, op in rows], CHANGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_continuous_trigger_takes_what_lands_later_and_is_recorded(spark, tmp_path):
    landing, out, check, log_path = (str(tmp_path / n) for n in ("landing", "out", "check", "log"))
    entities = spark.createDataFrame([("E",)], "entity string")
    _land(spark, landing, [(1, "a", "persist"), (1, "b", "persist")])
    with CallLog(spark, log_path, "test", limit=1) as log:
        q = start_sync(spark, landing, out, check, entities, available_now=False, interval="100 milliseconds", name="continuous")
        q.processAllAvailable()
        _land(spark, landing, [(2, "a", "remove")])
        _land(spark, landing, [(3, "c", "update")])
        q.processAllAvailable()
        q.stop()
        log.wait(q)
    assert {(r["id"], r["action"]) for r in action_log_state(spark, out).collect()} == {("a", "delete"), ("b", "upsert"), ("c", "upsert")}
    rows = log.read().collect()
    assert sorted((r["batch"], r["ops"]) for r in rows) == [(0, 2), (1, 1), (2, 1)]
    assert {(r["request"], r["operation"], r["error"]) for r in rows} == {("continuous", "stream", None)}
    assert all(r["duration_ms"] >= r["took_ms"] > 0 for r in rows)


def test_failed_batch_and_its_repeat(spark, tmp_path):
    landing, out, check = (str(tmp_path / n) for n in ("landing", "out", "check"))
    entities = spark.createDataFrame([("E",)], "entity string")
    _land(spark, landing, [(1, "a", "persist")])

    def fails(batch, number):
        raise ValueError("store is away")

    with CallLog(spark, str(tmp_path / "log"), "test") as log:
        q = start_sync(spark, landing, out, check, entities, on_batch=fails, name="s")
        with pytest.raises(Exception, match="store is away"):
            q.awaitTermination()
        log.wait(q)
        q = start_sync(spark, landing, out, check, entities, name="s")
        q.awaitTermination()
        log.wait(q)
        assert len(log.rows) == 2  # the driver still holds them
    rows = log.read().collect()
    assert sorted((r["batch"] is None, r["error"] is None) for r in rows) == [(False, True), (True, False)]


def test_actions_with_observed_counts_and_failures(spark, tmp_path):
    df = spark.range(10)
    with CallLog(spark, str(tmp_path / "log"), "page 1", limit=2) as log:
        df.count()  # observes nothing, so it is no call
        df.where("id > 20").observe("parts", F.count(F.lit(1)).alias("hits")).collect()
        df.observe("parts", F.count(F.lit(1)).alias("ops")).write.format("noop").mode("overwrite").save()
        with pytest.raises(Exception):
            df.select(F.raise_error(F.lit("odd"))).collect()
        log.wait_rows(3)
        assert len(log.rows) < 2
    rows = {r["operation"]: r for r in log.read().collect()}
    assert rows["search"]["hits"] == 0 and rows["search"]["index"] == "parts" and rows["bulk"]["ops"] == 10
    failed = [r for n, r in rows.items() if n not in ("search", "bulk")]
    assert len(failed) == 1 and failed[0]["error"] and {r["request"] for r in rows.values()} == {"page 1"}
    df.observe("parts", F.count(F.lit(1)).alias("hits")).collect()
    assert log.written == 3  # closed


def test_limit(spark):
    with pytest.raises(ValueError):
        CallLog(spark, "x", "r", limit=0)
