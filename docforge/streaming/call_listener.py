"""Calls recorded without the callers' doing (UDF-4, RPT-13).

Two listeners of Spark's own write to one call log: every micro-batch of every stream of the session (whichever function started
it) becomes a row, a stream that fails one more; and every action on a DataFrame becomes a row, with the counts it observed
(``DataFrame.observe``): metric ``hits`` of a search, ``ops`` of a bulk write. The name of the observation is the index.

The driver holds at most ``limit`` rows: then, and at the end, they are appended to the log in the shared folder.
Events come on Spark's listener thread after the call has returned; ``wait`` and ``wait_rows`` see to the order. The log's own writes
observe nothing, so they are not calls.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from docforge.operators.calls import CALL_SCHEMA
from docforge.sources.tables import small_frame

#: A row of the log is a call and, for a stream, the number of its micro-batch.
LOG_SCHEMA = f"{CALL_SCHEMA}, batch long"
_NAMES = [part.split()[0] for part in LOG_SCHEMA.split(", ")]


class _Streams(StreamingQueryListener):
    def __init__(self, log: CallLog) -> None:
        self.log = log
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        metrics = {} if p.observedMetrics is None else {n: r.asDict() for n, r in p.observedMetrics.items()}
        self.log.add(request=p.name or str(p.id), operation="stream", duration_ms=float(p.durationMs.get("triggerExecution", 0)),
                     took_ms=float(p.durationMs.get("addBatch", 0)), ops=p.numInputRows, batch=p.batchId, **_observed(metrics, with_ops=False))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        name = self.names.pop(run, run)
        if event.exception is not None:
            self.log.add(request=name, operation="stream", error=event.errorClassOnException or event.exception.split("\n")[0][:200])
        self.log.ended(run)


class _Actions:
    """Spark's listener of DataFrame actions, which PySpark has no class for."""

    def __init__(self, log: CallLog) -> None:
        self.log = log

    def onSuccess(self, name: str, execution, nanoseconds: int) -> None:
        metrics, rows = {}, execution.observedMetrics().iterator()
        while rows.hasNext():
            pair = rows.next()
            row = pair._2()
            metrics[pair._1()] = {n: row.get(k) for k, n in enumerate(row.schema().fieldNames())}
        self.log.action(name, nanoseconds / 1e6, metrics, None)

    def onFailure(self, name: str, execution, exception) -> None:
        if self.log.path not in execution.logical().toString():  # the log's own write
            self.log.action(name, None, {}, exception.getClass().getSimpleName())

    class Java:
        implements = ["org.apache.spark.sql.util.QueryExecutionListener"]


def _observed(metrics: dict[str, dict], with_ops: bool = True) -> dict:
    found: dict = {}
    for name, values in metrics.items():
        for key in ("hits", "ops") if with_ops else ("hits",):
            if values.get(key) is not None:
                found["index"] = name
                found[key] = int(values[key])
    return found


class CallLog:
    """Records the session's calls while it is open (a context manager): micro-batches, and those DataFrame actions that observed
    ``hits`` or ``ops`` or failed (``actions=False`` leaves these out)."""

    def __init__(self, spark: SparkSession, path: str, request: str, *, limit: int = 1000, actions: bool = True) -> None:
        if limit < 1:
            raise ValueError("the driver holds one row at least")
        self.spark, self.path, self.request, self.limit = spark, path, request, limit
        self.rows: list[dict] = []
        self.written = 0
        self._change = threading.Condition()
        self._ended: set[str] = set()
        self._streams, self._actions = _Streams(self), _Actions(self) if actions else None
        self._writing = threading.Lock()

    def __enter__(self) -> CallLog:
        self.spark.streams.addListener(self._streams)
        if self._actions is not None:
            self.spark._jsparkSession.listenerManager().register(self._actions)
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def add(self, **row) -> None:
        with self._change:
            self.rows.append(row)
            full = len(self.rows) >= self.limit
        if full:
            self.save()

    def action(self, name: str, duration_ms: float | None, metrics: dict[str, dict], error: str | None) -> None:
        found = _observed(metrics)
        if found or error is not None:
            self.add(request=self.request, operation="search" if "hits" in found else "bulk" if found else name,
                     duration_ms=duration_ms, took_ms=duration_ms, error=error, **found)

    def ended(self, run: str) -> None:
        with self._change:
            self._ended.add(run)
            self._change.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all rows of a stream that has ended are here."""
        run = str(query.runId)
        with self._change:
            if not self._change.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"no end of stream {run} was reported")

    def wait_rows(self, n: int, seconds: float = 60) -> None:
        """Until ``n`` rows were recorded in all."""
        until = time.monotonic() + seconds
        while self.written + len(self.rows) < n:
            if time.monotonic() > until:
                raise TimeoutError(f"{self.written + len(self.rows)} of {n} calls were reported")
            time.sleep(0.05)

    def save(self) -> None:
        """Append what is held to the log."""
        with self._writing:
            with self._change:
                rows, self.rows = self.rows, []
            if not rows:
                return
            tuples = [tuple(([] if n == "aggregations" else r.get(n)) for n in _NAMES) for r in rows]
            try:
                small_frame(self.spark, tuples, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            except Exception:
                with self._change:
                    self.rows = rows + self.rows  # kept for the next try
                raise
            self.written += len(rows)

    def close(self) -> None:
        self.spark.streams.removeListener(self._streams)
        if self._actions is not None:
            self.spark._jsparkSession.listenerManager().unregister(self._actions)
        self.save()

    def read(self) -> DataFrame:
        """The log; a micro-batch that was run again after a failure counts once."""
        log = self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
        again = log.where("batch IS NOT NULL").dropDuplicates(["request", "batch"])
        return log.where("batch IS NULL").unionByName(again)
