"""Metrics of streams by listener (M8, A4), and continuous runs that end cleanly (M7).

A listener keeps one row per event of its queries: start, micro-batch (rows,
seconds by stage, rate), and end with its error, so that restarts and failed
attempts are counted as well as batches.  Joined with the counters that the
stream itself commits per batch, it says how long each batch took and how often
it was tried.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.tables import small_table
from .runs import StreamRuns, start_stream

EVENT_SCHEMA = ("event string, query string, run string, batch_id bigint, rows bigint, seconds double, "
                "read_seconds double, work_seconds double, commit_seconds double, rows_per_s double, error string")


class StreamMetrics(StreamingQueryListener):
    """Events of the session's streaming queries while it is listening."""

    def __init__(self, spark: SparkSession):
        super().__init__()
        self.spark, self.events = spark, []
        self._lock, self._ended, self._batch = threading.Condition(), set(), {}

    def __enter__(self) -> "StreamMetrics":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def _put(self, event: str, query, run, batch=None, rows=None, seconds=None, read=None, work=None, commit=None, error=None) -> None:
        rate = rows / seconds if rows is not None and seconds else None
        with self._lock:
            self.events.append((event, str(query), str(run), batch, rows, seconds, read, work, commit, rate, error))
            if event in ("stopped", "failed"):
                self._ended.add(str(run))
            self._lock.notify_all()

    def onQueryStarted(self, event) -> None:
        self._put("started", event.id, event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        took = lambda *names: sum(p.durationMs.get(n, 0) for n in names) / 1000
        self._batch[str(p.id)] = p.batchId
        self._put("batch", p.id, p.runId, p.batchId, p.numInputRows, p.batchDuration / 1000,
                  took("latestOffset", "getBatch", "queryPlanning"), took("addBatch"), took("walCommit", "commitOffsets", "commitBatch"))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        # A query fails in the batch after the last one that it finished.
        failed = None if event.exception is None else self._batch.get(str(event.id), -1) + 1
        error = None if event.exception is None else event.exception.strip().splitlines()[0][:500]
        self._put("failed" if event.exception else "stopped", event.id, event.runId, failed, error=error)

    def wait_for_end(self, run, timeout: float = 60.0) -> bool:
        """Wait until the end of a query's run has been reported; events come after the query."""
        with self._lock:
            return self._lock.wait_for(lambda: str(run) in self._ended, timeout)

    def table(self) -> DataFrame:
        """One row per event, in order (as many as batches and starts while listening)."""
        with self._lock:
            rows = [(i, *e) for i, e in enumerate(self.events)]
        return small_table(self.spark, rows, f"seq bigint, {EVENT_SCHEMA}")

    def save(self, path: str) -> None:
        """Append the events so far to a table and forget them."""
        table = self.table()
        with self._lock:
            self.events.clear()
        table.coalesce(1).write.mode("append").parquet(path)

    def per_batch(self, runner: StreamRuns) -> DataFrame:
        """The stream's committed counters with each batch's seconds, rate and failed attempts."""
        events = self.table()
        done = events.where("event = 'batch'").groupBy("batch_id").agg(
            F.max_by("seconds", "seq").alias("seconds"), F.max_by("work_seconds", "seq").alias("work_seconds"))
        failed = events.where("event = 'failed'").groupBy("batch_id").agg(F.count(F.lit(1)).alias("failures"))
        return runner.progress(self.spark).join(done, "batch_id", "left").join(failed, "batch_id", "left").withColumn(
            "failures", F.coalesce("failures", F.lit(0)).cast("bigint")).withColumn(
            "rows_per_s", F.when(F.col("seconds") > 0, F.col("consumed") / F.col("seconds")))


def run_until(spark: SparkSession, source: str, runner: StreamRuns, checkpoint: str, stop: Callable[[], bool], *,
              trigger: str = "500 milliseconds", flush: bool = True, poll: float = 0.2, **reader) -> int:
    """M7: run continuously until ``stop()`` says so, work off what has arrived, and
    publish the open runs (M6); returns the rows flushed.  ``reader``: as for ``start_stream``.

    A failing query is raised at once; its committed batches stay, and the next
    run goes on from its checkpoint.
    """
    query = start_stream(spark, source, runner, checkpoint, available_now=False, processing_time=trigger, **reader)
    try:
        while query.isActive and not stop():
            time.sleep(poll)
        if query.isActive:
            query.processAllAvailable()
    finally:
        error = query.exception()
        query.stop()
    if error is not None:
        raise error
    return runner.flush_open_runs(spark) if flush else 0
