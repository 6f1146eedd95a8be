"""Stream metrics by listener, and continuous runs that end cleanly."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sortlane.session import work_path
from sortlane.sources import fixtures
from sortlane.streaming import arrivals
from sortlane.streaming.monitor import StreamMetrics, run_until
from sortlane.streaming.runs import StreamRuns, start_stream

CUTS = [0, 60, 130, 250]


@pytest.fixture()
def place(spark):
    base = work_path(spark, "monitor")
    return f"{base}/source", f"{base}/state", f"{base}/checkpoint", f"{base}/metrics"


def test_events_of_a_failure_and_a_restart(spark, place, monkeypatch):
    source, state, checkpoint, saved = place
    log = fixtures.dirty_log(spark, SF_SMALL)
    arrivals.write_arrivals(log, source, CUTS)
    runner, process = StreamRuns(state, 20), StreamRuns.process

    def broken(self, batch, batch_id):
        if batch_id == 1:
            raise OSError("planted")
        process(self, batch, batch_id)

    with StreamMetrics(spark) as metrics:
        monkeypatch.setattr(StreamRuns, "process", broken)
        query = start_stream(spark, source, runner, checkpoint, files_per_trigger=arrivals.FILES)
        with pytest.raises(StreamingQueryException):
            query.awaitTermination()
        assert metrics.wait_for_end(query.runId)
        monkeypatch.setattr(StreamRuns, "process", process)
        again = start_stream(spark, source, runner, checkpoint, files_per_trigger=arrivals.FILES)
        again.awaitTermination()
        assert metrics.wait_for_end(again.runId)
    events = metrics.table().orderBy("seq").collect()
    assert [e["event"] for e in events if e["event"] != "batch"] == ["started", "failed", "started", "stopped"]
    failed = next(e for e in events if e["event"] == "failed")
    assert failed["batch_id"] == 1 and failed["error"] and failed["run"] == str(query.runId)
    per = {r["batch_id"]: r for r in metrics.per_batch(runner).collect()}
    assert sorted(per) == [0, 1, 2] and [per[b]["failures"] for b in range(3)] == [0, 1, 0]
    assert sum(r["consumed"] for r in per.values()) == log.count()
    assert all(r["seconds"] >= r["work_seconds"] > 0 and r["rows_per_s"] > 0 for r in per.values())
    metrics.save(saved)
    assert spark.read.parquet(saved).count() == len(events) and metrics.table().count() == 0


def test_a_continuous_run_ends_with_everything_published(spark, place):
    source, state, checkpoint, _ = place
    log = fixtures.dirty_log(spark, SF_SMALL)
    runner, sent = StreamRuns(state, 20), [0]

    def stop():
        if sent[0] < 3:
            arrivals.write_arrivals(log, source, CUTS, first=sent[0], last=sent[0], files=1)
            sent[0] += 1
            return False
        return True

    arrivals.write_arrivals(log, source, CUTS, first=0, last=0, files=1)
    sent[0] = 1
    flushed = run_until(spark, source, runner, checkpoint, stop, files_per_trigger=1)
    out = runner.output(spark, include_flush=True)
    assert flushed > 0 and out.count() == 3 * runner.staged(spark).count()
    assert runner.progress(spark).agg(F.sum("consumed")).first()[0] == log.count()
    assert rows(out.where("sort_key = 'id'"), "src_partition", "src_offset") == rows(runner.staged(spark), "partition", "offset")
    assert not spark.streams.active


def test_a_failing_continuous_run_is_raised_and_goes_on_later(spark, place, monkeypatch):
    source, state, checkpoint, _ = place
    arrivals.write_arrivals(fixtures.dirty_log(spark, SF_SMALL), source, CUTS, files=1)
    runner, process = StreamRuns(state, 20), StreamRuns.process

    def broken(self, batch, batch_id):
        if batch_id == 1:
            raise OSError("planted")
        process(self, batch, batch_id)

    monkeypatch.setattr(StreamRuns, "process", broken)
    with pytest.raises(StreamingQueryException):
        run_until(spark, source, runner, checkpoint, lambda: False, files_per_trigger=1)
    assert runner.last_committed(spark) == 0
    monkeypatch.setattr(StreamRuns, "process", process)
    run_until(spark, source, runner, checkpoint, lambda: runner.last_committed(spark) == 2, files_per_trigger=1)
    assert runner.output(spark, include_flush=True).count() == 3 * runner.staged(spark).count()
