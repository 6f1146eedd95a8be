"""Batch pipeline (L1): counters and report rows equal real row counts; strict mode fails."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sortlane.functions import codec
from sortlane.plans import batch
from sortlane.plans.batch import run_batch
from sortlane.session import ensure_checkpoint_dir, list_folder, work_path
from sortlane.sources import fixtures
from sortlane.sources.log import list_topics, read_log


def test_counters_and_report_match_the_data(spark):
    dirty = fixtures.dirty_log(spark, SF_SMALL)
    run = run_batch(spark, dirty, on_error="skip")
    log = run.log(spark)
    n_src = dirty.count()
    n_ok = codec.decode_tolerant(dirty).count()
    assert run.counters == {"generated": 0, "consumed": n_src, "rejected": n_src - n_ok,
                            "sorted": 3 * n_ok, "produced": 3 * n_ok,
                            "generation_errors": 0, "sorting_errors": 0, "production_errors": 0}
    per_topic = {r[0]: r[1] for r in log.groupBy("topic").count().collect()}
    assert per_topic == {"source": n_src, "id": n_ok, "name": n_ok, "continent": n_ok}
    report = {r["stage"]: r["rows"] for r in run.report_frame(spark).collect()}
    assert report["snapshot"] == n_src and report["overall"] == 3 * n_ok
    assert all(report[f"{s}_{k}"] == n_ok for s in ("sort", "publish") for k in ("id", "name", "continent"))
    counters = {r["counter"]: r["value"] for r in run.counters_frame(spark).collect()}
    assert counters == run.counters


def test_strict_batch_fails_on_bad_line(spark):
    with pytest.raises(PySparkException):
        run_batch(spark, fixtures.dirty_log(spark, SF_SMALL), on_error="fail")


def test_rerun_into_same_folder_replaces_topics(spark):
    out = work_path(spark, "rerun")
    src = fixtures.log(spark, SF_SMALL)
    first = run_batch(spark, src, out=out)
    again = run_batch(spark, src, out=out)
    a = first.log(spark).where(F.col("topic") != "source").count()
    b = again.log(spark).where(F.col("topic") != "source").count()
    assert a == b == 3 * src.count()


def test_generated_source_by_count_equals_by_ids(spark):
    by_count = run_batch(spark, records=1500, seed=5).log(spark)
    by_ids = run_batch(spark, ids=spark.range(0, 1500, 1, 3).withColumnRenamed("id", "rid"), seed=5).log(spark)
    cols = ["topic", "partition", "offset", "value"]
    assert sorted(map(tuple, by_count.select(*cols).collect())) == sorted(map(tuple, by_ids.select(*cols).collect()))


def _appended(log):
    """Messages per sorted topic, with dense offsets per partition."""
    counts = {}
    for r in log.where(F.col("topic") != "source").groupBy("topic", "partition").agg(
            F.count("*").alias("n"), F.min("offset").alias("lo"), F.max("offset").alias("hi"),
            F.countDistinct("offset").alias("d")).collect():
        assert r["lo"] == 0 and r["hi"] == r["n"] - 1 == r["d"] - 1
        counts[r["topic"]] = counts.get(r["topic"], 0) + r["n"]
    return counts


def test_consumer_group_appends_and_commits_after_the_last_publish(spark):
    src = fixtures.log(spark, SF_SMALL)
    offsets, out = work_path(spark, "offsets"), work_path(spark, "group")
    for k in range(1, 4):
        run = run_batch(spark, src, out=out, consume=300, group="g", offsets_path=offsets)
        assert run.counters["consumed"] == 300 and run.seq == k - 1
        assert _appended(run.log(spark)) == {"id": 300 * k, "name": 300 * k, "continent": 300 * k}
    _, committed = batch.committed_offsets(spark, offsets, "g")
    # 900 messages taken in (partition, offset) order: partition 0 (250) ... then 1, 2, 3
    assert {r["partition"]: r["next_offset"] for r in committed.collect()} == {0: 250, 1: 250, 2: 250, 3: 150}
    # Another group is untouched by this one's commits.
    assert batch.committed_offsets(spark, offsets, "other")[0] == 0


@pytest.mark.parametrize("at", ["sort_records", "_observed_write", "_commit"])
def test_a_crash_loses_and_doubles_nothing(spark, monkeypatch, at):
    src = fixtures.log(spark, SF_SMALL)
    offsets, out, report = (work_path(spark, n) for n in ("offsets", "crash", "report"))
    run_batch(spark, src, out=out, consume=200, group="g", offsets_path=offsets)
    real, calls = getattr(batch, at), []

    def failing(*a, **k):
        calls.append(1)
        if len(calls) >= (2 if at == "_observed_write" else 1):
            raise OSError("planted")
        return real(*a, **k)

    monkeypatch.setattr(batch, at, failing)
    with pytest.raises(OSError):
        run_batch(spark, src, out=out, consume=300, group="g", offsets_path=offsets, report_path=report)
    monkeypatch.setattr(batch, at, real)
    errors = {r["counter"]: r["value"] for r in spark.read.parquet(report + "-counters").collect()}
    assert errors["sorting_errors"] >= (at == "sort_records") and errors["production_errors"] >= (at == "_observed_write")
    run = run_batch(spark, src, out=out, group="g", offsets_path=offsets)
    n = src.count()
    assert run.counters["consumed"] == n - 200
    assert _appended(run.log(spark)) == {"id": n, "name": n, "continent": n}
    lines = run.log(spark).where(F.col("topic") == "id").select("value")
    assert lines.exceptAll(src.select("value")).count() == src.select("value").exceptAll(lines).count() == 0


def test_fewer_messages_than_asked_for(spark):
    src = fixtures.log(spark, SF_SMALL)
    offsets, out = work_path(spark, "offsets"), work_path(spark, "short")
    n = src.count()
    with pytest.raises(batch.ShortRead):
        run_batch(spark, src, out=out, consume=n + 1, group="g", offsets_path=offsets)
    assert batch.committed_offsets(spark, offsets, "g")[0] == 0 and list_folder(spark, out) == []
    assert run_batch(spark, src, out=out, consume=n + 1, on_short="accept").counters["consumed"] == n


def test_skip_generate_in_place_counts_the_source_once(spark):
    out = work_path(spark, "place")
    run_batch(spark, records=100, out=out)
    run = run_batch(spark, read_log(spark, out), out=out)
    assert run.log(spark).where(F.col("topic") == "source").count() == 100


def test_work_folder_is_empty_afterwards_and_topics_can_be_renamed(spark):
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/work"
    before = set(list_folder(spark, root))
    out = work_path(spark, "named")
    run = run_batch(spark, records=200, out=out, source_topic="in", sorted_topics=["a", "b", "c"], num_buckets=3)
    assert list_topics(spark, out) == ["a", "b", "c", "in"]
    assert {r["topic"]: r["count"] for r in run.log(spark).groupBy("topic").count().collect()} == dict.fromkeys(
        ["a", "b", "c", "in"], 200)
    assert set(list_folder(spark, root)) - before == {out.rsplit("/", 1)[1]}


def test_storage_errors_are_not_an_empty_offset_table(spark, monkeypatch):
    def broken(spark, path):
        raise PermissionError("no access")

    monkeypatch.setattr(batch, "list_folder", broken)
    with pytest.raises(PermissionError):
        batch.committed_offsets(spark, "/nowhere", "g")
