"""Versioned publishing: all topics and offsets of a publication, or none of them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sortlane.plans import batch
from sortlane.plans.batch import run_batch
from sortlane.session import list_folder, work_path
from sortlane.sinks import versions
from sortlane.sinks.publish import write_log
from sortlane.sinks.versions import Publication, VersionConflict, publish_atomic, read_version
from sortlane.sources import fixtures
from sortlane.sources.log import list_topics, read_log


def messages(spark, topic, n, first=0):
    return spark.range(first, first + n).select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit(None).cast("string").alias("key"), F.col("id").cast("string").alias("value"))


def counts(log):
    return {r["topic"]: r["count"] for r in log.groupBy("topic").count().collect()}


def test_versions_replace_append_and_stay_readable(spark):
    base = work_path(spark, "v")
    assert publish_atomic(spark, base, {"a": messages(spark, "a", 3), "b": messages(spark, "b", 2)}) == 0
    pinned = read_log(spark, base)
    assert publish_atomic(spark, base, {"a": messages(spark, "a", 4, 3), "b": messages(spark, "b", 5)}, append=["a"],
                          groups={"g": {"runs": 1, "offsets": [["a", 0, 7]]}}) == 1
    assert counts(read_log(spark, base)) == {"a": 7, "b": 5} and counts(pinned) == {"a": 3, "b": 2}
    assert counts(read_version(spark, base, 0)) == {"a": 3, "b": 2}
    assert publish_atomic(spark, base, {"c": messages(spark, "c", 0)}) == 2
    assert list_topics(spark, base) == ["a", "b", "c"] and list_topics(spark, base, 0) == ["a", "b"]
    assert versions.read_state(spark, f"{base}/_versions")[1]["groups"] == {"g": {"runs": 1, "offsets": [["a", 0, 7]]}}


@pytest.mark.parametrize("at", [1, 2, 3, "state"])
def test_a_crash_at_any_step_leaves_the_old_version(spark, monkeypatch, at):
    base = work_path(spark, "crash")
    publish_atomic(spark, base, {t: messages(spark, t, 2) for t in "abc"})
    calls, write, create = [], Publication.write, versions.create_state

    def failing(self, *a, **k):
        calls.append(1)
        out = write(self, *a, **k)
        if len(calls) == at:
            raise OSError("planted")
        return out

    def no_state(*a, **k):
        raise OSError("planted")

    monkeypatch.setattr(Publication, "write", failing)
    if at == "state":
        monkeypatch.setattr(versions, "create_state", no_state)
    with pytest.raises(OSError):
        publish_atomic(spark, base, {t: messages(spark, t, 9) for t in "abc"})
    monkeypatch.setattr(Publication, "write", write)
    monkeypatch.setattr(versions, "create_state", create)
    assert counts(read_log(spark, base)) == dict.fromkeys("abc", 2)
    assert all(len(list_folder(spark, f"{base}/data/topic={t}")) == 1 for t in "abc")
    assert publish_atomic(spark, base, {t: messages(spark, t, 9) for t in "abc"}) == 1


def test_of_two_writers_one_is_refused(spark):
    base = work_path(spark, "two")
    publish_atomic(spark, base, {"a": messages(spark, "a", 1)})
    one, two = Publication(spark, base), Publication(spark, base)
    one.write(messages(spark, "a", 5), "a")
    two.write(messages(spark, "a", 7), "a")
    assert two.commit() == 1
    with pytest.raises(VersionConflict):
        one.commit()
    assert counts(read_log(spark, base)) == {"a": 7}
    assert len(list_folder(spark, f"{base}/data/topic=a")) == 2  # the refused writer's folder is gone
    with pytest.raises(VersionConflict):
        versions.create_state(spark, f"{base}/_versions", 5, {})
    with pytest.raises(VersionConflict):
        versions.create_state(spark, f"{base}/_versions", 1, {})


def test_topics_written_without_versions_are_taken_over(spark):
    base = work_path(spark, "old")
    write_log(messages(spark, "source", 6), base, topic="source")
    assert counts(read_log(spark, base)) == {"source": 6}
    publish_atomic(spark, base, {"id": messages(spark, "id", 4)})
    publish_atomic(spark, base, {"source": messages(spark, "source", 2, 6)}, append=["source"])
    assert counts(read_log(spark, base)) == {"source": 8, "id": 4}


def test_old_data_is_removed_only_when_no_kept_version_names_it(spark):
    base = work_path(spark, "old-data")
    for n in range(1, 5):
        publish_atomic(spark, base, {"a": messages(spark, "a", n), "b": messages(spark, "b", 1)}, append=["b"])
    assert versions.remove_old_versions(spark, base, keep=2) == []  # too young
    gone = versions.remove_old_versions(spark, base, keep=2, older_than=0)
    assert len(gone) == 2 and all("topic=a" in g for g in gone)
    assert counts(read_log(spark, base)) == {"a": 4, "b": 4} and counts(read_version(spark, base, 2)) == {"a": 3, "b": 3}


def test_two_jobs_of_one_group_lose_and_double_nothing(spark, monkeypatch):
    """A job finishes while another of its group is at work: the slower one is refused."""
    src, out = fixtures.log(spark, SF_SMALL), work_path(spark, "jobs")
    commit, nested = batch._commit, []

    def slow(*a, **k):
        monkeypatch.setattr(batch, "_commit", commit)
        nested.append(run_batch(spark, src, out=out, consume=300, group="g"))
        return commit(*a, **k)

    monkeypatch.setattr(batch, "_commit", slow)
    with pytest.raises(VersionConflict):
        run_batch(spark, src, out=out, consume=500, group="g")
    assert counts(read_log(spark, out)) == {"id": 300, "name": 300, "continent": 300}
    rest = run_batch(spark, src, out=out, group="g")
    n = src.count()
    assert rest.counters["consumed"] == n - 300 and counts(read_log(spark, out)) == {"id": n, "name": n, "continent": n}
    ids = read_log(spark, out).where("topic = 'id'")
    assert rows(ids, "value") == rows(src, "value")


def test_readers_never_see_a_part_of_a_run(spark, monkeypatch):
    """Between the topics' writes and the version, the table is as it was."""
    src, out, seen = fixtures.log(spark, SF_SMALL), work_path(spark, "parts"), []
    run_batch(spark, src, out=out, consume=100, group="g")
    write = Publication.write

    def watched(self, *a, **k):
        n = write(self, *a, **k)
        seen.append(counts(read_log(spark, out)))
        return n

    monkeypatch.setattr(Publication, "write", watched)
    run_batch(spark, src, out=out, group="g")
    assert len(seen) == 3 and all(s == {"id": 100, "name": 100, "continent": 100} for s in seen)
