"""Bounded reads of a stream that wait for their messages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sortlane.session import list_folder, work_path
from sortlane.sources import fixtures
from sortlane.sources.log import read_first_n
from sortlane.streaming import arrivals
from sortlane.streaming.bounded import BoundedReader, StillWaiting
from sortlane.streaming.runs import stream_reader

CUTS = [0, 40, 41, 120, 250]


def in_order(spark):
    """Messages of the small log in order of arrival, partition and offset."""
    got = fixtures.log(spark, SF_SMALL).withColumn("a", arrivals.arrival_of(F.col("offset"), CUTS)).collect()
    return [(r["partition"], r["offset"]) for r in sorted(got, key=lambda r: (r["a"], r["partition"], r["offset"]))]


def batches(spark):
    log = fixtures.log(spark, SF_SMALL).withColumn("a", arrivals.arrival_of(F.col("offset"), CUTS))
    return [log.where(F.col("a") == k).drop("a") for k in range(len(CUTS) - 1)]


def keys(df):
    return rows(df, "partition", "offset")


@pytest.mark.parametrize("sizes", [[1, 159, 4, 5, 831], [500, 0, 500]])
def test_reads_follow_each_other_exactly(spark, sizes):
    """Batches given by hand: every read takes the next messages in order of arrival, across any cut."""
    reader, todo, want, at = BoundedReader(work_path(spark, "bounded")), list(enumerate(batches(spark))), in_order(spark), 0
    for n in sizes:
        reader._begin(spark, n)
        while reader.state(spark)[1]["taken"] < n:
            k, batch = todo.pop(0)
            reader.process(batch, k)
            reader.process(batch, k)  # replayed: nothing changes
        assert keys(reader.taken(spark)) == sorted(want[at:at + n])
        at += n
    assert at == 1000 and not todo


def test_a_batch_replayed_before_its_version_writes_the_same(spark, monkeypatch):
    reader, parts = BoundedReader(work_path(spark, "bounded")), batches(spark)
    reader._begin(spark, 100)
    move = BoundedReader._move
    monkeypatch.setattr(BoundedReader, "_move", lambda *a, **k: (_ for _ in ()).throw(OSError("planted")))
    with pytest.raises(OSError):
        reader.process(parts[0], 0)
    monkeypatch.setattr(BoundedReader, "_move", move)
    assert reader.state(spark)[1]["taken"] == 0
    reader.process(parts[0], 0)
    assert keys(reader.taken(spark)) == sorted(in_order(spark)[:100])
    assert reader.state(spark)[1]["left"][0][1] == 60


def test_waits_stops_and_goes_on(spark):
    base, want = work_path(spark, "waits"), in_order(spark)
    log = fixtures.log(spark, SF_SMALL)
    reader, source = BoundedReader(f"{base}/state"), f"{base}/source"
    arrivals.write_arrivals(log, source, CUTS, last=1, files=1)
    stream = stream_reader(spark, source, files_per_trigger=1)
    with pytest.raises(StillWaiting):
        reader.read(stream, 200, f"{base}/checkpoint", timeout=8)
    assert reader.state(spark)[1]["taken"] == 164
    with pytest.raises(ValueError):
        reader.read(stream, 300, f"{base}/checkpoint")
    arrivals.write_arrivals(log, source, CUTS, first=2, files=1)
    assert keys(reader.read(stream, 200, f"{base}/checkpoint", timeout=120)) == sorted(want[:200])
    assert keys(reader.read(stream, 800, f"{base}/checkpoint", timeout=120)) == sorted(want[200:])
    assert not spark.streams.active
    assert reader.state(spark)[1]["left"] == [] and list_folder(spark, f"{base}/state/out")


def test_a_failing_batch_is_raised(spark, monkeypatch):
    base = work_path(spark, "fails")
    arrivals.write_arrivals(fixtures.log(spark, SF_SMALL), f"{base}/source", CUTS, last=0, files=1)

    def broken(self, batch, batch_id):
        raise OSError("planted")

    monkeypatch.setattr(BoundedReader, "process", broken)
    with pytest.raises(Exception, match="planted"):
        BoundedReader(f"{base}/state").read(stream_reader(spark, f"{base}/source"), 5, f"{base}/checkpoint", timeout=60)


@pytest.mark.parametrize("block", [1, 64, 1 << 16])
def test_first_n_for_any_block(spark, block):
    log = fixtures.log(spark, SF_SMALL).withColumn("offset", F.col("offset") * 3)
    want = sorted((r["partition"], r["offset"]) for r in log.collect())
    for n in (0, 1, 250, 777, 2000):
        assert keys(read_first_n(log, "source", n, block)) == want[:n]
