"""Incremental compaction of streamed runs: one total order, only changed ranges touched."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sortlane.operators.checks import check_sorted
from sortlane.session import list_folder, work_path
from sortlane.sinks.versions import VersionConflict
from sortlane.streaming import compact
from sortlane.streaming.compact import Compactor, order_columns, slot_of
from sortlane.streaming.runs import OUT_COLUMNS, OUT_SCHEMA, StreamRuns

KEYS = {"id": lambda r: (r[0],), "name": lambda r: (r[1].encode(), r[0]), "continent": lambda r: (r[2].encode(), r[0])}


class Batches(StreamRuns):
    """Streamed output made by hand: ``put`` commits a batch of (id, name, continent) records."""

    def put(self, spark, records):
        self.records = [*getattr(self, "records", [])]
        b = getattr(self, "batch", -1) + 1
        rows = []
        for k in ("id", "name", "continent"):
            for i, (rid, name, continent) in enumerate(records):
                at = len(self.records) + i
                rows.append((k, 0, b, i, rid, name, "addr", continent, at, k, 0, at, f"0-{b}-{i}", f"{rid},{name},addr,{continent}"))
        if rows:
            spark.createDataFrame(rows, OUT_SCHEMA).select(*OUT_COLUMNS).write.parquet(self._batch_dir("out", b))
        self.records += records
        self.batch = b

    def last_committed(self, spark):
        return getattr(self, "batch", None)


def truth(runner, topic):
    order = sorted(enumerate(runner.records), key=lambda x: (*KEYS[topic](x[1]), x[0]))
    return [(pos, f"{r[0]},{r[1]},addr,{r[2]}") for pos, (_, r) in enumerate(order)]


def stored(spark, c, topic):
    return sorted((r["pos"], r["value"]) for r in c.ordered(spark, topic).collect())


def some(rng, n, lo=0, hi=10**6):
    return [(rng.randrange(lo, hi), rng.choice(["ann", "bob", "Zoë", "élan"]), rng.choice(["Asia", "Africa", "Europe"])) for _ in range(n)]


@pytest.mark.parametrize("ratio, segment_rows", [(0.0, 7), (0.5, 20), (100.0, 5)])
def test_any_batches_give_the_total_order(spark, ratio, segment_rows):
    rng = random.Random(segment_rows)
    runner = Batches(work_path(spark, "compact"), 10)
    c = Compactor(runner, segment_rows, ratio)
    for n, topic in ((30, "id"), (0, "name"), (13, "continent"), (40, "name")):
        runner.put(spark, some(rng, n))
        done = c.compact(spark)
        assert stored(spark, c, topic) == truth(runner, topic)
        sizes = [s.rows for s in c.state(spark)[2][topic] if s.folder]
        assert max(sizes) <= 2 * segment_rows or ratio == 100.0
        assert done.rows_new.get("id", 0) == n
    c.compact(spark, everything=True)
    assert not any(s.pending for xs in c.state(spark)[2].values() for s in xs)
    assert all(stored(spark, c, t) == truth(runner, t) for t in KEYS)


def test_only_changed_ranges_are_read_and_written(spark):
    rng = random.Random(2)
    runner = Batches(work_path(spark, "compact"), 10)
    c = Compactor(runner, 50, 0.0)
    runner.put(spark, some(rng, 1000))
    first = c.compact(spark)
    assert first.rows_read["id"] == 0 and len(c.state(spark)[2]["id"]) == 20
    before = c.state(spark)[2]["id"]
    lo, hi = before[4].low[0], before[5].low[0]
    runner.put(spark, some(rng, 30, lo + 1, hi))  # ids inside one segment
    again = c.compact(spark)
    after = c.state(spark)[2]["id"]
    assert again.rewritten["id"] == 1 and again.kept["id"] == 19 and again.rows_read["id"] == 50
    assert [f for f in again.folders_read if "topic=id" in f] == [before[4].folder]
    same = [s.folder for s in before[:4] + before[5:]]
    assert [s.folder for s in after if s.folder in same] == same
    assert all(stored(spark, c, t) == truth(runner, t) for t in KEYS)
    # The store's files are those of the segments named, and no streamed batch.
    files = c.ordered(spark, "id").inputFiles()
    assert files and not any("/out/" in f for f in files)
    # Nothing new: nothing is done.
    assert c.compact(spark).version == again.version
    gone = c.remove_old(spark)
    assert gone == [] or all("gen=0" in g for g in gone)
    assert all(stored(spark, c, t) == truth(runner, t) for t in KEYS)


def test_few_rows_wait_beside_their_segment(spark):
    rng = random.Random(3)
    runner = Batches(work_path(spark, "compact"), 10)
    c = Compactor(runner, 50, 0.2)
    runner.put(spark, some(rng, 500))
    c.compact(spark)
    before = c.state(spark)[2]["id"]
    runner.put(spark, some(rng, 8))
    assert c.compact(spark).rows_read["id"] == 0 and stored(spark, c, "id") == truth(runner, "id")
    runner.put(spark, some(rng, 12, before[4].low[0] + 1, before[5].low[0]))  # ids inside one segment
    assert c.compact(spark).rows_read["id"] < 100 and stored(spark, c, "id") == truth(runner, "id")
    segments = c.state(spark)[2]["id"]
    assert 0 < sum(s.waiting() for s in segments) <= 8
    assert {s.folder for s in before} - {s.folder for s in segments} == {before[4].folder}
    assert stored(spark, c, "continent") == truth(runner, "continent")


def test_a_settled_segment_is_read_without_a_sort(spark):
    runner = Batches(work_path(spark, "compact"), 10)
    c = Compactor(runner, 50, 0.0)
    runner.put(spark, some(random.Random(4), 300))
    c.compact(spark)
    plan = c.ordered(spark, "name")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan


def test_a_crash_and_a_second_compactor(spark, monkeypatch):
    rng = random.Random(5)
    runner = Batches(work_path(spark, "compact"), 10)
    one, two = Compactor(runner, 50), Compactor(runner, 50)
    runner.put(spark, some(rng, 100))
    create = compact.create_state
    monkeypatch.setattr(compact, "create_state", lambda *a: (_ for _ in ()).throw(OSError("planted")))
    with pytest.raises(OSError):
        one.compact(spark)
    assert one.state(spark)[0] == -1 and list_folder(spark, f"{one.base}/merged/gen=0") == []

    def slow(spark_, folder, number, content):
        monkeypatch.setattr(compact, "create_state", create)
        two.segment_rows = 30
        monkeypatch.setattr(two, "base", one.base)
        create(spark_, folder, number, {"upto": -1, "topics": {}})  # another one was first
        return create(spark_, folder, number, content)

    monkeypatch.setattr(compact, "create_state", slow)
    with pytest.raises(VersionConflict):
        one.compact(spark)
    one.compact(spark)
    assert all(stored(spark, one, t) == truth(runner, t) for t in KEYS)


def test_compacted_topics_pass_the_order_checks(spark):
    runner = Batches(work_path(spark, "compact"), 10)
    c = Compactor(runner, 40)
    for n in (120, 90):
        runner.put(spark, some(random.Random(n), n))
        c.compact(spark)
    log = c.log(spark).cache()
    for t in KEYS:
        assert all(r["ok"] for r in check_sorted(log, t).collect())
        offsets = [(r["partition"], r["offset"]) for r in log.where(F.col("topic") == t).collect()]
        assert sorted(offsets) == sorted({(p * 4 // 210, p - -(-(p * 4 // 210) * 210 // 4)) for p in range(210)})
    assert log.where("topic = 'id'").select("key").distinct().count() == 210


def test_slots_equal_counting_fences(spark):
    rng = random.Random(6)
    for topic in KEYS:
        key = order_columns(topic)
        rows = [(rng.randrange(20), rng.choice("abé'\""), rng.choice("xyz"), rng.randrange(2), rng.randrange(5)) for _ in range(200)]
        df = spark.createDataFrame(rows, "id int, name string, continent string, src_partition int, src_offset bigint")
        for m in (0, 1, 2, 7, 16):
            fences = sorted(set(tuple(r) for r in df.select(*key).limit(m).collect()), key=lambda k: tuple(
                x.encode() if isinstance(x, str) else x for x in k))
            got = df.select(*key, slot_of(key, [list(f) for f in fences]).alias("slot")).collect()
            enc = lambda k: tuple(x.encode() if isinstance(x, str) else x for x in k)
            assert all(r["slot"] == sum(enc(f) <= enc(tuple(r)[:-1]) for f in fences) for r in got)


def test_many_segments_share_packs(spark, monkeypatch):
    """Folders grow with the rows, not with the segments; some segments of a pack are replaced, others stay."""
    monkeypatch.setattr(compact, "PACK_ROWS", 100)
    rng = random.Random(8)
    runner = Batches(work_path(spark, "compact"), 10)
    c = Compactor(runner, 4, 0.5)
    runner.put(spark, some(rng, 600))
    c.compact(spark)
    segments = c.state(spark)[2]["id"]
    assert len(segments) == 150 and len(list_folder(spark, f"{c.base}/merged/gen=0/topic=id")) <= 6 + 2
    for lo, hi, n in ((0, 10**5, 40), (0, 10**6, 50), (5 * 10**5, 10**6, 80)):
        runner.put(spark, some(rng, n, lo, hi))
        c.compact(spark)
        assert any(s.pending for s in c.state(spark)[2]["id"])
        assert all(stored(spark, c, t) == truth(runner, t) for t in KEYS)
    c.compact(spark, everything=True)
    c.remove_old(spark)
    assert all(stored(spark, c, t) == truth(runner, t) for t in KEYS)


def test_messages_of_one_place_keep_the_order_of_their_run(spark):
    """A repeated offset gives equal sort keys: run, then topic partition, then place in the run decide."""
    runner = Batches(work_path(spark, "compact"), 10)
    c = Compactor(runner, 50)
    key = [f"0-{run}-{pos}" for run in (2, 10) for pos in range(12)]
    df = spark.createDataFrame([(5, "n", "x", 0, 1, k) for k in reversed(key)],
                               "id int, name string, continent string, src_partition int, src_offset bigint, key string")
    got = c._ranked(spark, df.withColumn("_slot", F.lit(0)).repartition(5), order_columns("id"), {0: len(key)})
    parts = {r["key"]: r["p"] for r in df.select("key", compact.hash_partition("key", 4).alias("p")).collect()}
    want = sorted(key, key=lambda k: (int(k.split("-")[1]), parts[k], int(k.split("-")[2])))
    assert [r["key"] for r in sorted(got.collect(), key=lambda r: r["_rank"])] == want
