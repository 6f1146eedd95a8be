"""Streaming run producer (M1-M8): output equals a direct computation for any
arrival split and run length, survives restart and replay, flushes the tail."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sortlane.functions import codec
from sortlane.operators import checks, order
from sortlane.session import list_folder, work_path
from sortlane.sources import fixtures
from sortlane.sources.log import topic_offsets
from sortlane.streaming import arrivals
from sortlane.streaming import runs as streaming_runs
from sortlane.streaming.runs import StreamRuns, StreamStateError, start_stream

COLS = ["sort_key", "src_partition", "run_id", "pos", "src_offset", "id"]


def _truth(spark, log, chunk, closed_only=True):
    """Direct batch computation (test oracle on small data)."""
    v = codec.decode_tolerant(log)
    w = Window.partitionBy("partition").orderBy("offset")
    s = v.withColumn("seq", F.row_number().over(w) - 1).withColumn(
        "n_p", F.count(F.lit(1)).over(Window.partitionBy("partition")))
    s = s.withColumn("run_id", F.floor(F.col("seq") / chunk))
    if closed_only:
        s = s.where((F.col("run_id") + 1) * chunk <= F.col("n_p"))
    t = s.withColumn("sort_key", F.explode(F.array(F.lit("id"), F.lit("name"), F.lit("continent"))))
    lead = F.when(F.col("sort_key") == "name", F.col("name")).when(
        F.col("sort_key") == "continent", F.col("continent")).otherwise(F.lit(""))
    wr = Window.partitionBy("sort_key", "partition", "run_id").orderBy(lead, "id", "offset")
    return t.select("sort_key", F.col("partition").alias("src_partition"), F.col("run_id").cast("bigint"),
                    (F.row_number().over(wr) - 1).cast("bigint").alias("pos"),
                    F.col("offset").alias("src_offset"), "id")


def _run(spark, log, chunk, cuts, silent=None, restart_after=None):
    base = work_path(spark, "stream-test")
    runner = StreamRuns(f"{base}/state", chunk)
    src, ckpt = f"{base}/source", f"{base}/ckpt"
    if restart_after is None:
        arrivals.write_arrivals(log, src, cuts, silent)
        start_stream(spark, src, runner, ckpt, files_per_trigger=arrivals.FILES).awaitTermination()
    else:
        arrivals.write_arrivals(log, src, cuts, silent, last=restart_after - 1)
        start_stream(spark, src, runner, ckpt, files_per_trigger=arrivals.FILES).awaitTermination()
        arrivals.write_arrivals(log, src, cuts, silent, first=restart_after)
        start_stream(spark, src, runner, ckpt, files_per_trigger=arrivals.FILES).awaitTermination()
    return runner


@pytest.fixture(scope="module")
def dirty(spark):
    return order.stage(fixtures.dirty_log(spark, SF_SMALL), "dirty-small")


@pytest.mark.parametrize("chunk,cuts,silent", [
    (7, [0, 250], None),                    # one arrival
    (7, [0, 60, 61, 130, 250], (2, 1)),      # a one-offset arrival, a silent partition
    (1, [0, 100, 250], None),                # every record is a run
    (50, [0, 50, 100, 175, 250], None),      # cuts near run ends
    (300, [0, 120, 250], None),              # longer than a partition: nothing closes
])
def test_output_matches_direct_computation(spark, dirty, chunk, cuts, silent):
    runner = _run(spark, dirty, chunk, cuts, silent)
    assert rows(runner.output(spark), *COLS) == rows(_truth(spark, dirty, chunk), *COLS)
    assert len(runner.committed_batches(spark)) == len(cuts) - 1
    runner.flush_open_runs(spark)
    assert rows(runner.output(spark, include_flush=True), *COLS) == \
        rows(_truth(spark, dirty, chunk, closed_only=False), *COLS)
    assert runner.rejects(spark).count() == codec.decode_rejects(dirty).count()


def test_restart_gives_same_output(spark, dirty):
    cuts = [0, 40, 90, 160, 250]
    whole = _run(spark, dirty, 13, cuts)
    resumed = _run(spark, dirty, 13, cuts, restart_after=2)
    assert rows(resumed.output(spark), *COLS) == rows(whole.output(spark), *COLS)
    assert len(resumed.committed_batches(spark)) == 4


def test_replayed_batch_is_idempotent(spark, dirty):
    base = work_path(spark, "stream-replay")
    runner = StreamRuns(base, 11)
    cuts = [0, 80, 170, 250]
    parts = [dirty.where((F.col("offset") >= a) & (F.col("offset") < b)) for a, b in zip(cuts, cuts[1:])]
    for i, p in enumerate(parts):
        runner.process(p, i)
    before = rows(runner.output(spark), *COLS)
    stage_before = rows(runner.staged(spark), "partition", "offset", "seq", "run_id")
    runner.process(parts[-1], len(parts) - 1)  # crash after the writes, before the commit
    assert rows(runner.output(spark), *COLS) == before
    assert rows(runner.staged(spark), "partition", "offset", "seq", "run_id") == stage_before


def test_batch_of_rejects_only_and_progress(spark, dirty):
    base = work_path(spark, "stream-rejects")
    runner = StreamRuns(base, 5)
    bad = dirty.where(F.col("offset") < 40).withColumn("value", F.lit("broken"))
    good = dirty.where(F.col("offset") >= 40)
    runner.process(bad, 0)
    runner.process(good, 1)
    prog = {r["batch_id"]: r for r in runner.progress(spark).collect()}
    assert prog[0]["accepted"] == 0 and prog[0]["rejected"] == bad.count() and prog[0]["runs_closed"] == 0
    assert prog[1]["consumed"] == good.count()
    assert prog[1]["rows_out"] == 3 * 5 * prog[1]["runs_closed"]
    assert rows(runner.output(spark), *COLS) == rows(_truth(spark, good, 5), *COLS)


def test_continuous_trigger_processes_arrivals(spark, dirty):
    base = work_path(spark, "stream-continuous")
    runner = StreamRuns(f"{base}/state", 9)
    src = f"{base}/source"
    arrivals.write_arrivals(dirty, src, [0, 100, 250])
    q = start_stream(spark, src, runner, f"{base}/ckpt", files_per_trigger=arrivals.FILES, available_now=False,
                     processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(runner.output(spark), *COLS) == rows(_truth(spark, dirty, 9), *COLS)


def test_cli_batch_and_validate(spark):
    from sortlane.__main__ import main
    out = work_path(spark, "cli")
    assert main(["batch", "--records", "2000", "--out", out]) == 0
    assert main(["validate", "--log", out]) == 0


def _parts(dirty, cuts):
    return [dirty.where((F.col("offset") >= a) & (F.col("offset") < b)) for a, b in zip(cuts, cuts[1:])]


def test_output_is_a_log_with_dense_offsets(spark, dirty):
    runner = StreamRuns(work_path(spark, "stream-log"), 11)
    for i, p in enumerate(_parts(dirty, [0, 80, 170, 250])):
        runner.process(p, i)
    log = runner.log(spark)
    assert log.columns == ["topic", "partition", "offset", "key", "value"]
    for r in topic_offsets(log).collect():
        assert r["first_offset"] == 0 and r["next_offset"] == r["n"]
    # Every topic is a series of sorted runs: as many descents as runs meet in a partition, at most.
    closed = runner.output(spark).where("sort_key = 'id'").select("partition", "src_partition", "run_id").distinct().count()
    assert checks.detect_runs(log.where("topic = 'id'"), "id").count() <= closed


def test_result_does_not_depend_on_files_per_trigger(spark, dirty):
    got = []
    for n in (None, 1, arrivals.FILES):
        base = work_path(spark, "stream-files")
        runner = StreamRuns(f"{base}/state", 13)
        src = f"{base}/source"
        one = [(0, 90), (90, 250)]
        for a, b in one:  # one file per arrival
            dirty.where((F.col("offset") >= a) & (F.col("offset") < b)).coalesce(1).write.mode("append").parquet(src)
        start_stream(spark, src, runner, f"{base}/ckpt", files_per_trigger=n).awaitTermination()
        got.append(rows(runner.output(spark), *COLS))
    assert got[0] == got[1] == got[2]


def test_flush_then_more_input_has_no_duplicate(spark, dirty):
    runner = StreamRuns(work_path(spark, "stream-flush"), 30)
    first, second = _parts(dirty, [0, 100, 250])
    runner.process(first, 0)
    assert runner.flush_open_runs(spark) > 0
    n = codec.decode_tolerant(first).count()
    assert runner.output(spark, include_flush=True).where("sort_key = 'id'").count() == n
    runner.process(second, 1)
    whole = runner.output(spark, include_flush=True)
    assert rows(whole, *COLS) == rows(_truth(spark, dirty, 30), *COLS)  # the old flush is ignored
    runner.flush_open_runs(spark)
    assert rows(runner.output(spark, include_flush=True), *COLS) == rows(_truth(spark, dirty, 30, closed_only=False), *COLS)


def test_offsets_that_go_back_are_refused(spark, dirty):
    runner = StreamRuns(work_path(spark, "stream-back"), 30)
    runner.process(dirty.where("offset % 2 = 0"), 0)
    with pytest.raises(StreamStateError):
        runner.process(dirty.where("offset % 2 = 1"), 1)
    assert runner.last_committed(spark) == 0


def test_foreign_state_is_refused(spark, dirty):
    base = work_path(spark, "stream-foreign")
    runner = StreamRuns(f"{base}/state", 30)
    src = f"{base}/source"
    arrivals.write_arrivals(dirty, src, [0, 100, 250])
    start_stream(spark, src, runner, f"{base}/ckpt", files_per_trigger=arrivals.FILES).awaitTermination()
    before = runner.output(spark).count()
    for ckpt, files in (("new-1", arrivals.FILES), ("new-2", None)):
        with pytest.raises(Exception) as e:
            start_stream(spark, src, runner, f"{base}/{ckpt}", files_per_trigger=files).awaitTermination()
        assert "StreamStateError" in str(e.value)
    assert runner.output(spark).count() == before


def test_storage_errors_are_raised_and_empty_folders_are_not(spark, monkeypatch):
    runner = StreamRuns(work_path(spark, "stream-none"), 5)
    assert runner.last_committed(spark) is None and runner.flush_open_runs(spark) == 0
    monkeypatch.setattr(streaming_runs, "list_folder", lambda *a: (_ for _ in ()).throw(PermissionError("no access")))
    with pytest.raises(PermissionError):
        runner.flush_open_runs(spark)


def test_a_batch_reads_only_the_open_records(spark, dirty):
    """One partition goes quiet with an open run; later batches don't read back to it."""
    base = work_path(spark, "stream-bounded")
    runner = StreamRuns(base, 40)
    cuts = [0, 30, 60, 90, 120, 150, 180, 210, 250]
    for i, p in enumerate(_parts(dirty, cuts)):
        runner.process(p if i == 0 else p.where("partition <> 2"), i)
    assert list_folder(spark, f"{base}/open") and len(runner._complete(spark, "open")) == 2
    assert len(runner._complete(spark, "manifest")) == 2
    still = runner._open(spark, len(cuts) - 2)
    assert still.groupBy("partition").count().agg(F.max("count")).first()[0] < 40
    assert still.where("partition = 2").count() == codec.decode_tolerant(dirty.where("partition = 2 and offset < 30")).count()
    quiet = dirty.where("partition <> 2 or offset < 30")
    assert rows(runner.output(spark), *COLS) == rows(_truth(spark, quiet, 40), *COLS)


class _Reader:
    """Records what a stream reader is asked for."""

    def __init__(self, asked, frame):
        self.asked, self.frame = asked, frame

    def __getattr__(self, name):
        def call(*args):
            self.asked.append((name, *args))
            return self.frame if name == "load" else self
        return call


def test_kafka_branch_sets_no_schema_path_or_file_option(spark):
    frame = spark.createDataFrame([("source", 0, 1, None, bytearray(b"1,a,b,c"))],
                                  "topic string, partition int, offset long, key binary, value binary")
    asked = []

    class Session:
        readStream = _Reader(asked, frame)

    out = streaming_runs.stream_reader(Session(), "source", files_per_trigger=3, source_format="kafka",
                                       options={"kafka.bootstrap.servers": "h:1"})
    assert asked == [("format", "kafka"), ("option", "subscribe", "source"), ("option", "kafka.bootstrap.servers", "h:1"),
                     ("load",)]
    assert [tuple(r) for r in out.collect()] == [("source", 0, 1, None, "1,a,b,c")]


def test_cli_stream_and_skip_sort(spark, dirty):
    from sortlane.__main__ import main
    base = work_path(spark, "cli-stream")
    arrivals.write_arrivals(dirty, f"{base}/source", [0, 125, 250])
    assert main(["stream", "--source", f"{base}/source", "--state", f"{base}/state",
                 "--checkpoint", f"{base}/ckpt", "--chunk", "17", "--files-per-trigger", "2", "--flush"]) == 0
    runner = StreamRuns(f"{base}/state", 17)
    assert rows(runner.output(spark, include_flush=True), *COLS) == \
        rows(_truth(spark, dirty, 17, closed_only=False), *COLS)
    out = work_path(spark, "cli-skip-sort")
    assert main(["batch", "--records", "500", "--out", out, "--skip-sort"]) == 0
    log = spark.read.parquet(out)
    assert log.count() == 500 and {r[0] for r in log.select("topic").distinct().collect()} == {"source"}


def test_a_batch_of_few_files_is_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(arrivals, "ROW_GROUP", 1 << 18)
    log = spark.range(400000).select(
        F.lit("source").alias("topic"), (F.col("id") % 4).cast("int").alias("partition"), F.floor(F.col("id") / 4).alias("offset"),
        F.lit(None).cast("string").alias("key"), F.concat_ws(",", "id", F.md5(F.col("id").cast("string")), F.lit("x"), F.lit("Asia")).alias("value"))
    src = f"{work_path(spark, 'row-groups')}/source"
    arrivals.write_arrivals(log, src, [0, 100000])
    assert len([f for f in list_folder(spark, src) if f.endswith(".parquet")]) == arrivals.FILES
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        parts = spark.read.parquet(src).groupBy(F.spark_partition_id().alias("p")).count().where("count > 0").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts > 2 * arrivals.FILES


def test_places_in_topics_do_not_depend_on_how_they_are_counted(spark, dirty, monkeypatch):
    """Counted beside the one sort of a run, or by a sort of their own: the same messages."""
    got, plans = [], []
    for most in (16, 0):
        monkeypatch.setattr(streaming_runs, "COUNTED_PARTITIONS", most)
        runner = StreamRuns(work_path(spark, "stream-places"), 11)
        for i, p in enumerate(_parts(dirty, [0, 80, 250])):
            runner.process(p, i)
        runner.flush_open_runs(spark)
        got.append(rows(runner.output(spark, include_flush=True), "topic", "partition", "offset", "key", "value"))
        closed, _ = runner._messages(spark, runner._open(spark, 1), [(0, 5, 6, 3)], runner._manifest(spark, 1), [])
        plan = closed._jdf.queryExecution().optimizedPlan().toString()
        plans.append(sum(" Window [" in line and "pos" in line.split("], [")[-1] for line in plan.split("\n")))
    assert got[0] == got[1] and plans[0] < plans[1]
