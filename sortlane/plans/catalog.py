"""One callable per operator of the inventory: ``(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables (through the fixtures) so its work grows with
them.  Operators that write (sinks, streaming) write under the shared work
folder and return what a reader of their output sees.
"""

from __future__ import annotations

import time

from pyspark import InheritableThread
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..operators import checks, incremental, order, runs, sketch
from ..session import folder_state, work_path
from ..sinks import publish, versions
from ..sources import fixtures, generate
from ..sources import log as logsrc
from ..sources.group import ConsumerGroup, Fenced
from ..streaming import arrivals
from ..streaming import runs as streaming_runs
from ..streaming.bounded import BoundedReader
from ..streaming.compact import Compactor
from ..streaming.monitor import StreamMetrics, run_until
from ..streaming.runs import StreamRuns
from .batch import BatchRun, run_batch

RECORD_COLS = ["rid", "id", "name", "address", "continent"]


# ---- sorts -----------------------------------------------------------------

def q_sort_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.sort_by_id(fixtures.records(spark, sf_dir)).select(*RECORD_COLS, "pos")


def q_sort_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.sort_by_name(fixtures.records(spark, sf_dir)).select(*RECORD_COLS, "pos")


def q_sort_by_continent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.sort_by_continent(fixtures.records(spark, sf_dir)).select(*RECORD_COLS, "pos")


def q_sort_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 on decoded log records, tie-broken by source position (partition, offset)."""
    recs = codec.decode_tolerant(fixtures.dirty_log(spark, sf_dir))
    out = order.with_position(recs, ["address", "id", "partition", "offset"])
    return out.select("partition", "offset", "id", "name", "address", "continent", "pos")


def q_sort_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = order.stage(fixtures.records(spark, sf_dir), "records")
    return order.sort_fanout(staged).select("sort_key", *RECORD_COLS, "pos")


# ---- codec -----------------------------------------------------------------

def q_encode_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.records(spark, sf_dir).select("rid", codec.encode_line().alias("value"))


def q_decode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode_strict(fixtures.log(spark, sf_dir)).select(
        "partition", "offset", "id", "name", "address", "continent")


def q_decode_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode_tolerant(fixtures.dirty_log(spark, sf_dir)).select(
        "partition", "offset", "id", "name", "address", "continent")


def q_decode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode_rejects(fixtures.dirty_log(spark, sf_dir)).select(
        "partition", "offset", "value", "reject_reason")


def q_int32_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = codec.decode(fixtures.dirty_log(spark, sf_dir), keep_id64=True)
    return decoded.where(F.col("reject_reason").isNull()).select(
        "partition", "offset", "id64", codec.int32_wrap("id64").alias("id32"))


# ---- sources -----------------------------------------------------------------

FIRST_N = 6001
HEAD_K = 1000


def q_generate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated record per order key (rid = o_orderkey)."""
    ids = fixtures.read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("rid"))
    return generate.generate_for(ids, seed=42)


def q_log_read_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logsrc.read_first_n(fixtures.log(spark, sf_dir), "source", FIRST_N)


def q_log_read_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 on a log with offset gaps (every tenth offset is used)."""
    gaps = fixtures.log(spark, sf_dir).withColumn("offset", F.col("offset") * 10)
    return logsrc.read_first_n(gaps, "source", FIRST_N)


def q_log_read_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: commit what a first-N consumer read, then resume the same group."""
    log = order.stage(fixtures.log(spark, sf_dir), "log")
    committed = logsrc.commit_offsets(logsrc.read_first_n(log, "source", FIRST_N), "g1")
    committed = order.stage(committed, "committed")
    return logsrc.read_resume(log, committed, "g1")


def q_log_read_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logsrc.read_partition(fixtures.log(spark, sf_dir), "source", 2)


def q_topic_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logsrc.topic_offsets(batch_log(spark, sf_dir))


def q_log_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logsrc.head(fixtures.log(spark, sf_dir), "source", HEAD_K)


def q_read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty log exported as text lines, read back and decoded."""
    path = work_path(spark, "lines")
    publish.export_lines(fixtures.dirty_log(spark, sf_dir), path)
    return codec.decode(logsrc.read_lines(spark, path)).select(
        "value", "id", "name", "address", "continent", "reject_reason")


# ---- sinks -------------------------------------------------------------------

def q_publish_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.publish_balanced(fixtures.records(spark, sf_dir), "source", order=["rid"])


def q_publish_hash_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: records keyed by name (five keys: heavy skew), in rid order per partition."""
    return publish.publish_hash_keyed(fixtures.records(spark, sf_dir), "name", "name", ["rid"])


def q_publish_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    srt = order.sort_records(fixtures.records(spark, sf_dir), "name", ["rid"], total_col="_total")
    return publish.publish_sorted(srt, "name")


def q_stage_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.stage_snapshot(fixtures.log(spark, sf_dir), "source").select(
        "partition", "offset", "value")


def q_publish_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: run 9, its retry, then a shorter run 10 without the id topic: only run 10 is read."""
    base = work_path(spark, "idempotent")
    records = order.stage(fixtures.records(spark, sf_dir), "records")
    srt = order.sort_records(records, "name", ["rid"], total_col="_total")
    msgs = order.stage(publish.publish_sorted(srt, "name"), "msgs")
    both = msgs.unionByName(msgs.withColumn("topic", F.lit("id")))
    publish.publish_idempotent(both, base, 9)
    publish.publish_idempotent(both, base, 9)  # retry of the same run
    publish.publish_idempotent(msgs.where("partition < 2"), base, 10)
    return publish.read_published(spark, base)


# ---- batch-job log: one staged run per state of the events table -----------------

_BATCH_RUNS: dict[tuple, BatchRun] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Changes with the session and with the files of the events table."""
    return spark.sparkContext.applicationId, sf_dir, folder_state(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def batch_run(spark: SparkSession, sf_dir: str, dirty: bool = False) -> BatchRun:
    key = (*_state(spark, sf_dir), dirty)
    if key not in _BATCH_RUNS:
        src = fixtures.dirty_log(spark, sf_dir) if dirty else fixtures.log(spark, sf_dir)
        _BATCH_RUNS[key] = run_batch(spark, src, on_error="skip" if dirty else "fail")
    return _BATCH_RUNS[key]


def batch_log(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return batch_run(spark, sf_dir, dirty).log(spark)


def q_batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 (flagship): the published log of all four topics."""
    return batch_log(spark, sf_dir)


def q_batch_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 with a consumer group: a bounded run, then the rest, appended to one log."""
    src = order.stage(fixtures.log(spark, sf_dir), "log")
    out, offsets = work_path(spark, "resume"), work_path(spark, "offsets")
    for n in (FIRST_N, None):
        run = run_batch(spark, src, out=out, consume=n, on_short="accept", group="g1", offsets_path=offsets)
    return run.log(spark).where(F.col("topic") != "source")


def q_publish_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5/L1: source and sorted topics of two runs, each one version with the group's
    offsets; a second writer on the first version is refused and leaves nothing."""
    src, out = order.stage(fixtures.log(spark, sf_dir), "log"), work_path(spark, "atomic")
    versions.publish_atomic(spark, out, {"source": src})
    run_batch(spark, logsrc.read_log(spark, out), out=out, consume=FIRST_N, on_short="accept", group="g1")
    late = versions.Publication(spark, out)
    late.write(src.limit(10), "id")
    run_batch(spark, logsrc.read_log(spark, out), out=out, group="g1")
    try:
        late.commit()
    except versions.VersionConflict:
        return logsrc.read_log(spark, out)
    raise RuntimeError("a writer on an old version was not refused")


def q_group_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 by two members: ``a`` reads half of every partition alone, then ``b`` joins;
    what ``a`` read for its old generation after that is refused and read again."""
    log = order.stage(fixtures.log(spark, sf_dir), "log")
    ends = {r["partition"]: r["next_offset"] for r in logsrc.topic_offsets(log).collect()}  # one row per partition
    group = ConsumerGroup(spark, work_path(spark, "groups"), "g1")
    had = lambda poll, place: order.stage(poll.rows, "poll").select(
        F.lit(place.member).alias("member"), F.lit(place.generation).alias("generation"), "partition", "offset", "value")
    alone = group.join("a", ends)
    first = group.poll(log, alone, max(ends.values()) // 2)
    out = had(first, alone)
    group.commit(alone, first.offsets)
    late = group.poll(log, alone)
    b = group.join("b", ends)
    try:
        group.commit(alone, late.offsets)
        raise RuntimeError("a commit of an old generation was not refused")
    except Fenced:
        pass
    for place in (group.renew("a"), b):
        poll = group.poll(log, place)
        out = out.unionByName(had(poll, place))
        group.commit(place, poll.offsets)
    return out


def q_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_run(spark, sf_dir, dirty=True).counters_frame(spark)


def q_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: rows per stage and overall; times are reported as whether they were taken."""
    return batch_run(spark, sf_dir, dirty=True).report_frame(spark).select(
        "stage", "rows", (F.col("seconds") >= 0).alias("timed"))


# ---- checks ------------------------------------------------------------------

def q_check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_schema(fixtures.dirty_log(spark, sf_dir))


def q_schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.schema_violations(fixtures.dirty_log(spark, sf_dir)).select(
        "partition", "offset", "rule")


def q_check_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_charset(codec.decode_tolerant(fixtures.dirty_log(spark, sf_dir)))


def q_check_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_topics(spark, batch_log(spark, sf_dir))


def q_count_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.count_by_topic(batch_log(spark, sf_dir))


def q_count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.count_reconcile(batch_log(spark, sf_dir, dirty=True))


def q_multiset_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.multiset_reconcile(batch_log(spark, sf_dir, dirty=True))


def q_multiset_diff_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 from additive cells: only the lines that differ are looked up."""
    return sketch.multiset_difference(batch_log(spark, sf_dir, dirty=True)).rows


def q_check_sorted_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_sorted(batch_log(spark, sf_dir), "id")


def q_check_sorted_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_sorted(batch_log(spark, sf_dir), "name")


def q_check_sorted_continent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_sorted(batch_log(spark, sf_dir), "continent")


def q_detect_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 on the unsorted source topic: its maximal non-descending id stretches."""
    return checks.detect_runs(fixtures.dirty_log(spark, sf_dir), "id")


def q_validate_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 after an append: half of every partition is validated first, then only the other half is read."""
    log = batch_log(spark, sf_dir)
    ends = logsrc.topic_offsets(log).select("topic", "partition", "next_offset")  # one row per log partition
    early = log.join(F.broadcast(ends), ["topic", "partition"]).where(F.col("offset") * 2 < F.col("next_offset")).drop("next_offset")
    validator = incremental.Validator(work_path(spark, "validator"))
    validator.advance(spark, early)
    return validator.validate(spark, log)


def q_validate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.validate_all(spark, batch_log(spark, sf_dir))


# ---- runs --------------------------------------------------------------------

RUN_CHUNK = 4000


def q_sorted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.sorted_runs(fixtures.records(spark, sf_dir), "name", RUN_CHUNK, ["rid"])
    return out.select(*RECORD_COLS, "seq", "run_id", "pos")


def q_merge_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = order.stage(runs.sorted_runs(fixtures.records(spark, sf_dir), "name", RUN_CHUNK, ["rid"]), "runs")
    return runs.merge_runs(r, "name", ["rid"], "pos").select(*RECORD_COLS, "run_id", "pos")


# ---- streaming ---------------------------------------------------------------

STREAM_CHUNK = 300
STREAM_ARRIVALS = 4
STREAM_SILENT = (3, 1)  # partition 3 sends nothing in arrival 1 (it arrives with arrival 2)


_STREAMS: dict[tuple, StreamRuns] = {}


def stream_run(spark: SparkSession, sf_dir: str, restart_after: int | None = None,
               flush: bool = False) -> StreamRuns:
    """One run per state of the events table: its output tables are the data
    product every streaming query reads; flushing only adds the ``flush`` table."""
    key = (*_state(spark, sf_dir), restart_after)
    if key not in _STREAMS:
        _STREAMS[key] = _run_stream(spark, sf_dir, restart_after)
    runner = _STREAMS[key]
    if flush:
        runner.flush_open_runs(spark)
    return runner


def _run_stream(spark: SparkSession, sf_dir: str, restart_after: int | None = None) -> StreamRuns:
    """Feed the dirty log as arrivals and run the run producer to the end of input.

    ``restart_after=k``: only the first k arrivals exist for the first run;
    the query stops, the rest arrive, and a new query resumes from the same
    checkpoint.
    """
    base = work_path(spark, "stream")
    log = order.stage(fixtures.dirty_log(spark, sf_dir), "stream-input")
    cuts = arrivals.quantile_cuts(log, STREAM_ARRIVALS)
    runner = StreamRuns(f"{base}/state", STREAM_CHUNK)
    src, ckpt = f"{base}/source", f"{base}/checkpoint"
    if restart_after is None:
        arrivals.write_arrivals(log, src, cuts, STREAM_SILENT)
        streaming_runs.start_stream(spark, src, runner, ckpt, files_per_trigger=arrivals.FILES).awaitTermination()
    else:
        arrivals.write_arrivals(log, src, cuts, STREAM_SILENT, last=restart_after - 1)
        streaming_runs.start_stream(spark, src, runner, ckpt, files_per_trigger=arrivals.FILES).awaitTermination()
        arrivals.write_arrivals(log, src, cuts, STREAM_SILENT, first=restart_after)
        streaming_runs.start_stream(spark, src, runner, ckpt, files_per_trigger=arrivals.FILES).awaitTermination()
    return runner


_FANOUT_COLS = ["sort_key", "src_partition", "run_id", "pos", "id", "name", "address", "continent",
                "src_offset"]


def q_stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: run assignment of every accepted record (seq among valid records of its partition)."""
    return stream_run(spark, sf_dir).staged(spark).select(
        F.col("partition").alias("src_partition"), F.col("offset").alias("src_offset"), "seq", "run_id")


def q_stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: every closed run sorted three ways."""
    return stream_run(spark, sf_dir).output(spark).select(*_FANOUT_COLS)


def q_stream_keyed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the closed runs as topics, hash-partitioned by key with dense offsets."""
    return stream_run(spark, sf_dir).log(spark)


def q_stream_detect_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 on the streamed id topic: its non-descending stretches."""
    log = stream_run(spark, sf_dir).log(spark).where(F.col("topic") == "id")
    return checks.detect_runs(log, "id")


def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_run(spark, sf_dir).rejects(spark).select("partition", "offset", "value", "reject_reason")


def q_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: stop after two arrivals, restart on the same checkpoint: same output."""
    return stream_run(spark, sf_dir, restart_after=2).output(spark).select(*_FANOUT_COLS)


def q_stream_tail_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: closed runs plus the short runs flushed at the end of input."""
    return stream_run(spark, sf_dir, flush=True).output(spark, include_flush=True).select(*_FANOUT_COLS)


def q_stream_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5/M2: the streamed runs as one total order per topic, compacted after two
    arrivals and again after the others."""
    base = work_path(spark, "stream")
    log = order.stage(fixtures.dirty_log(spark, sf_dir), "stream-input")
    cuts = arrivals.quantile_cuts(log, STREAM_ARRIVALS)
    runner = StreamRuns(f"{base}/state", STREAM_CHUNK)
    compactor = Compactor(runner, segment_rows=1000)
    for first, last in ((0, 1), (2, STREAM_ARRIVALS - 1)):
        arrivals.write_arrivals(log, f"{base}/source", cuts, STREAM_SILENT, first=first, last=last)
        streaming_runs.start_stream(spark, f"{base}/source", runner, f"{base}/checkpoint",
                                    files_per_trigger=arrivals.FILES).awaitTermination()
        compactor.compact(spark)
    return compactor.log(spark)


def q_stream_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read of 60 % of the messages that waits for late arrivals, then one of
    20 % that starts with what the first read's last batch left over."""
    base = work_path(spark, "bounded")
    log = order.stage(fixtures.log(spark, sf_dir), "bounded-input")
    cuts, n = arrivals.quantile_cuts(log, STREAM_ARRIVALS), log.count()
    reader, source = BoundedReader(f"{base}/state"), f"{base}/source"
    arrivals.write_arrivals(log, source, cuts, last=0, files=1)
    stream = streaming_runs.stream_reader(spark, source, files_per_trigger=1)

    def come_late() -> None:
        while reader.state(spark)[1]["taken"] == 0:
            time.sleep(0.1)
        arrivals.write_arrivals(log, source, cuts, first=1, files=1)

    late = InheritableThread(target=come_late, daemon=True)
    late.start()
    parts = []
    for k, size in enumerate((n * 6 // 10 + 1, n * 2 // 10)):
        rows = reader.read(stream, size, f"{base}/checkpoint", timeout=600)
        parts.append(rows.select(F.lit(k).alias("read"), "partition", "offset", "value"))
    late.join()
    return parts[0].unionByName(parts[1])


def q_stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 by listener: counters, whether times were taken, and failed attempts per batch;
    batch 2 fails once (planted) and is done by the restarted query."""
    base = work_path(spark, "stream")
    log = order.stage(fixtures.dirty_log(spark, sf_dir), "stream-input")
    cuts = arrivals.quantile_cuts(log, STREAM_ARRIVALS)
    arrivals.write_arrivals(log, f"{base}/source", cuts, STREAM_SILENT)

    class FailsOnce(StreamRuns):
        failed = False

        def process(self, batch: DataFrame, batch_id: int) -> None:
            if batch_id == 2 and not FailsOnce.failed:
                FailsOnce.failed = True
                raise RuntimeError("planted")
            super().process(batch, batch_id)

    runner = FailsOnce(f"{base}/state", STREAM_CHUNK)
    with StreamMetrics(spark) as metrics:
        for _ in range(2):
            query = streaming_runs.start_stream(spark, f"{base}/source", runner, f"{base}/checkpoint", files_per_trigger=arrivals.FILES)
            try:
                query.awaitTermination()
            except StreamingQueryException:
                pass
            metrics.wait_for_end(query.runId)
    return metrics.per_batch(runner).select(
        "batch_id", "consumed", "accepted", "rejected", "runs_closed", "rows_out", "failures",
        (F.col("seconds") > 0).alias("timed"), (F.col("rows_per_s") > 0).alias("rated"))


def q_stream_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: a continuous run that meets arrivals as they come; stopping it works off what
    has arrived and flushes the open runs."""
    base = work_path(spark, "stream")
    log = order.stage(fixtures.dirty_log(spark, sf_dir), "stream-input")
    cuts, runner = arrivals.quantile_cuts(log, STREAM_ARRIVALS), StreamRuns(f"{base}/state", STREAM_CHUNK)
    arrivals.write_arrivals(log, f"{base}/source", cuts, STREAM_SILENT, last=0, files=1)
    sent = [1]

    def send_next() -> bool:
        """The next arrival once the one before is committed; true when there is none."""
        if runner.last_committed(spark) != sent[0] - 1:
            return False
        if sent[0] < STREAM_ARRIVALS:
            arrivals.write_arrivals(log, f"{base}/source", cuts, STREAM_SILENT, first=sent[0], last=sent[0], files=1)
            sent[0] += 1
            return False
        return True

    run_until(spark, f"{base}/source", runner, f"{base}/checkpoint", send_next, files_per_trigger=1)
    return runner.log(spark, include_flush=True)


def q_stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_run(spark, sf_dir).progress(spark)


def q_stream_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: stream -> tolerant decode -> runs -> three sorts -> topics -> final flush."""
    return stream_run(spark, sf_dir, flush=True).log(spark, include_flush=True)
