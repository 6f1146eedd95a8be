"""Batch pipeline (L1) with its counters (A4) and stage report (A5).

generate -> publish ``source`` -> snapshot once -> decode -> three sorts with
``pos`` -> publish ``id``/``name``/``continent`` with contiguous partition
ranges -> commit -> report.  Every stage is an ordinary DataFrame job.

All topics of a run become visible together, as one version of the log table
(``sinks.versions``); readers see the last version or the one they ask for.
With a consumer group the sorted topics are append-only, with offsets that
continue those of the runs before, and the same version holds the group's
offsets.  A crash anywhere before it leaves the table and the group where they
were.  Of two jobs of one group at a time, the second to finish is refused and
takes its folders away, so nothing is lost or doubled.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import codec
from ..functions.tables import small_table
from ..operators.order import sort_records, stage
from ..schema import LOG_COLUMNS, LOG_PARTITIONS, SORTED_TOPICS, SOURCE_TOPIC
from ..session import list_folder, remove_folder, work_path
from ..sinks.publish import publish_balanced, publish_sorted
from ..sinks.versions import Publication
from ..sources.generate import generate_for
from ..sources.log import commit_offsets, list_topics, read_first_n, read_log, read_resume, topic_offsets

REPORT_SCHEMA = "run string, stage string, rows bigint, seconds double, rows_per_s double"
COUNTER_NAMES = ["generated", "consumed", "rejected", "sorted", "produced",
                 "generation_errors", "sorting_errors", "production_errors"]
OFFSETS_SCHEMA = "topic string, partition int, next_offset bigint"


class ShortRead(RuntimeError):
    """Fewer messages were available than the run was asked to consume."""


@dataclass
class BatchRun:
    path: str
    run_id: str
    counters: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTER_NAMES, 0))
    stages: list[tuple[str, int, float]] = field(default_factory=list)
    source: DataFrame | None = None  # an existing source log that was not copied
    seq: int | None = None  # number of the group's run
    version: int | None = None  # of the log table that the run made
    source_topic: str = SOURCE_TOPIC

    def log(self, spark: SparkSession) -> DataFrame:
        """All topics: the published ones (up to this run) plus the source topic where it lives."""
        published = read_log(spark, self.path, version=self.version)
        if self.source is None or self.source_topic in list_topics(spark, self.path, self.version):
            return published
        return published.unionByName(
            self.source.where(F.col("topic") == self.source_topic).select(*LOG_COLUMNS))

    def counters_frame(self, spark: SparkSession) -> DataFrame:
        """A4: ``(counter, value)`` for the run, error counters included."""
        return small_table(
            spark, [(k, int(self.counters.get(k, 0))) for k in COUNTER_NAMES], "counter string, value bigint")

    def report_frame(self, spark: SparkSession) -> DataFrame:
        """A5: one row per stage and one overall: ``(run, stage, rows, seconds, rows_per_s)``.

        Overall rows are the messages produced, overall seconds the run's wall time.
        """
        rows = [(self.run_id, s, int(n), float(sec), float(n / sec) if sec > 0 else None)
                for s, n, sec in self.stages]
        return small_table(spark, rows, REPORT_SCHEMA)


def _observed_write(made: Publication, df: DataFrame, topic: str, append: bool = False) -> int:
    return made.write(df, topic, append)


def committed_offsets(spark: SparkSession, path: str, group: str) -> tuple[int, DataFrame]:
    """``(next run number, offsets)`` of a group from its last complete commit.

    Each commit is one folder ``group=<g>/seq=<k>``; one that a crash left
    without its success marker doesn't count.  A group that never committed
    starts at run 0; any storage error is raised, never taken for that.
    """
    folder = f"{path.rstrip('/')}/group={group}"
    done = [int(f.removeprefix("seq=")) for f in list_folder(spark, folder)
            if f.startswith("seq=") and "_SUCCESS" in list_folder(spark, f"{folder}/{f}")]
    if not done:
        return 0, small_table(spark, [], f"group string, {OFFSETS_SCHEMA}")
    rows = spark.read.schema(OFFSETS_SCHEMA).parquet(f"{folder}/seq={max(done)}")
    return max(done) + 1, rows.select(F.lit(group).alias("group"), "topic", "partition", "next_offset")


def _group_state(spark: SparkSession, made: Publication, group: str, offsets_path: str | None) -> tuple[int, DataFrame]:
    """``(next run number, offsets)`` of a group: those of the log table's version,
    or of ``offsets_path`` for a group that has none there yet."""
    state = made.before["groups"].get(group)
    if state is None:
        if offsets_path is not None:
            return committed_offsets(spark, offsets_path, group)
        state = {"runs": 0, "offsets": []}
    rows = small_table(spark, [(group, *r) for r in state["offsets"]], f"group string, {OFFSETS_SCHEMA}")
    return state["runs"], rows


def _commit(made: Publication, snapshot: DataFrame, committed: DataFrame, topic: str, group: str,
            offsets_path: str | None, seq: int) -> int:
    """Publish the run with ``max(previous, consumed + 1)`` per partition as the group's offsets.

    ``offsets_path`` gets a copy afterwards, for readers of offset tables.
    """
    consumed = commit_offsets(snapshot.select(
        F.lit(topic).alias("topic"), F.col("src_partition").alias("partition"),
        F.col("src_offset").alias("offset")), group)
    merged = consumed.unionByName(committed).groupBy("topic", "partition").agg(
        F.max("next_offset").alias("next_offset"))
    offsets = sorted([r["topic"], r["partition"], r["next_offset"]] for r in merged.collect())  # one row per log partition
    version = made.commit({group: {"runs": seq + 1, "offsets": offsets}})
    if offsets_path is not None:
        small_table(snapshot.sparkSession, offsets, OFFSETS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{offsets_path.rstrip('/')}/group={group}/seq={seq}")
    return version


def _continued(messages: DataFrame, before: DataFrame) -> DataFrame:
    """Move a run's offsets behind those of the runs before it."""
    # One row per log partition.
    base = topic_offsets(before).select(F.col("partition").alias("_p"), F.col("next_offset").alias("_base"))
    return messages.join(F.broadcast(base), F.col("partition") == F.col("_p"), "left").withColumn(
        "offset", F.col("offset") + F.coalesce("_base", F.lit(0))).select(*LOG_COLUMNS)


def run_batch(spark: SparkSession, source_log: DataFrame | None = None, *,
              ids: DataFrame | None = None, records: int | None = None, seed: int = 42,
              partitions: int = LOG_PARTITIONS, out: str | None = None,
              run_id: str = "run-0", on_error: str = "fail",
              report_path: str | None = None, consume: int | None = None, on_short: str = "fail",
              group: str | None = None, offsets_path: str | None = None,
              source_topic: str = SOURCE_TOPIC, sorted_topics: Sequence[str] = tuple(SORTED_TOPICS),
              num_buckets: int | None = None) -> BatchRun:
    """Run the batch pipeline and return where its log went plus its metrics.

    ``source_log`` given: its ``source_topic`` is used as is (skip-generate).
    ``records=n``: records with ``rid`` 0..n-1 are generated, and ``rid`` is
    the publication index (no staging pass).  ``ids``: one record per row
    (column ``rid``), published in the ids' partition order.  ``on_error``:
    ``fail`` aborts on the first bad line (batch behaviour of the original),
    ``skip`` drops and counts it.

    ``consume=n`` snapshots exactly the first ``n`` available messages (S2);
    with fewer available the run fails before anything is published, or goes
    on with what there is (``on_short="accept"``).  ``group``: start after the
    group's offsets (S3), append to the topics, and commit both in one version;
    ``offsets_path`` gets a copy of the offsets.  Staged copies are removed at the end,
    whether the run succeeds or not.  ``num_buckets``: sort buckets.
    ``source_topic`` and ``sorted_topics`` (in order of the sort keys id, name,
    continent) rename the topics.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error must be 'fail' or 'skip'")
    if on_short not in ("fail", "accept"):
        raise ValueError("on_short must be 'fail' or 'accept'")
    if group is not None and source_log is None:
        raise ValueError("group needs an existing source log")
    out = out or work_path(spark, "batch")
    run = BatchRun(path=out, run_id=run_id, source_topic=source_topic)
    folders: list[str] = []
    made = Publication(spark, out)
    began = time.time()
    try:
        _run(spark, run, made, source_log, ids, records, seed, partitions, on_error, consume, on_short, group, offsets_path,
             source_topic, sorted_topics, num_buckets, folders)
    finally:
        made.abandon()  # nothing, once the version is made
        run.stages.append(("overall", run.counters["produced"], time.time() - began))
        for folder in folders:
            remove_folder(spark, folder)
        if report_path:
            run.report_frame(spark).write.mode("append").parquet(report_path)
            run.counters_frame(spark).withColumn("run", F.lit(run_id)).write.mode("append").parquet(
                f"{report_path.rstrip('/')}-counters")
    return run


def _run(spark, run, made, source_log, ids, records, seed, partitions, on_error, consume, on_short, group, offsets_path,
         source_topic, sorted_topics, num_buckets, folders) -> None:
    def counted(error: str, fn):
        try:
            return fn()
        except Exception:
            run.counters[error] += 1
            raise

    if source_log is None:
        if records is not None:
            ids = spark.range(0, records).withColumnRenamed("id", "rid")
            published = publish_balanced(generate_for(ids, seed), source_topic, partitions, index="rid")
        elif ids is not None:
            # Generation order is the ids' own partition order: no shuffle.
            published = publish_balanced(generate_for(ids, seed), source_topic, partitions)
        else:
            raise ValueError("one of source_log, records or ids is required")
        t0 = time.time()
        run.counters["generated"] = counted("generation_errors", lambda: _observed_write(made, published, source_topic))
        run.stages.append(("generate", run.counters["generated"], time.time() - t0))
        source_log = made.read(source_topic)
    else:
        # Skip-generate: the source topic stays where it is (no copy).
        run.source = source_log

    # Snapshot (K4): consume the source topic once, decode once, stage the
    # decoded columns; the three sorts re-read this table.  Consumed and
    # rejected counts are observed on that single write.
    available = source_log.where(F.col("topic") == source_topic)
    if group is not None:
        run.seq, committed = _group_state(spark, made, group, offsets_path)
        available = read_resume(available, committed, group)
    if consume is not None:
        available = read_first_n(available, source_topic, consume)
    raw = available.select(
        F.col("partition").alias("src_partition"), F.col("offset").alias("src_offset"), "value")
    decoded = codec.decode(raw)
    if on_error == "fail":
        decoded = codec.fail_on_reject(decoded)
    snap_obs = Observation("snapshot")
    observed = decoded.drop("value").observe(
        snap_obs, F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col("reject_reason").isNotNull(), 1).otherwise(0)).alias("rejected"))
    t0 = time.time()
    staged = stage(observed, "snapshot", folders=folders)
    metrics = snap_obs.get
    run.counters["consumed"] = int(metrics.get("rows") or 0)
    run.counters["rejected"] = int(metrics.get("rejected") or 0)
    run.stages.append(("snapshot", run.counters["consumed"], time.time() - t0))
    if consume is not None and run.counters["consumed"] < consume and on_short == "fail":
        raise ShortRead(f"{run.counters['consumed']} of {consume} messages are available")
    # Publish re-encodes the decoded record, never the raw line (which may
    # carry outer spaces or an id suffix).
    records = staged.where(F.col("reject_reason").isNull()).drop("reject_reason")

    def sort_and_publish(key: str, topic: str) -> tuple[str, int, int, float, float]:
        t0 = time.time()
        obs = Observation(f"sort_{key}")
        srt = counted("sorting_errors", lambda: sort_records(
            records, key, ["src_partition", "src_offset"], num_buckets=num_buckets, total_col="_total",
            observation=obs, folders=folders))
        t1 = time.time()

        def publish() -> int:
            messages = publish_sorted(srt, topic, partitions)
            if run.seq:
                messages = _continued(messages, made.read(topic, published=True))
            return _observed_write(made, messages, topic, append=run.seq is not None)

        n_out = counted("production_errors", publish)
        return key, int(obs.get.get("rows", 0)), n_out, t1 - t0, time.time() - t1

    # The orderings are independent jobs over the same staged snapshot;
    # submitting them together lets the scheduler overlap their stages.
    with ThreadPoolExecutor(max_workers=len(SORTED_TOPICS)) as pool:
        results = list(pool.map(sort_and_publish, SORTED_TOPICS, sorted_topics))
    for key, n_sorted, n_out, sec_sort, sec_pub in results:
        run.stages.append((f"sort_{key}", n_sorted, sec_sort))
        run.stages.append((f"publish_{key}", n_out, sec_pub))
        run.counters["sorted"] += n_sorted
        run.counters["produced"] += n_out
    if group is not None:
        run.version = _commit(made, staged, committed, source_topic, group, offsets_path, run.seq)
    else:
        run.version = made.commit()
