"""Count-triggered sorted runs on a stream (M1-M8).

Per source partition, every ``chunk`` valid records form a run; each run is
emitted sorted three ways (id, name, continent).  A record's run is fixed by
its ``seq``, the 0-based index among the *valid* records of its partition, so
the final output does not depend on how arrivals are cut into micro-batches,
as long as a partition's offsets never go back from one batch to the next.
A batch that goes back is refused.

Design: ``foreachBatch`` running ordinary batch jobs (a streaming DataFrame
cannot be sorted), with all state kept in tables under ``base``:

``stage/batch=<id>``     run assignment of the batch's valid records (M1) and
                         its bad lines with their reason (M4); an output, never
                         read again by the stream
``open/batch=<id>``      the records of runs still open: under ``chunk`` per partition
``out/batch=<id>``       runs closed by the batch, sorted three ways (M2), as
                         messages of a log: topic, partition, dense offset, key, value (M3)
``flush/batch=<id>``     the open runs published at the end of input (M6)
``progress/batch=<id>``  counters of the batch (M8)
``manifest/batch=<id>``  per source partition the next ``seq`` and the last offset,
                         per topic partition the next offset, and the query the
                         state belongs to -- written last, so a batch without a
                         manifest is not committed

A batch reads its own input, the previous manifest and the previous open
records, and nothing older: its cost does not grow with the stream's age, nor
with how long another partition has been quiet.  Older open tables and
manifests are deleted.  Every write overwrites its own ``batch=<id>`` folder
and depends only on those inputs, so a replayed batch id (after a crash
between the write and Spark's commit) reproduces the same files: effectively
once.  The in-batch index comes from offset blocks, joined back as a table; a
run's sort is a window partitioned by ``(sort_key, partition, run_id)``, i.e.
at most ``chunk`` rows per group.  Only the manifest, one row per partition,
passes through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codec import decode, encode_line
from ..functions.tables import small_table
from ..operators.order import stage
from ..schema import LOG_COLUMNS, LOG_PARTITIONS, LOG_SCHEMA, SORTED_TOPICS, SOURCE_TOPIC, run_length
from ..session import list_folder, remove_folder, shuffle_partitions
from ..sinks.publish import hash_partition
from ..sources.log import kafka_to_log

MANIFEST_SCHEMA = ("kind string, topic string, partition int, next_seq bigint, last_offset bigint, "
                   "next_offset bigint, query string")
STAGE_SCHEMA = ("offset bigint, seq bigint, run_id bigint, id int, name string, address string, "
                "continent string, value string, reject_reason string, batch int, partition int")
OPEN_SCHEMA = "partition int, offset bigint, run_id bigint, id int, name string, address string, continent string"
PROGRESS_SCHEMA = ("batch_id bigint, consumed bigint, accepted bigint, rejected bigint, "
                   "runs_closed bigint, rows_out bigint")
OUT_SCHEMA = ("sort_key string, src_partition int, run_id bigint, pos bigint, id int, name string, address string, "
              "continent string, src_offset bigint, topic string, partition int, offset bigint, key string, value string")
OUT_COLUMNS = [c.split()[0] for c in OUT_SCHEMA.split(", ")]
#: Topic partitions up to which places in them are counted beside the sort, one sum each.
COUNTED_PARTITIONS = 16


class StreamStateError(RuntimeError):
    """The state does not belong to this query, or the input went back."""


@dataclass
class Manifest:
    """State after a batch: one entry per source partition and per topic partition."""

    query: str | None
    next_seq: dict[int, int]
    last_offset: dict[int, int]
    next_offset: dict[tuple[str, int], int]


@dataclass
class StreamRuns:
    """The batch function of the streaming run producer and its readers."""

    base: str
    chunk: int
    partitions: int = LOG_PARTITIONS
    sort_keys: Sequence[str] = tuple(SORTED_TOPICS)
    block: int = 1 << 16
    topic: str = SOURCE_TOPIC

    def __post_init__(self) -> None:
        self.chunk = run_length(self.chunk)
        self.base = self.base.rstrip("/")

    def _batch_dir(self, name: str, batch_id: int) -> str:
        return f"{self.base}/{name}/batch={batch_id}"

    # ---- state ---------------------------------------------------------------

    def _complete(self, spark: SparkSession, name: str) -> list[int]:
        """Batch ids whose folder of a table was written to the end."""
        return sorted(int(f.removeprefix("batch=")) for f in list_folder(spark, f"{self.base}/{name}")
                      if f.startswith("batch=") and "_SUCCESS" in list_folder(spark, f"{self.base}/{name}/{f}"))

    def last_committed(self, spark: SparkSession) -> int | None:
        """Highest batch id with a manifest.  Batches commit in id order, so
        every id up to this one is committed; a missing folder means none is,
        and any other storage error is raised."""
        done = self._complete(spark, "manifest")
        return done[-1] if done else None

    def committed_batches(self, spark: SparkSession) -> list[int]:
        last = self.last_committed(spark)
        return [] if last is None else list(range(last + 1))

    def _manifest(self, spark: SparkSession, batch_id: int) -> Manifest:
        """The state after ``batch_id`` (empty before batch 0); bounded by the topic layout."""
        out = Manifest(None, {}, {}, {})
        if batch_id < 0:
            return out
        for r in spark.read.schema(MANIFEST_SCHEMA).parquet(self._batch_dir("manifest", batch_id)).collect():
            out.query = r["query"]
            if r["kind"] == "source":
                out.next_seq[r["partition"]] = r["next_seq"]
                out.last_offset[r["partition"]] = r["last_offset"]
            elif r["kind"] == "topic":
                out.next_offset[r["topic"], r["partition"]] = r["next_offset"]
        return out

    def _previous(self, spark: SparkSession, batch_id: int, query: str | None) -> Manifest:
        """State before ``batch_id``, refused if it is another query's."""
        done = self._complete(spark, "manifest")
        if batch_id > 0 and batch_id - 1 not in done:
            raise StreamStateError(f"batch {batch_id} has no state to follow under {self.base}")
        if done and done[-1] > batch_id:
            raise StreamStateError(f"{self.base} already holds batch {done[-1]}; batch {batch_id} starts over on old state")
        prev = self._manifest(spark, batch_id - 1)
        for b, state in [(batch_id - 1, prev)] + ([(batch_id, self._manifest(spark, batch_id))] if batch_id in done else []):
            if b >= 0 and state.query != query:
                raise StreamStateError(f"the state under {self.base} belongs to another streaming query")
        return prev

    # ---- the batch function --------------------------------------------------

    def _messages(self, spark: SparkSession, rows: DataFrame, runs: list[tuple[int, int, int, int]],
                  state: Manifest, used: list[str]) -> tuple[DataFrame, dict[tuple[str, int], int]]:
        """Closed runs sorted three ways, as messages with dense offsets per topic partition.

        ``runs`` has ``(partition, first run, end run, rows of each)``.  A run's
        keys depend only on its number and length, so how many of its messages
        a topic partition gets is counted without touching the data.  ``used``
        gets the folders to remove once the messages are written.
        """
        tagged = rows.withColumn("sort_key", F.explode(F.array(*[F.lit(k) for k in self.sort_keys])))
        # Key-specific leading field; the id and source offset complete every order.
        lead = (F.when(F.col("sort_key") == "name", F.col("name"))
                .when(F.col("sort_key") == "continent", F.col("continent"))
                .otherwise(F.lit("")))
        w = Window.partitionBy("sort_key", "src_partition", "run_id").orderBy(lead, "id", "src_offset")
        key = F.concat_ws("-", F.col("src_partition").cast("string"), F.col("run_id").cast("string"),
                          F.col("pos").cast("string"))
        out = tagged.withColumnRenamed("partition", "src_partition").withColumnRenamed("offset", "src_offset").withColumn(
            "pos", (F.row_number().over(w) - 1).cast("bigint")).withColumn("key", key).withColumn(
            "partition", hash_partition("key", self.partitions)).withColumn("value", encode_line())
        # Window partitioned by the run still: the exchange above serves both.
        if self.partitions <= COUNTED_PARTITIONS:
            # Messages of the run so far, counted per topic partition in the order above: no second sort.
            so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            out = out.withColumn("_at", F.coalesce(*[
                F.when(F.col("partition") == p, F.sum((F.col("partition") == p).cast("bigint")).over(so_far))
                for p in range(self.partitions)]) - 1)
        else:
            at = Window.partitionBy("sort_key", "src_partition", "run_id", "partition").orderBy("pos")
            out = out.withColumn("_at", F.row_number().over(at) - 1)
        # One row per (closed run, topic partition), the same for every topic; both uses below read it.
        spans = small_table(spark, runs, "src_partition int, _lo bigint, _hi bigint, _n bigint")
        slots = spans.select("src_partition", "_n", F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1)).alias("run_id"))
        slots = slots.repartition(shuffle_partitions(spark), "src_partition", "run_id")  # a number, or its few bytes would be one task
        slots = slots.select("src_partition", "run_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("pos"))
        counts = stage(slots.withColumn("partition", hash_partition(key, self.partitions)).groupBy(
            "partition", "src_partition", "run_id").agg(F.count(F.lit(1)).alias("_c")), "slots", folders=used)
        before = Window.partitionBy("partition").orderBy("src_partition", "run_id").rowsBetween(
            Window.unboundedPreceding, -1)
        starts = counts.withColumn("_start", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        sizes = {r[0]: r[1] for r in counts.groupBy("partition").agg(F.sum("_c")).collect()}  # one row per topic partition
        base = small_table(spark, [(k, p, state.next_offset.get((k, p), 0)) for k in self.sort_keys
                                   for p in range(self.partitions)], "sort_key string, partition int, _base bigint")
        out = out.join(starts.drop("_c"), ["partition", "src_partition", "run_id"]).join(
            F.broadcast(base), ["sort_key", "partition"])
        ends = {(k, p): state.next_offset.get((k, p), 0) + sizes.get(p, 0)
                for k in self.sort_keys for p in range(self.partitions)}
        return out.withColumn("offset", (F.col("_base") + F.col("_start") + F.col("_at")).cast("bigint")).withColumn(
            "topic", F.col("sort_key")).select(*OUT_COLUMNS), ends

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        prev = self._previous(spark, batch_id, query)

        # The micro-batch is used by several jobs below: decode it once.
        source = batch.where(F.col("topic") == self.topic).select("partition", "offset", "value")
        decoded = decode(source).withColumn(
            "_blk", F.floor(F.col("offset") / self.block).cast("bigint")).persist()
        is_bad = F.col("reject_reason").isNotNull()
        try:
            per_block = decoded.groupBy("partition", "_blk").agg(
                F.sum(F.when(is_bad, 0).otherwise(1)).alias("n"), F.sum(F.when(is_bad, 1).otherwise(0)).alias("bad"),
                F.min("offset").alias("first"), F.max("offset").alias("last"))
            # One row per source partition.
            parts = {r["partition"]: r for r in per_block.groupBy("partition").agg(
                F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.min("first").alias("first"),
                F.max("last").alias("last")).collect()}
            for p, r in parts.items():
                if r["first"] <= prev.last_offset.get(p, -1):
                    raise StreamStateError(
                        f"partition {p}: offset {r['first']} arrives after {prev.last_offset[p]}")
            # seq = previous next_seq of the partition + valid rows of earlier
            # offset blocks in this batch + row number inside the block.
            known = small_table(spark, [(p, n) for p, n in prev.next_seq.items()] or [(-1, 0)], "partition int, _next bigint")
            earlier = Window.partitionBy("partition").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
            bases = per_block.join(F.broadcast(known), "partition", "left").select(
                "partition", "_blk", (F.coalesce("_next", F.lit(0)) + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("_base"))
            valid = decoded.where(~is_bad).drop("reject_reason", "value")
            w = Window.partitionBy("partition", "_blk").orderBy("offset")
            seq = F.col("_base") + F.row_number().over(w) - 1
            staged = valid.join(bases, ["partition", "_blk"]).select(
                "partition", "offset", seq.alias("seq"),
                F.floor(seq / self.chunk).cast("bigint").alias("run_id"),
                "id", "name", "address", "continent",
                F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("reject_reason"))
            # Accepted records and rejected lines (M4) of the batch: one write.
            bad = decoded.where(is_bad).select(
                "partition", "offset", F.lit(None).cast("bigint").alias("seq"),
                F.lit(None).cast("bigint").alias("run_id"), "id", "name", "address", "continent",
                "value", "reject_reason")
            staged.unionByName(bad).write.mode("overwrite").parquet(self._batch_dir("stage", batch_id))
        finally:
            decoded.unpersist()

        # Runs closed here: [old_next div chunk, new_next div chunk) per partition.
        state = Manifest(query, dict(prev.next_seq), dict(prev.last_offset), dict(prev.next_offset))
        closed, still_open = [], []
        for p, r in parts.items():
            old = prev.next_seq.get(p, 0)
            state.next_seq[p], state.last_offset[p] = old + r["n"], r["last"]
            lo, hi = old // self.chunk, state.next_seq[p] // self.chunk
            if hi > lo:
                closed.append((p, lo, hi, self.chunk))
        for p, n in state.next_seq.items():
            if n % self.chunk:
                still_open.append((p, n // self.chunk))

        here = spark.read.schema(STAGE_SCHEMA).parquet(self._batch_dir("stage", batch_id)).where(
            F.col("reject_reason").isNull()).select("partition", "offset", "run_id", "id", "name", "address", "continent")
        rows = here.unionByName(self._open(spark, batch_id - 1))
        rows_out = 0
        if closed:
            ranges = small_table(spark, closed, "partition int, _lo bigint, _hi bigint, _n bigint")
            ready = rows.join(F.broadcast(ranges), "partition").where("run_id >= _lo AND run_id < _hi").drop("_lo", "_hi", "_n")
            messages, state.next_offset = self._messages(spark, ready, closed, prev, used := [])
            seen = Observation(f"stream-out-{batch_id}")
            messages.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
                self._batch_dir("out", batch_id))
            rows_out = int(seen.get.get("rows") or 0)
            for folder in used:
                remove_folder(spark, folder)
        runs = small_table(spark, still_open or [(-1, -1)], "partition int, run_id bigint")
        rows.join(F.broadcast(runs), ["partition", "run_id"], "left_semi").select(
            *[c.split()[0] for c in OPEN_SCHEMA.split(", ")]).write.mode("overwrite").parquet(
            self._batch_dir("open", batch_id))

        accepted, rejected = sum(r["n"] for r in parts.values()), sum(r["bad"] for r in parts.values())
        small_table(
            spark, [(batch_id, accepted + rejected, accepted, rejected,
                     sum(hi - lo for _, lo, hi, _ in closed), rows_out)], PROGRESS_SCHEMA
        ).coalesce(1).write.mode("overwrite").parquet(self._batch_dir("progress", batch_id))
        # Commit marker of this batch: written last.
        self._write_manifest(spark, batch_id, state)
        for name in ("open", "manifest"):
            for b in self._complete(spark, name):
                if b < batch_id - 1:  # a replay of this batch needs the one before
                    remove_folder(spark, self._batch_dir(name, b))

    def _open(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return small_table(spark, [], OPEN_SCHEMA)
        return spark.read.schema(OPEN_SCHEMA).parquet(self._batch_dir("open", batch_id))

    def _write_manifest(self, spark: SparkSession, batch_id: int, state: Manifest) -> None:
        rows = [("query", None, None, None, None, None, state.query)]
        rows += [("source", None, p, n, state.last_offset.get(p), None, state.query) for p, n in state.next_seq.items()]
        rows += [("topic", t, p, None, None, n, state.query) for (t, p), n in state.next_offset.items()]
        small_table(spark, rows, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self._batch_dir("manifest", batch_id))

    # ---- end of input and readers ------------------------------------------

    def flush_open_runs(self, spark: SparkSession) -> int:
        """M6: publish the short runs still open at the end of input.

        The flush belongs to the last committed batch: once a later batch is
        committed, its runs go on growing and readers ignore the flush.
        """
        last = self.last_committed(spark)
        if last is None:
            return 0
        state = self._manifest(spark, last)
        open_runs = [(p, n // self.chunk, n // self.chunk + 1, n % self.chunk)
                     for p, n in state.next_seq.items() if n % self.chunk]
        if not open_runs:
            return 0
        messages, _ = self._messages(spark, self._open(spark, last), open_runs, state, used := [])
        seen = Observation(f"stream-flush-{last}")
        messages.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
            self._batch_dir("flush", last))
        for folder in used:
            remove_folder(spark, folder)
        return int(seen.get.get("rows") or 0)

    def _committed(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        """Rows of committed batches only (a batch without a manifest is ignored)."""
        last = self.last_committed(spark)
        if last is None:
            raise RuntimeError(f"no committed batch under {self.base}")
        # A batch's manifest comes after its tables, so folders up to the last one are whole.
        if not list_folder(spark, f"{self.base}/{name}"):
            return small_table(spark, [], f"{schema}, batch int" if "batch int" not in schema else schema)
        schema = schema if "batch int" in schema else f"{schema}, batch int"
        return spark.read.schema(schema).option("basePath", f"{self.base}/{name}").parquet(
            f"{self.base}/{name}").where(F.col("batch") <= last)

    def output(self, spark: SparkSession, include_flush: bool = False) -> DataFrame:
        """Closed runs, and on request the flushed ones if no batch came after the flush."""
        out = self._committed(spark, "out", OUT_SCHEMA).select(*OUT_COLUMNS)
        last = self.last_committed(spark)
        if include_flush and "_SUCCESS" in list_folder(spark, self._batch_dir("flush", last)):
            out = out.unionByName(spark.read.schema(OUT_SCHEMA).parquet(self._batch_dir("flush", last)).select(*OUT_COLUMNS))
        return out

    def log(self, spark: SparkSession, include_flush: bool = False) -> DataFrame:
        """The output as topics: ``topic, partition, offset, key, value``."""
        return self.output(spark, include_flush).select(*LOG_COLUMNS)

    def staged(self, spark: SparkSession) -> DataFrame:
        return self._committed(spark, "stage", STAGE_SCHEMA).where(F.col("reject_reason").isNull()).select(
            "partition", "offset", "seq", "run_id", "id", "name", "address", "continent")

    def rejects(self, spark: SparkSession) -> DataFrame:
        return self._committed(spark, "stage", STAGE_SCHEMA).where(F.col("reject_reason").isNotNull()).select(
            "partition", "offset", "value", "reject_reason")

    def progress(self, spark: SparkSession) -> DataFrame:
        return self._committed(spark, "progress", PROGRESS_SCHEMA).drop("batch")


def stream_reader(spark: SparkSession, source: str, *, files_per_trigger: int | None = None,
                  source_format: str = "parquet", options: Mapping[str, str] | None = None):
    """A streaming log: files with the log's schema, or a Kafka topic.

    Files: ``source`` is the folder; ``files_per_trigger`` bounds a micro-batch
    (all new files without it).  Kafka (needs the spark-sql-kafka package):
    ``source`` is the topic and ``options`` name the servers; that source has
    its own schema and limits, so neither schema, path nor file option is set.
    """
    if source_format == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", source)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return kafka_to_log(reader.load())
    reader = spark.readStream.schema(LOG_SCHEMA)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(source_format).load(source)


def start_stream(spark: SparkSession, source: str, runner: StreamRuns, checkpoint: str, *,
                 files_per_trigger: int | None = None, available_now: bool = True,
                 processing_time: str | None = None, source_format: str = "parquet",
                 options: Mapping[str, str] | None = None):
    """M7: bounded (``availableNow``) or continuous (``processingTime``) run."""
    stream = stream_reader(spark, source, files_per_trigger=files_per_trigger, source_format=source_format, options=options)
    writer = stream.writeStream.foreachBatch(runner.process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "10 seconds")
    return writer.start()
