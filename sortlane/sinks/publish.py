"""Log-table sinks (K1-K5): assign ``(partition, offset)`` and write.

Offsets are dense per partition and derived from a global position, never
from a window over a whole log partition (one task per log partition would
not scale).  Tables are parquet (snappy) partitioned by ``topic``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import encode_line
from ..functions.tables import small_table
from ..operators.order import stage, with_index, with_position
from ..schema import LOG_COLUMNS, LOG_PARTITIONS, LOG_SCHEMA
from ..session import list_folder


def write_log(log: DataFrame, path: str, mode: str = "overwrite", topic: str | None = None,
              run: int | None = None) -> None:
    """Write log rows; only the written topics are replaced.

    ``topic`` given (all rows belong to it): the rows go straight to that
    topic's folder, so the writer needs no per-task sort by topic, which a
    ``partitionBy`` write would add.  ``run``: the topic is appended to, and
    only the part that run wrote before is replaced.
    """
    if topic is not None:
        part = f"{path.rstrip('/')}/topic={topic}" + (f"/run={int(run)}" if run is not None else "")
        log.select(*[c for c in LOG_COLUMNS if c != "topic"]).write.mode(mode).parquet(part)
        return
    (log.select(*LOG_COLUMNS).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("topic").parquet(path))


def _value(df: DataFrame) -> Column:
    return F.col("value") if "value" in df.columns else encode_line()


def hash_partition(key: str | Column, partitions: int = LOG_PARTITIONS) -> Column:
    """Same key -> same partition: first 32 bits of md5(key) modulo the partition count."""
    k = F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint"),
                  F.lit(partitions)).cast("int")


def publish_balanced(df: DataFrame, topic: str, partitions: int = LOG_PARTITIONS,
                     order: Sequence[str] | None = None, index: str | None = None,
                     num_buckets: int | None = None) -> DataFrame:
    """K1: near-equal partitions (sizes differ by at most one), no key.

    Message ``i`` of the input order goes to partition ``i mod P`` at offset
    ``i div P``.  ``index``: a column that already holds that dense 0-based
    ``i`` (e.g. ``rid`` of ``spark.range``), used as is.  Otherwise ``order``
    ranks the rows, or, without it, the input's own partition order is used
    and nothing is shuffled.
    """
    if index is not None:
        idx = df.withColumn("_idx", F.col(index).cast("bigint"))
    else:
        idx = with_position(df, order, "_idx", num_buckets) if order else with_index(df, "_idx")
    return idx.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.col("_idx"), F.lit(partitions)).cast("int").alias("partition"),
        F.floor(F.col("_idx") / partitions).cast("bigint").alias("offset"),
        F.lit(None).cast("string").alias("key"),
        _value(df).alias("value"),
    )


def publish_hash_keyed(df: DataFrame, topic: str, key: str | Column,
                       order: Sequence[str], partitions: int = LOG_PARTITIONS,
                       num_buckets: int | None = None) -> DataFrame:
    """K2: partition by key hash; offsets follow ``order`` inside each partition.

    The position is taken over ``(partition, order)`` with range cuts, so one
    hot key filling a third of the log is still split across many tasks; the
    first position of each partition comes from a P-row aggregate.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    keyed = df.withColumn("_key", key_col.cast("string")).withColumn(
        "partition", hash_partition("_key", partitions))
    pos = with_position(keyed, ["partition", *order], "_pos", num_buckets)
    firsts = pos.groupBy("partition").agg(F.min("_pos").alias("_first"))
    return pos.join(F.broadcast(firsts), "partition").select(
        F.lit(topic).alias("topic"),
        "partition",
        (F.col("_pos") - F.col("_first")).alias("offset"),
        F.col("_key").alias("key"),
        _value(df).alias("value"),
    )


def publish_sorted(sorted_df: DataFrame, topic: str, partitions: int = LOG_PARTITIONS,
                   pos: str = "pos", total: str = "_total", key: str | None = None) -> DataFrame:
    """K3: contiguous position ranges per partition, so the order holds within
    each partition and across partition seams (partition p holds positions
    ``[ceil(p*N/P), ceil((p+1)*N/P))``).  ``key``: column of the message keys."""
    part = F.expr(f"({pos} * {partitions}) div {total}").cast("int")
    first = F.expr(f"((({pos} * {partitions}) div {total}) * {total} + {partitions - 1}) div {partitions}")
    return sorted_df.select(
        F.lit(topic).alias("topic"),
        part.alias("partition"),
        (F.col(pos) - first).cast("bigint").alias("offset"),
        (F.col(key) if key else F.lit(None)).cast("string").alias("key"),
        _value(sorted_df).alias("value"),
    )


def stage_snapshot(log: DataFrame, topic_name: str, path: str | None = None) -> DataFrame:
    """K4: consume a topic once into a staged table that every sort re-reads."""
    snap = log.where(F.col("topic") == F.lit(topic_name)).select("partition", "offset", "key", "value")
    if path is None:
        return stage(snap, f"snapshot-{topic_name}")
    snap.write.mode("overwrite").parquet(path)
    return log.sparkSession.read.parquet(path)


def export_lines(df: DataFrame, path: str, value: str = "value") -> None:
    """Text form of a snapshot: one line per message, newline-terminated."""
    df.select(F.col(value)).write.mode("overwrite").text(path)


def publish_idempotent(log: DataFrame, base: str, seq: int) -> str:
    """K5: write run number ``seq`` to ``base/run=<seq>``, whole, then its manifest.

    A retry overwrites its own folder, topics that it no longer has included.
    A run without a manifest row (a crash between the two writes) isn't seen.
    """
    base = base.rstrip("/")
    path = f"{base}/run={int(seq)}"
    log.select(*LOG_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "topic").parquet(path)
    small_table(log.sparkSession, [(int(seq),)], "run bigint").coalesce(1).write.mode("overwrite").parquet(
        f"{base}/_runs/seq={int(seq)}")
    return path


def published_runs(spark: SparkSession, base: str) -> list[int]:
    """Numbers of the runs whose manifest is complete."""
    runs = f"{base.rstrip('/')}/_runs"
    return sorted(int(f.removeprefix("seq=")) for f in list_folder(spark, runs)
                  if f.startswith("seq=") and "_SUCCESS" in list_folder(spark, f"{runs}/{f}"))


def read_published(spark: SparkSession, base: str) -> DataFrame:
    """Reader side of K5: the messages of the last complete run, by number.

    Only that run's folder is read; there is nothing to merge, so no shuffle.
    """
    runs = published_runs(spark, base)
    if not runs:
        raise RuntimeError(f"no published run under {base}")
    return spark.read.schema(LOG_SCHEMA).parquet(f"{base.rstrip('/')}/run={runs[-1]}").select(*LOG_COLUMNS)


def log_to_kafka(log: DataFrame) -> DataFrame:
    """Log rows in the columns of Spark's Kafka sink, one task per Kafka
    partition in offset order, so that the broker keeps the topic's order."""
    keys = ["topic", "partition"]
    lanes = max(1, log.select(*keys).distinct().count())  # bounded by the topic layout
    return log.repartition(lanes, *keys).sortWithinPartitions(*keys, "offset").select(
        "topic", "partition", F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


def write_kafka(log: DataFrame, bootstrap_servers: str, **options: str) -> None:
    """Produce log rows to Kafka in order (needs the spark-sql-kafka package)."""
    writer = log_to_kafka(log).write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save()
