"""Log-table sources (S2-S7) and offset commits.

A log table has the columns of Spark's Kafka source
(``topic, partition, offset, key, value``) and is stored as parquet
partitioned by ``topic``.  Offsets are dense per (topic, partition), which
every writer in ``sortlane.sinks`` guarantees.  With a real broker the same
functions apply to ``spark.read.format("kafka")`` after casting key/value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.tables import small_table
from ..schema import LOG_COLUMNS
from ..session import list_folder
from ..sinks.versions import VERSIONS, list_versions, read_state, read_version

#: Offsets per block of the per-block counts.
OFFSET_BLOCK = 1 << 16


def read_log(spark: SparkSession, path: str, upto_run: int | None = None, version: int | None = None) -> DataFrame:
    """Read a log table.

    A table published in versions (``sinks.versions``) is read as of its last
    version, or of ``version``: all topics of a publication or none of them.
    Without versions, topics are read folder by folder, so a topic that is
    appended to run by run may lie beside one that isn't, and a filter on the
    topic leaves only its folder in the plan.  ``upto_run``: without the
    messages of later runs.
    """
    if version is not None or list_versions(spark, f"{path.rstrip('/')}/{VERSIONS}"):
        return read_version(spark, path, version)
    out = small_table(spark, [], "topic string, partition int, offset bigint, key string, value string")
    for name in list_topics(spark, path):
        part = spark.read.parquet(f"{path.rstrip('/')}/topic={name}")
        if upto_run is not None and "run" in part.columns:
            part = part.where(F.col("run") <= upto_run)
        out = out.unionByName(part.withColumn("topic", F.lit(name)).select(*LOG_COLUMNS))
    return out


def list_topics(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """Topics that exist in a log table, with or without messages: those of its
    version, or its topic folders where it has none."""
    number, state = read_state(spark, f"{path.rstrip('/')}/{VERSIONS}", version)
    if number >= 0:
        return sorted(state["topics"])
    return sorted(f.removeprefix("topic=") for f in list_folder(spark, path) if f.startswith("topic="))


def topic(log: DataFrame, name: str) -> DataFrame:
    return log.where(F.col("topic") == F.lit(name))


def read_partition(log: DataFrame, name: str, partition: int) -> DataFrame:
    """One partition of one topic (pruned to the topic folder and pushed to the scan)."""
    return topic(log, name).where(F.col("partition") == F.lit(partition))


def topic_offsets(log: DataFrame) -> DataFrame:
    """Per (topic, partition) first offset, next offset and message count."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        (F.max("offset") + 1).alias("next_offset"),
        F.count(F.lit(1)).alias("n"),
    )


def read_first_n(log: DataFrame, name: str, n: int, block: int = OFFSET_BLOCK) -> DataFrame:
    """Exactly the first ``n`` messages of a topic in (partition, offset) order.

    Offsets may have gaps (compaction, transactions).  Messages are counted per
    offset block (one row per ``block`` offsets); a block's place is the count
    of the partitions before it (one row per partition) plus that of the blocks
    before it in its own.  Blocks that fit are taken whole; the one block that
    holds the cut ranks its own messages, at most ``block`` of them.
    """
    t = topic(log, name).withColumn("_blk", F.floor(F.col("offset") / block).cast("bigint"))
    counts = t.groupBy("partition", "_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    before = lambda w: F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = counts.groupBy("partition").agg(F.sum("_cnt").alias("_cnt")).select(
        F.col("partition").alias("_p"), before(Window.orderBy("partition")).alias("_base"))
    taken = counts.withColumn("_in", before(Window.partitionBy("partition").orderBy("_blk"))).join(
        F.broadcast(parts), F.col("partition") == F.col("_p")).withColumn(
        "_room", F.lit(n) - F.col("_base") - F.col("_in")).where("_room > 0").select("partition", "_blk", "_cnt", "_room")
    rows = t.join(taken, ["partition", "_blk"])
    rank = F.row_number().over(Window.partitionBy("partition", "_blk").orderBy("offset"))
    cut = rows.where("_cnt > _room").withColumn("_rank", rank).where("_rank <= _room")
    return rows.where("_cnt <= _room").select(*LOG_COLUMNS).unionByName(cut.select(*LOG_COLUMNS))


def head(log: DataFrame, name: str, k: int) -> DataFrame:
    """The first ``k`` messages (top-k; planned as TakeOrderedAndProject)."""
    return topic(log, name).orderBy("partition", "offset").limit(k)


def commit_offsets(consumed: DataFrame, group: str) -> DataFrame:
    """Committed offsets ``(group, topic, partition, next_offset)`` of what was consumed.

    Written only after the consumer's output is durable (the original
    committed on a timer, independent of its file).
    """
    return consumed.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("next_offset")
    ).select(F.lit(group).alias("group"), "topic", "partition", "next_offset")


def read_resume(log: DataFrame, committed: DataFrame, group: str) -> DataFrame:
    """S3: messages at or after the committed offset of ``group`` (from 0 if none).

    The committed table has one row per (group, topic, partition); the planner
    picks the join from its size.
    """
    mine = committed.where(F.col("group") == F.lit(group)).select("topic", "partition", "next_offset")
    return (
        log.join(mine, ["topic", "partition"], "left")
        .where(F.col("offset") >= F.coalesce(F.col("next_offset"), F.lit(0)))
        .select(*LOG_COLUMNS)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newline-separated lines as ``value`` (only ``\\n`` ends a line; a
    trailing ``\\r`` stays in the line and is removed by the decode trim)."""
    return spark.read.option("lineSep", "\n").text(path)


def kafka_to_log(df: DataFrame) -> DataFrame:
    """Rows of Spark's Kafka source (binary key and value) as log rows."""
    return df.select(
        "topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"),
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def read_kafka_log(spark: SparkSession, bootstrap_servers: str, topics: str,
                   starting_offsets: str = "earliest", ending_offsets: str = "latest",
                   **options: str) -> DataFrame:
    """The same log columns from a Kafka cluster (needs the spark-sql-kafka package).

    ``startingOffsets``/``endingOffsets`` take the JSON per-partition form for
    bounded reads (S2/S3 with a broker); every function in this module then
    applies unchanged.
    """
    reader = (spark.read.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topics)
              .option("startingOffsets", starting_offsets)
              .option("endingOffsets", ending_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return kafka_to_log(reader.load())
