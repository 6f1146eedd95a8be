"""Bounded read of a stream that waits for its messages.

A reader asks for exactly ``n`` messages and waits until they have arrived; it
stops by itself.  Messages count in the order of arrival (micro-batch, then
partition and offset), and the batch that holds the last one is cut exactly.
What came with it or after it is kept for the next read, so reads follow each
other without loss, whatever the source's checkpoint has already passed.

State is a chain of versions (``sinks.versions``), one per micro-batch: how
many messages the read has, and which folders hold what was taken and what was
left.  Folders are written before the version that names them, so a replayed
micro-batch, known by its number, either finds its version or writes its
folders again.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.tables import small_table
from ..schema import LOG_COLUMNS, LOG_SCHEMA, SOURCE_TOPIC
from ..session import remove_folder
from ..sinks.versions import create_state, read_state
from ..sources.log import read_first_n


class StillWaiting(RuntimeError):
    """The messages haven't all arrived in time; what has arrived is kept, and the read can go on."""


@dataclass
class BoundedReader:
    """Reads of one topic of one stream, one after another."""

    base: str
    topic: str = SOURCE_TOPIC

    def __post_init__(self) -> None:
        self.base = self.base.rstrip("/")

    # ---- state -----------------------------------------------------------------

    def state(self, spark: SparkSession) -> tuple[int, dict]:
        """``batch``: last micro-batch seen; ``read``: number of the read, with its
        ``quota``, what it has ``taken`` and the folders ``out``; ``left``: folders
        and sizes of what no read has had, in order."""
        number, s = read_state(spark, f"{self.base}/state")
        return number, s or {"batch": -1, "read": -1, "quota": 0, "taken": 0, "out": [], "left": []}

    def _move(self, spark: SparkSession, number: int, s: dict, **change) -> None:
        create_state(spark, f"{self.base}/state", number + 1, {**s, **change})

    def _write(self, rows: DataFrame, folder: str) -> str:
        rows.select(*LOG_COLUMNS).write.mode("overwrite").parquet(f"{self.base}/{folder}")
        return folder

    def _folder(self, spark: SparkSession, folder: str) -> DataFrame:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{self.base}/{folder}")

    def _cut(self, spark: SparkSession, rows: DataFrame, n: int, name: str, read: int) -> tuple[str, str]:
        """Folders of the first ``n`` rows and of the others."""
        first = self._write(read_first_n(rows, self.topic, n), f"out/read={read}/{name}")
        ends = self._folder(spark, first).groupBy("partition").agg(F.max("offset").alias("_end"))  # one row per partition
        rest = rows.join(F.broadcast(ends), "partition", "left").where(
            F.col("offset") > F.coalesce(F.col("_end"), F.lit(-1)))
        return first, self._write(rest, f"left/{name}-after-{read}")

    # ---- the batch function ------------------------------------------------------

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        number, s = self.state(spark)
        if batch_id <= s["batch"]:
            return  # replayed after its version was made
        rows = batch.where(F.col("topic") == self.topic)
        n, room, name = rows.count(), s["quota"] - s["taken"], f"batch={batch_id}"
        out, left = list(s["out"]), list(s["left"])
        if n and room >= n:
            out.append(self._write(rows, f"out/read={s['read']}/{name}"))
        elif n and room > 0:
            first, rest = self._cut(spark, rows, room, name, s["read"])
            out.append(first)
            left.append([rest, n - room])
        elif n:
            left.append([self._write(rows, f"left/{name}"), n])
        self._move(spark, number, s, batch=batch_id, taken=s["taken"] + min(n, max(room, 0)), out=out, left=left)

    # ---- reads -------------------------------------------------------------------

    def _begin(self, spark: SparkSession, n: int) -> None:
        """Start the next read with what the one before left over."""
        number, s = self.state(spark)
        read, taken, out, left = s["read"] + 1, 0, [], list(s["left"])
        gone = []
        while left and taken < n:
            folder, size = left.pop(0)
            if size <= n - taken:
                out.append(folder)
                taken += size
            else:
                first, rest = self._cut(spark, self._folder(spark, folder), n - taken, f"from-{folder.split('/')[-1]}", read)
                out.append(first)
                left.insert(0, [rest, size - (n - taken)])
                gone.append(folder)
                taken = n
        self._move(spark, number, s, read=read, quota=n, taken=taken, out=out, left=left)
        for folder in gone:
            remove_folder(spark, f"{self.base}/{folder}")

    def read(self, stream: DataFrame, n: int, checkpoint: str, *, timeout: float | None = None,
             trigger: str = "200 milliseconds") -> DataFrame:
        """Exactly the next ``n`` messages, waiting for those that haven't come.

        After ``timeout`` seconds without them ``StillWaiting`` is raised; the
        same call again goes on with the same read.
        """
        spark = stream.sparkSession
        _, s = self.state(spark)
        if s["read"] < 0 or s["taken"] >= s["quota"]:
            self._begin(spark, n)
        elif s["quota"] != n:
            raise ValueError(f"read {s['read']} still waits for {s['quota']} messages, not {n}")
        _, s = self.state(spark)
        if s["taken"] < n:
            self._wait(spark, stream, checkpoint, timeout, trigger)
        _, s = self.state(spark)
        if s["taken"] < n:
            raise StillWaiting(f"{s['taken']} of {n} messages have arrived")
        return self.taken(spark)

    def _wait(self, spark: SparkSession, stream: DataFrame, checkpoint: str, timeout: float | None, trigger: str) -> None:
        query = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(
            processingTime=trigger).start()
        until = None if timeout is None else time.time() + timeout
        try:
            while until is None or time.time() < until:
                if query.exception() is not None or not query.isActive:
                    break
                _, s = self.state(spark)
                if s["taken"] >= s["quota"]:
                    break
                time.sleep(0.2)
        finally:
            error = query.exception()
            query.stop()
        if error is not None:
            raise error

    def taken(self, spark: SparkSession) -> DataFrame:
        """The messages of the current read, as many as it has."""
        _, s = self.state(spark)
        if not s["out"]:
            return small_table(spark, [], "topic string, partition int, offset bigint, key string, value string")
        return spark.read.schema(LOG_SCHEMA).parquet(*[f"{self.base}/{f}" for f in s["out"]])
