"""Feed a log table to a file-based stream as ordered arrivals (test/bench input).

Arrival ``k`` holds the messages whose offset lies in ``[cuts[k], cuts[k+1])``
(offsets of a partition strictly increase across arrivals).  One partition can
be held back for one arrival (``silent=(partition, arrival)``): its messages
move to the next arrival, so that batch sees the partition silent.  Each
arrival is ``FILES`` parquet files appended to the source folder by its own
write, so files get increasing modification times and ``maxFilesPerTrigger=FILES``
turns each arrival into one micro-batch.  Files are cut into row groups of
``ROW_GROUP`` bytes, so that a batch of few files is still read by many tasks.
With a broker this module is not needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LOG_COLUMNS

FILES = 2
ROW_GROUP = 4 << 20


def arrival_of(offset: Column, cuts: Sequence[int], partition: Column | None = None,
               silent: tuple[int, int] | None = None) -> Column:
    """Index of the arrival holding a message (cut points are literals)."""
    idx = F.lit(0)
    for c in cuts[1:-1]:
        idx = idx + F.when(offset >= F.lit(c), 1).otherwise(0)
    if silent is not None and partition is not None:
        p, k = silent
        idx = F.when((partition == p) & (idx == k), F.lit(k + 1)).otherwise(idx)
    return idx


def quantile_cuts(log: DataFrame, arrivals: int) -> list[int]:
    """Equal-width offset cuts over the log's offset range (one aggregate row)."""
    hi = log.agg(F.max("offset")).first()[0]
    hi = -1 if hi is None else int(hi)
    return [((hi + 1) * k) // arrivals for k in range(arrivals)] + [hi + 1]


def write_arrivals(log: DataFrame, source_dir: str, cuts: Sequence[int],
                   silent: tuple[int, int] | None = None, first: int = 0,
                   last: int | None = None, files: int = FILES) -> int:
    """Append arrivals ``first..last`` (inclusive) as ``files`` files each; returns the count."""
    tagged = log.select(*LOG_COLUMNS).withColumn(
        "_arrival", arrival_of(F.col("offset"), cuts, F.col("partition"), silent))
    n = len(cuts) - 1
    last = n - 1 if last is None else min(last, n - 1)
    written = 0
    for k in range(first, last + 1):
        part = tagged.where(F.col("_arrival") == k).drop("_arrival")
        part.repartition(files).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(source_dir)
        written += 1
    return written
