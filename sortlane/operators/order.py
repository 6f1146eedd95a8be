"""Total orders with a global position column.

The published order is made a column (``pos``, 0-based) so that an
order-insensitive consumer can still verify it.  ``row_number()`` over an
unpartitioned window would pull every row into one task, so the position is
built from a range partitioning instead:

1. ``repartitionByRange(B, keys)`` + ``sortWithinPartitions(keys)``: Spark
   samples cut points, each of the B tasks receives one contiguous key range
   and sorts it (external sort, spills as needed).
2. ``monotonically_increasing_id()`` on that sorted output encodes
   (task index, row index in task) = (bucket, rank inside bucket).  The rows
   are written once as a staged parquet table, which fixes the sampled cut
   points: a re-evaluation could otherwise pick other bounds.
3. One row per bucket is counted from the staged ``_mid`` column alone; the
   B-row count table is prefix-summed and broadcast back (B is the bucket
   count chosen here, not a function of the data volume).

The sort key always ends in a unique tie-break, so range cuts can split a hot
key value (one continent holding a third of the rows still spreads over many
buckets) and the order is total.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schema import SORT_KEYS, sort_key_columns
from ..session import work_path

_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def stage(df: DataFrame, name: str = "stage", observation: Observation | None = None,
          folders: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared work folder and read it back.

    Cuts lineage (retries re-read the table instead of re-running upstream
    shuffles) and freezes nondeterministic columns such as sampled buckets.
    ``observation`` (optional) receives ``rows``, counted during the write.
    ``folders`` (optional) gets the path, for the caller to remove when done.
    """
    path = work_path(df.sparkSession, name)
    if folders is not None:
        folders.append(path)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def number_staged(staged: DataFrame, pos_col: str = "pos",
                  total_col: str | None = None) -> DataFrame:
    """Turn a staged ``_mid`` column into a dense 0-based position.

    ``_mid`` must come from ``monotonically_increasing_id()`` evaluated on the
    partitions whose concatenation is the wanted order.  The per-bucket counts
    are read from the ``_mid`` column alone; their prefix sums are taken over
    that B-row table (B = the bucket count chosen by the caller, not a
    function of the data volume) and broadcast back.
    """
    tagged = staged.withColumn("_bucket", F.shiftright("_mid", _ROW_BITS))
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # Windows over the B-row count table only (one row per bucket).
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint").alias("_base"),
        *([F.sum("_n").over(Window.partitionBy()).cast("bigint").alias(total_col)] if total_col else []),
    )
    out = tagged.join(F.broadcast(bases), "_bucket").withColumn(
        pos_col, (F.col("_base") + F.col("_mid").bitwiseAND(F.lit(_ROW_MASK))).cast("bigint"))
    return out.drop("_bucket", "_base", "_mid")


def with_position(df: DataFrame, order: Sequence[str | Column], pos_col: str = "pos",
                  num_buckets: int | None = None, total_col: str | None = None,
                  observation: Observation | None = None, folders: list[str] | None = None) -> DataFrame:
    """Add the 0-based rank of each row in ``order`` (which must be total).

    Without ``num_buckets`` the range exchange uses ``spark.sql.shuffle.partitions``
    cut points and AQE may merge *adjacent* small ranges (it never splits or
    reorders them), so a small input does not leave thousands of near-empty
    buckets while a large one keeps every bucket near the advisory size.  At
    scale give ``num_buckets`` so that a bucket's rows fit a task's sort memory.
    """
    keys = _cols(order)
    ranged = df.repartitionByRange(num_buckets, *keys) if num_buckets else df.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    return number_staged(stage(ordered, "pos", observation, folders), pos_col, total_col)


def with_index(df: DataFrame, pos_col: str = "idx", total_col: str | None = None) -> DataFrame:
    """Dense 0-based index in the input's existing partition order (no shuffle)."""
    staged = stage(df.withColumn("_mid", F.monotonically_increasing_id()), "idx")
    return number_staged(staged, pos_col, total_col)


def sort_records(df: DataFrame, key: str, tiebreak: Sequence[str] = ("rid",),
                 pos_col: str = "pos", num_buckets: int | None = None,
                 total_col: str | None = None,
                 observation: Observation | None = None, folders: list[str] | None = None) -> DataFrame:
    """Order records by a named key plus a total tie-break, with ``pos``."""
    order = sort_key_columns(key) + [c for c in tiebreak if c not in SORT_KEYS[key]]
    return with_position(df, order, pos_col, num_buckets, total_col, observation, folders)


def sort_by_id(df: DataFrame, tiebreak: Sequence[str] = ("rid",)) -> DataFrame:
    return sort_records(df, "id", tiebreak)


def sort_by_name(df: DataFrame, tiebreak: Sequence[str] = ("rid",)) -> DataFrame:
    return sort_records(df, "name", tiebreak)


def sort_by_continent(df: DataFrame, tiebreak: Sequence[str] = ("rid",)) -> DataFrame:
    return sort_records(df, "continent", tiebreak)


def sort_fanout(df: DataFrame, tiebreak: Sequence[str] = ("rid",),
                keys: Sequence[str] = ("id", "name", "continent"),
                total_col: str | None = None, num_buckets: int | None = None) -> DataFrame:
    """One staged input, three orderings, tagged with ``sort_key``.

    The input should already be staged (``stage`` / K4) so the three sorts
    read it instead of recomputing it.  The orderings are independent jobs,
    submitted together so the scheduler can overlap their stages.
    """
    with ThreadPoolExecutor(max_workers=len(keys)) as pool:
        parts = list(pool.map(
            lambda k: sort_records(df, k, tiebreak, num_buckets=num_buckets, total_col=total_col).withColumn("sort_key", F.lit(k)),
            keys))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
