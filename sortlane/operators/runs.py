"""Sorted runs and their compaction.

A run is ``chunk`` consecutive input records (the last one may be short),
sorted on its own.  Runs are what a count-triggered producer emits; merging
them back into one total order is a compaction job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import run_length, sort_key_columns
from .order import with_position


def sorted_runs(df: DataFrame, key: str, chunk: int | None, input_order: Sequence[str],
                tiebreak: Sequence[str] = (), num_buckets: int | None = None) -> DataFrame:
    """``run_id = seq div chunk`` over the input order, then a sort per run.

    ``seq`` is the global input position (range-partitioned, no single task).
    The per-run sort is a window partitioned by ``run_id``: each group holds at
    most ``chunk`` rows, a bound set by the caller, not by the data volume.
    Adds ``seq``, ``run_id`` and ``pos`` (0-based rank inside the run).
    """
    size = run_length(chunk)
    order = sort_key_columns(key) + [c for c in (tiebreak or input_order) if c not in sort_key_columns(key)]
    seq = with_position(df, list(input_order), "seq", num_buckets)
    runs = seq.withColumn("run_id", F.floor(F.col("seq") / size).cast("bigint"))
    w = Window.partitionBy("run_id").orderBy(*order)
    return runs.withColumn("pos", (F.row_number().over(w) - 1).cast("bigint"))


def merge_runs(runs: DataFrame, key: str, tiebreak: Sequence[str],
               pos_col: str = "merged_pos", num_buckets: int | None = None) -> DataFrame:
    """E5: compact any set of sorted runs into one total order.

    The k-way heap merge of the original becomes a range repartition on the
    sort key; ``merge_runs(sorted_runs(x)) == sort(x)`` for every chunk size.
    """
    order = sort_key_columns(key) + [c for c in tiebreak if c not in sort_key_columns(key)]
    return with_position(runs, order, pos_col, num_buckets)
