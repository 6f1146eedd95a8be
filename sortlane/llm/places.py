"""A place of its own for each row, however many rows are equal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.operators.order import stage, with_position


def placed(rows: DataFrame, order: Sequence[str | Column], place_col: str = "_place") -> DataFrame:
    """Add the 0-based place of each row in ``order``.

    Rows equal in all of ``order`` have neighbouring places, dealt by a staged
    row number: the set of places they hold depends on the rows alone, so what
    is drawn by place agrees in reruns.  The row number also lets the range
    exchange cut through equal rows, so a third of all rows may be equal.
    """
    numbered = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    return with_position(numbered, [*order, "_row"], place_col).drop("_row")
