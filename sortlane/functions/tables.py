"""Small literal tables built inside the JVM (SQL ``VALUES``), not via Python RDDs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L" if not -2**31 <= v < 2**31 else str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"unsupported literal {v!r}")


def small_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A ``LocalRelation`` with ``schema`` (``"name type, ..."``) holding ``rows``.

    For tables whose size is bounded by configuration (log partitions, sort
    keys, required topics); large data never goes through here.
    """
    cols = [c.strip().split()[0] for c in schema.split(",")]
    types = [" ".join(c.strip().split()[1:]) for c in schema.split(",")]
    rows = list(rows)
    if not rows:
        return spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    select = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in zip(cols, types))
    return spark.sql(f"SELECT {select} FROM VALUES {values} AS t({', '.join(cols)})")
