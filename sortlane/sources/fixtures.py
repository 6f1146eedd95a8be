"""Test inputs derived from the driver's tables (see FIXTURES.md §2).

* ``records``   F1 - record rows with heavy key ties, ``rid`` unique.
* ``log``       F2 - a 4-partition ``source`` topic with dense offsets.
* ``dirty_log`` F3 - F2 with planted malformed lines.

Everything is a lazy DataFrame over the parquet tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CONTINENTS, LOG_PARTITIONS, SOURCE_TOPIC


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rid, id, name, address, continent`` from orders x customer x nation x region.

    nation (25 rows) and region (5 rows) are fixed-size dimension tables, so
    broadcasting them is bounded; customer is joined by a regular shuffle join
    (AQE may still switch it to broadcast from runtime sizes).
    """
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_orderkey").alias("rid"),
            F.col("o_custkey").cast("int").alias("id"),
            F.col("o_orderpriority").alias("name"),
            F.col("c_mktsegment").alias("address"),
            F.col("r_name").alias("continent"),
        )
    )


def _continent_of(user_id: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CONTINENTS]), F.pmod(user_id, F.lit(6)).cast("int") + 1)


def _log_frame(events: DataFrame, value: Column) -> DataFrame:
    return events.select(
        F.lit(SOURCE_TOPIC).alias("topic"),
        F.pmod(F.col("event_id"), F.lit(LOG_PARTITIONS)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / LOG_PARTITIONS).cast("bigint").alias("offset"),
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
    )


def _clean_value() -> Column:
    return F.concat(
        F.col("user_id").cast("string"), F.lit(","), F.col("event_type"), F.lit(","),
        F.col("props"), F.lit(","), _continent_of(F.col("user_id")),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``topic, partition, offset, key, value`` over events (all lines valid)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    return _log_frame(events, _clean_value())


def dirty_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with malformed lines planted at fixed event ids (first match wins)."""
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "props")
    e, u = F.col("event_id"), F.col("user_id")
    cont = _continent_of(u)
    et, props = F.col("event_type"), F.col("props")
    value = (
        F.when(e % 97 == 0, F.concat(u.cast("string"), F.lit(","), et, F.lit(","), props))
        .when(e % 89 == 0, F.concat(F.lit("x"), u.cast("string"), F.lit(","), et, F.lit(","), props, F.lit(","), cont))
        .when(e % 83 == 0, F.concat((u + F.lit(2147483648)).cast("string"), F.lit(","), et, F.lit(","), props, F.lit(","), cont))
        .when(e % 79 == 0, F.lit(""))
        .when(e % 73 == 0, F.concat(F.lit("  "), u.cast("string"), F.lit("abc,"), et, F.lit(", "), props, F.lit(" ,"), cont, F.lit(" ")))
        .when(e % 71 == 0, F.concat(F.lit("99999999999999999999,"), et, F.lit(","), props, F.lit(","), cont))
        .when(e % 67 == 0, F.concat(u.cast("string"), F.lit("_000,"), et, F.lit(","), props, F.lit(","), cont))
        .otherwise(_clean_value())
    )
    return _log_frame(events, value)
