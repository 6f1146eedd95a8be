"""Reproducible synthetic records under the record contract.

Every field is a pure function of ``(seed, rid)`` built from ``md5`` digests,
so the output does not depend on partitioning, task retries or executor
count, and the same recipe runs in any SQL engine with ``md5``/``base64``.

Per row, four digests are taken of ``"<seed>:<rid>:a|b|c|d"``:

* name: base64 of digests ``a`` and ``d`` lower-cased, everything but letters
  removed (so all 26 are equally likely), first ``10 + c[4] % 6`` characters;
* address: base64 of digests ``b`` and ``d`` with ``+`` -> space and ``/``
  removed (letters, digits, space, equally likely), first ``15 + c[5] % 6``;
* continent: ``c[6] % 6``; id: bytes 8-11 of ``c`` modulo 2^31.

``c[i]`` is byte ``i`` (hex pair ``i``) of digest ``c``.  Of 43 base64
characters fewer than 15 letters come up once in about 10^13 rows; such a
name is filled up with ``a``.  All of it is a handful of string built-ins per
row, inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ADDRESS_LEN, CONTINENTS, NAME_LEN

# What is removed or replaced in base64 text: the second string is shorter, so the rest goes.
NAME_FROM, NAME_TO = "0123456789+/=", ""
ADDRESS_FROM, ADDRESS_TO = "+/=", " "


def generate_for(ids: DataFrame, seed: int = 42, rid: str = "rid") -> DataFrame:
    """Records for the row ids of ``ids`` (one output row per input row)."""
    prefix = F.concat(F.lit(f"{seed}:"), F.col(rid).cast("string"), F.lit(":"))
    digests = ids.select(F.col(rid).cast("bigint").alias("rid")).select(
        "rid",
        F.md5(F.concat(prefix, F.lit("a"))).alias("_ha"),
        F.md5(F.concat(prefix, F.lit("b"))).alias("_hb"),
        F.md5(F.concat(prefix, F.lit("c"))).alias("_hc"),
        F.md5(F.concat(prefix, F.lit("d"))).alias("_hd"),
    )
    c456 = F.conv(F.substring("_hc", 9, 6), 16, 10).cast("int")  # bytes 4, 5, 6 of digest c
    name_len = NAME_LEN[0] + F.shiftright(c456, 16) % (NAME_LEN[1] - NAME_LEN[0] + 1)
    addr_len = ADDRESS_LEN[0] + F.shiftright(c456, 8).bitwiseAND(255) % (ADDRESS_LEN[1] - ADDRESS_LEN[0] + 1)
    text = lambda h: F.base64(F.unhex(F.concat(h, F.col("_hd"))))
    letters = F.rpad(F.translate(F.lower(text(F.col("_ha"))), NAME_FROM, NAME_TO), 43, "a")
    symbols = F.translate(text(F.col("_hb")), ADDRESS_FROM, ADDRESS_TO)
    continents = F.array(*[F.lit(c) for c in CONTINENTS])
    return digests.select(
        "rid",
        (F.conv(F.substring("_hc", 17, 8), 16, 10).cast("bigint") % 2147483648).cast("int").alias("id"),
        F.substr(letters, F.lit(1), name_len).alias("name"),
        F.substr(symbols, F.lit(1), addr_len).alias("address"),
        F.element_at(continents, (c456.bitwiseAND(255) % 6 + 1)).alias("continent"),
    )


def generate_records(spark: SparkSession, n: int, seed: int = 42,
                     num_partitions: int | None = None) -> DataFrame:
    """``n`` records with ``rid`` 0..n-1; content independent of ``num_partitions``."""
    ids = spark.range(0, n, 1, num_partitions).withColumnRenamed("id", "rid")
    return generate_for(ids, seed)
