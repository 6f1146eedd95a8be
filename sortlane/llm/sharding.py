"""Uniform shuffle into shards of exact sizes, by a hypergeometric matrix.

Rows are cut into blocks by hash.  A multivariate hypergeometric draw gives,
per block, how many of its rows go to each shard; row sums are the block
counts and column sums the exact shard sizes, so the matrix has the law of a
uniform shuffle.  Each block permutes its rows locally (a random order) and
deals them by its row of the matrix; after the exchange each shard permutes
again: a second random key orders its rows, cut into pieces by that key so
that no task holds a whole shard, and a row's slot is its piece's start plus
its rank there.

Both keys are hashes of the row's place in key order and the seed: reruns and
recomputed tasks agree, and equal rows spread like any others.  The driver holds one row of counts per block, about the square root of
the number of rows, never one per document.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortlane.operators.order import stage

from .places import placed

SHARDS = 24


def shard_sizes(total: int, shards: int) -> np.ndarray:
    """``shards`` counts at most one apart that add up to ``total``."""
    return np.full(shards, total // shards, np.int64) + (np.arange(shards) < total % shards)


def communication_matrix(blocks: Sequence[int], sizes: Sequence[int], seed: int) -> np.ndarray:
    """Counts ``[block, shard]`` of a uniform shuffle with these margins."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(sizes, np.int64)
    out = np.zeros((len(blocks), len(left)), np.int64)
    for i, n in enumerate(blocks):
        out[i] = rng.multivariate_hypergeometric(left, int(n), method="marginals")
        left -= out[i]
    return out


def uniform_shards(rows: DataFrame, key_cols: Sequence[str], shards: int = SHARDS, seed: int = 17) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 per shard).

    All columns are carried along.  ``key_cols`` should tell rows apart: rows
    equal in all of them are interchangeable, and are dealt one by one, by
    their place in key order.  Shard sizes are at most one apart.  An empty
    table gives an empty result; null keys are allowed.
    """
    spark = rows.sparkSession
    rows = placed(rows, key_cols, "_n")
    total = rows.count()
    # About sqrt(total) blocks of sqrt(total) rows: both the matrix on the
    # driver and a task's block stay small at any size.
    n_blocks = max(1, math.isqrt(total))
    keyed = rows.withColumn("_h", F.xxhash64("_n", F.lit(seed))).withColumn(
        "_block", F.pmod("_h", F.lit(n_blocks)))
    counts = {r[0]: r[1] for r in keyed.groupBy("_block").count().collect()}  # one row per block
    matrix = communication_matrix([counts.get(b, 0) for b in range(n_blocks)], shard_sizes(total, shards), seed)
    deal = spark.createDataFrame(pa.table({
        "_block": pa.array(range(n_blocks), pa.int64()),
        "_ends": pa.array(list(np.cumsum(matrix, axis=1)), pa.list_(pa.int64()))}))
    # Local permutation, then the block's row of the matrix.
    local = keyed.withColumn("_r", F.row_number().over(Window.partitionBy("_block").orderBy("_h", "_n")) - 1)
    # First shard whose cumulative count exceeds the rank.
    sent = local.join(deal, "_block").withColumn(
        "shard", F.expr("size(filter(_ends, e -> e <= _r))")).drop("_ends", "_r", "_h", "_block")
    # Exchange and permute again: a fresh key orders a shard's rows, and equal slices of its range bound a task's rows.
    pieces = max(1, math.isqrt(total // shards))
    sent = stage(sent.withColumn("_k", F.xxhash64("_n", F.lit(seed + 1))).withColumn(
        "_piece", F.pmod(F.xxhash64("_k"), F.lit(pieces))), "exchange")
    before = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sent.groupBy(F.col("shard").alias("_s"), F.col("_piece").alias("_p")).count().select(
        "_s", "_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    ranked = sent.withColumn("_r", F.row_number().over(
        Window.partitionBy("shard", "_piece").orderBy("_k", "_n")) - 1)
    return ranked.join(starts, (F.col("shard") == F.col("_s")) & (F.col("_piece") == F.col("_p"))).withColumn(
        "slot", (F.col("_start") + F.col("_r")).cast("bigint")).drop("_start", "_r", "_k", "_n", "_piece", "_s", "_p")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32)``: UTF-8 bytes plus 8, unsigned CRC-32; a
    null text counts as no bytes (size 8, CRC 0)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       (F.octet_length(text) + 8).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                    seed: int = 17) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` under the
    law ``rows``: shard counts are at most one apart and every shuffle is
    equally likely, so copies are not kept together.

    Defined results: a null text counts as empty, a null id is a key like any
    other; repeated rows, be they a third of the table, and rows whose keys tie
    get slots of their own; of a very long text only its size and CRC move; an
    empty table gives an empty result; other columns are ignored.
    """
    out = uniform_shards(digest(docs, id_col, text_col), ["doc_id", "size", "text_crc32"], shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"),
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                 seed: int = 17) -> None:
    """Write whole documents as one folder per shard, rows in slot order within files."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn("_crc", F.crc32(text))
    out = uniform_shards(keyed, [id_col, "_crc"], shards, seed).drop("_crc")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy(
        "shard").parquet(path)
