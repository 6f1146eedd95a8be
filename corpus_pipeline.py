"""Corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

quality classifier -> toxicity -> near-duplicates -> source mix -> packing.
Every stage but the last returns the columns of documents; ``run`` applies
them in order, each written as Parquet and read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sortlane.llm import dedup, mixing, packing, quality, toxicity
from sortlane.llm.classify import keep_rows
from sortlane.operators.order import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = "_row_key"
#: Near-duplicates of the stage: similarity of 0.8 or more (op1's query has 0.85).
NEAR_PERCENT = 80


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts 1 stay."""
    docs = docs.select(COLUMNS)
    return keep_rows(docs, "text", quality.keeper(quality.train(docs, _labels(spark, sf_dir))))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier predicts 1 go."""
    docs = docs.select(COLUMNS)
    return keep_rows(docs, "text", toxicity.keeper(toxicity.train(docs, _labels(spark, sf_dir))))


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a unique key of each row, staged so that it stays."""
    return stage(docs.select(COLUMNS).withColumn(KEY, F.monotonically_increasing_id()), "keyed")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, the one of smallest id.

    Rows without an id take part and come last, so they stay only in groups
    without any id.  Rows that share an id are separate documents; of equal
    ids in a group one stays, by a digest of the row.  Texts without words are
    linked with nothing; such rows are copies if both id and text are equal.
    """
    rows = _keyed(docs)
    groups = dedup.near_duplicates(rows, KEY, percent=NEAR_PERCENT).select(F.col("doc_id").alias(KEY), "n_shingles", "component_id")
    bare = F.col("n_shingles") == 0
    named = rows.select(KEY, "doc_id", F.md5("text").alias("_text"), F.xxhash64("text", "source", "lang", "n_chars").alias("_tie"))
    # The smallest id of a group, nulls last; combined map-side.
    first = groups.join(named, KEY).groupBy(
        F.when(~bare, F.col("component_id")), F.when(bare, F.col("doc_id")), F.when(bare, F.col("_text"))).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_tie", KEY))[KEY].alias(KEY))
    return rows.join(first.select(KEY), KEY, "left_semi").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: 0, 1 or 2 times, whatever rows share its id."""
    rows = _keyed(docs)
    taken = mixing.mix_sources(rows, row_col=KEY).where("copies > 0").select(KEY, F.col("copies").alias("_copies"))
    return rows.join(taken, KEY).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a bin."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: Trained classifiers decide what stays, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
