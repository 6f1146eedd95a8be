"""Shared parts of the trained text classifiers: fold, training sample, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortlane.operators.order import stage

#: Most labelled documents a model is fitted on, the smallest by hash of their id.
TRAIN_ROWS = 20_000
FOLDS = 5


def held_out(id_col: str | Column = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo 5, is 0 (a null id counts as empty text: held out)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
                    rows: int = TRAIN_ROWS, seed: int = 1) -> DataFrame:
    """``(doc_id, text, y)`` of at most ``rows`` labelled documents that aren't held out.

    Chosen by a hash of the id, so the same at every run.  A document labelled
    twice counts with its larger label, repeated rows count once.  Null labels
    and ids are left out.
    """
    marks = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("y"))
    marks = marks.where("_id is not null and y is not null").where(~held_out("_id")).groupBy("_id").agg(
        F.max("y").alias("y"))
    known = docs.select(F.col(id_col).cast("bigint").alias("_id"))
    ids = marks.join(known, "_id", "left_semi").orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(rows)
    ids = stage(ids, "sample-ids")
    text = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The ids are bounded by ``rows``.
    picked = text.join(F.broadcast(ids), F.col("doc_id") == F.col("_id")).groupBy("doc_id", "y").agg(
        F.max("text").alias("text"))
    return stage(picked.select("doc_id", "text", "y"), "sample")


def feature_rows(sample: DataFrame, features: Callable[[pa.Array], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(X, y, doc_id)`` of a bounded sample on the driver, in order of id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), flat], ["doc_id", "y", "x"])

    got = sample.select("doc_id", "text", "y").mapInArrow(run, "doc_id bigint, y int, x array<double>").toArrow()
    ids = got["doc_id"].to_numpy()
    x = got["x"].combine_chunks().values.to_numpy() if got.num_rows else np.zeros(0)
    x = x.reshape(got.num_rows, -1) if got.num_rows else np.zeros((0, 1))
    order = np.argsort(ids, kind="stable")
    return x[order], got["y"].to_numpy()[order].astype(float), ids[order]


def score_all(docs: DataFrame, id_col: str, text_col: str, score: Callable[[pa.Array], np.ndarray],
              threshold: float) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, in one narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch.column(1)), pa.float64())],
                                             ["doc_id", "score"])

    scored = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return scored.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_rows(docs: DataFrame, text_col: str, keep: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows whose text ``keep`` marks true, all columns as they are: one narrow pass."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(at)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner edges of up to ``bins`` quantile bins per feature."""
    q = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], q)) if len(x) else np.zeros(0) for j in range(x.shape[1])]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.int64)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(e, x[:, j], side="right")
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
