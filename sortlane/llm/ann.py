"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected to ``PROJECTIONS`` dimensions with a 2-stable (normal)
matrix: the squared projected distance over the squared true distance has a
chi-square law with that many degrees.  A kd-tree of the projections indexes
every vector: its upper levels are boxes of whole shards and of groups of them,
kept as tables (see ``grid``), its lower levels are built inside a shard.  A
query takes projected neighbours leaf by leaf, nearest box first, and verifies
each on the original vectors.  It passes over a box when the chi-square test
says that a vector within the current k-th distance would, with probability
``CONFIDENCE``, have been met by now.  There is no cap on how many are verified.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import clean_vectors, project, top_k

K = 10
QUERY_EVERY = 100
PROJECTIONS = 8  # even: the chi-square law then has a closed form
CONFIDENCE = 0.98
LEAF = 32
_SUB = 128


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """Distribution function of the chi-square law for an even number of degrees."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for j in range(1, degrees // 2):
        term = term * half / j
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(degrees: int, confidence: float) -> float:
    """The squared ratio of projected to true distance at which the test holds."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        if float(chi_square(np.array([mid]), degrees)[0]) < confidence:
            lo = mid
        else:
            hi = mid
    return hi


class Boxes:
    """Nodes are ``low corner, high corner`` of the projections; the key is the distance."""

    sub = _SUB

    def __init__(self, leaf: int, projections: int, confidence: float, seed: int):
        self.leaf, self.projections, self.seed = leaf, projections, seed
        self.ratio = stop_ratio(projections, confidence)

    def points(self, x):
        return project(x, self.projections, self.seed)

    def summary(self, points):
        return np.concatenate([points.min(axis=0), points.max(axis=0)])

    def merge(self, nodes):
        p = self.projections
        return np.concatenate([nodes[:, :p].min(axis=0), nodes[:, p:].max(axis=0)])

    def aim(self, q):
        return project(q, self.projections, self.seed)

    def low(self, aim, nodes):
        """The k-th distance at which the chi-square stopping test holds for the box."""
        p = self.projections
        gap = np.maximum(np.maximum(nodes[None, :, :p] - aim[:, None], aim[:, None] - nodes[None, :, p:]), 0)
        return np.sqrt((gap ** 2).sum(axis=2) / self.ratio)

    def key(self, q, x):
        diff = q[:, None, :] - x[None, :, :]
        return np.sqrt((diff * diff).sum(axis=2))


def nearest(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = K,
            query_every: int = QUERY_EVERY, projections: int = PROJECTIONS, confidence: float = CONFIDENCE,
            seed: int = 9) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query the ``k`` nearest found
    (all candidates, if fewer), nearest first, ties to the smaller vec_id;
    ``score`` is the Euclidean distance in double precision.

    Queries are the rows whose id is divisible by ``query_every``; candidates
    are all rows but the query's own.

    Defined results: vectors that are null, zero or hold null or non-finite
    components, and rows without an id, take no part; shorter vectors count as
    filled up with zeros; rows that share an id are queries and candidates of
    their own, and so are equal rows (a query's own row alone is left out); an empty table gives an empty result;
    other columns are ignored.
    """
    vectors = clean_vectors(table, id_col, vec_col, lambda x: x).where(F.exists("v", lambda x: x != 0))
    return top_k(vectors, F.col("vec_id") % query_every == 0, k, Boxes(LEAF, projections, confidence, seed), largest=False)
