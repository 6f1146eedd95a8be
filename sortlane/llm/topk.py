"""Exact top-k by inner product: ball trees, branch and bound.

A node's ball (centre c, radius r) bounds the inner product of any vector in
it by ``q.c + |q| r``.  Balls of whole shards lead a query to the shards that
can reach its k-th score (see ``grid``).  Inside a shard, inner balls that can't
reach it are cut with all they hold, the leaves left are visited in order of
their bound, and the walk ends at the first leaf below the k-th score.  That
score starts from the query's own shard, and all others prune against it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import clean_vectors, top_k

K = 5
QUERY_EVERY = 50
SCALE = 256
LEAF = 64
_SUB = 512  # queries searched at a time in a task


class Balls:
    """Nodes are ``centre, radius``; the key is the negative inner product."""

    sub = _SUB

    def __init__(self, leaf: int):
        self.leaf = leaf

    def points(self, x):
        return x

    def summary(self, points):
        return self.merge(np.column_stack([points, np.zeros(len(points))]))

    def merge(self, nodes):
        centres, radii = nodes[:, :-1], nodes[:, -1]
        centre = (centres.max(axis=0) + centres.min(axis=0)) / 2
        return np.append(centre, (np.sqrt(((centres - centre) ** 2).sum(axis=1)) + radii).max())

    def aim(self, q):
        return np.column_stack([q, np.sqrt((q ** 2).sum(axis=1))])

    def low(self, aim, nodes):
        upper = aim[:, :-1] @ nodes[:, :-1].T + aim[:, -1:] * nodes[:, -1]
        # Covers rounding, also where the products cancel each other.
        size = np.abs(nodes[:, :-1]).sum(axis=1) + nodes[:, -1]
        return -(upper + 1e-9 * (1 + aim[:, -1:] * size))

    def key(self, q, x):
        return -(q @ x.T)  # integers: exact in double below 2^53


def exact_top_k(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = K,
                query_every: int = QUERY_EVERY, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query its ``k`` largest integer
    inner products (all, if fewer candidates), ties to the smaller vec_id.

    Components become ``floor(scale * x)``.  Queries are the rows whose id is
    divisible by ``query_every``; candidates are all rows but the query's own.

    Defined results: vectors that are null or hold null or non-finite
    components, and rows without an id, take no part; shorter vectors count as
    filled up with zeros; rows that share an id are queries and candidates of
    their own, and so are equal rows (a query's own row alone is left out); an empty table gives an empty result;
    other columns are ignored.
    """
    vectors = clean_vectors(table, id_col, vec_col, lambda x: F.floor(x * scale).cast("double"))
    out = top_k(vectors, F.col("vec_id") % query_every == 0, k, Balls(LEAF), largest=True)
    return out.withColumn("score", F.col("score").cast("bigint"))
