"""Search of a query set against all vectors: near vectors share a shard, and a
query meets only the shards whose bound reaches its k-th value.

Every row has a key of its own, so rows that share an id are different vectors
and different queries.  Of equal vectors only the ``k + 1`` of smallest id can
be among any query's best, so only they are candidates; equal queries are
searched once and each takes its own row out afterwards.  Both are exact.

Vectors are placed along a Z-order of stable projections, cut at quantiles of
all rows, and dealt into shards of ``SHARD_ROWS`` places: equal in size whatever
the ids, and near vectors together.  A query is searched in its own shard
first; its k-th value there is the bound that the others prune against.  Shards
are the leaves of a tree of summaries (balls or boxes, ``FAN_OUT`` children a
node), kept as tables: queries go down it level by level, only into nodes whose
bound reaches their k-th value.  So a shard's vectors are sent only to blocks
of queries that need them.  Every step is one Arrow group of at most one
node's children or one shard, and one block of ``BLOCK_QUERIES`` neighbouring queries.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sortlane.operators.order import stage, with_position

SHARD_ROWS = 4096
BLOCK_QUERIES = 4096
FAN_OUT = 64  # shards or nodes below a node
AXES = 8  # projections that the places follow
_CUTS = 15  # quantiles of each, so four bits
_LEAVES = 8  # leaves below an inner node of a shard's tree
_INF = float("inf")


class Index(Protocol):
    """What a search knows of distances.  Keys are numbers, smaller is better."""

    leaf: int  # rows of a leaf
    sub: int  # queries searched at a time

    def points(self, x: np.ndarray) -> np.ndarray:
        """Coordinates that trees are built on."""

    def summary(self, points: np.ndarray) -> np.ndarray:
        """A node that holds the points, as one row of numbers."""

    def merge(self, nodes: np.ndarray) -> np.ndarray:
        """A node that holds these nodes."""

    def aim(self, q: np.ndarray) -> np.ndarray:
        """What ``low`` needs of the queries, a row each."""

    def low(self, aim: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """``[queries, nodes]``: no vector in the node need be looked at for a smaller key."""

    def key(self, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """``[queries, vectors]``."""


def clean_vectors(table: DataFrame, id_col: str, vec_col: str, value: Callable[[Column], Column]) -> DataFrame:
    """``(vec_id, v)``: rows with an id, without null vectors and those holding
    null or non-finite components; ``value`` maps a component."""
    number = lambda x: x.cast("double")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(vec_col, number).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return rows.select("vec_id", F.transform("v", value).alias("v"))


def project(x: np.ndarray, dims: int, seed: int) -> np.ndarray:
    """Normal projections, summed in one order so that equal rows have equal ones."""
    g = np.random.Generator(np.random.PCG64(seed)).standard_normal((x.shape[1], dims))
    out = np.zeros((len(x), dims))
    for j in range(x.shape[1]):
        out += x[:, j:j + 1] * g[j]
    return out


def _matrix(t: pa.Table | pa.RecordBatch, col: str, dim: int) -> np.ndarray:
    """Rows as a matrix; shorter vectors are filled up with zeros."""
    lists = t[col].combine_chunks() if isinstance(t, pa.Table) else t[col]
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = np.diff(lists.offsets.to_numpy())
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((t.num_rows, dim))
    out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    return out


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())


def _z_order(p: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The bits of each coordinate's quantile, interleaved, highest first."""
    z = np.zeros(len(p), np.int64)
    cells = [np.searchsorted(cuts[i], p[:, i]) for i in range(p.shape[1])]
    for bit in reversed(range(_CUTS.bit_length())):
        for c in cells:
            z = z << 1 | (c >> bit & 1)
    return z


def deal(rows: DataFrame, k: int, dim: int) -> tuple[DataFrame, int]:
    """``(vec_id, row, v, copy, shard)`` and the number of shards: of equal
    vectors the ``k + 1`` of smallest id, near ones in the same shard."""
    # Spark limits the groups before the exchange too, so copies don't meet in one task.
    copy = F.row_number().over(Window.partitionBy("v").orderBy("vec_id", "row"))
    kept = stage(rows.withColumn("copy", copy).where(F.col("copy") <= k + 1), "kept")

    def projected(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([_lists(project(_matrix(b, "v", dim), AXES, 1))], ["p"])

    wanted = [(i + 1) / (_CUTS + 1) for i in range(_CUTS)]
    found = kept.select("v").mapInArrow(projected, "p array<double>").agg(
        F.count(F.lit(1)), *[F.percentile_approx(F.col("p")[i], wanted) for i in range(AXES)]).first()
    cuts = np.array(found[1:], float)

    def ordered(batches):
        for b in batches:
            z = _z_order(project(_matrix(b, "v", dim), AXES, 1), cuts)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(z)], [*b.schema.names, "z"])

    z = kept.select("vec_id", "row", "v", "copy").mapInArrow(ordered, "vec_id bigint, row bigint, v array<double>, copy int, z bigint")
    dealt = with_position(z, ["z", "vec_id", "row"], "place")
    shard = F.floor(F.col("place") / SHARD_ROWS).alias("shard")
    return dealt.select("vec_id", "row", "v", "copy", shard), -(-int(found[0]) // SHARD_ROWS)


def _levels(dealt: DataFrame, shards: int, dim: int, index: Index) -> list[DataFrame]:
    """Tables ``(node, parent, s)`` from the shards up to at most ``FAN_OUT`` nodes."""
    def shard(t):
        s = index.summary(index.points(_matrix(t, "v", dim)))
        return pa.table([t["node"].slice(0, 1), _lists(s[None])], ["node", "s"])

    def inner(t):
        s = index.merge(np.stack([np.array(v) for v in t["s"].to_pylist()]))
        return pa.table([t["parent"].slice(0, 1), _lists(s[None])], ["node", "s"])

    parent = F.floor(F.col("node") / FAN_OUT).alias("parent")
    schema = "node bigint, s array<double>"
    nodes = dealt.select(F.col("shard").alias("node"), "v").groupBy("node").applyInArrow(shard, schema)
    levels = [stage(nodes.select("node", parent, "s"), "nodes")]
    while shards > FAN_OUT:
        nodes = levels[-1].select("parent", "s").groupBy("parent").applyInArrow(inner, schema)
        levels.append(stage(nodes.select("node", parent, "s"), "nodes"))
        shards = -(-shards // FAN_OUT)
    return levels


def _meet(alive: DataFrame, queries: DataFrame, items: DataFrame, fn, schema: str) -> DataFrame:
    """Run ``fn(items of a node, a block's queries that reach the node)``; ``items``
    go only to blocks with such a query."""
    cells = alive.select(F.col("node").alias("at_node"), F.col("block").alias("at_block")).distinct()
    return items.join(cells, F.col("node") == F.col("at_node")).groupBy("at_node", "at_block").cogroup(
        alive.join(queries.drop("block"), "query").groupBy("node", "block")).applyInArrow(fn, schema)


def route(dealt: DataFrame, shards: int, queries: DataFrame, dim: int, index: Index) -> DataFrame:
    """``(query, block, node)``: the shards, other than its own, whose bound
    reaches the query's ``bound``."""
    def reach(left, right):
        names = ["query", "block", "node", "shard"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names)
        aim = index.aim(_matrix(right, "q", dim))
        low = index.low(aim, np.stack([np.array(v) for v in left["s"].to_pylist()]))
        qi, ni = np.nonzero(low <= right["bound"].to_numpy()[:, None])
        return pa.table([right["query"].take(qi), right["block"].take(qi), left["child"].take(ni), right["shard"].take(qi)], names)

    alive = queries.select("query", "block", F.lit(0).cast("bigint").alias("node"))
    levels = _levels(dealt, shards, dim, index)
    for i, level in reversed(list(enumerate(levels))):
        children = level.select(F.col("parent").alias("node"), F.col("node").alias("child"), "s")
        alive = _meet(alive, queries, children, reach, "query bigint, block bigint, node bigint, shard bigint")
        if not i:
            alive = alive.where(F.col("node") != F.col("shard"))
        alive = stage(alive.select("query", "block", "node"), "routes")
    return alive


def top_k(vectors: DataFrame, is_query: Column, k: int, index: Index, largest: bool) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query row its best ``k`` of the
    other rows by key (``score`` is its negative if ``largest``), ties to the smaller id."""
    # The key is fixed by writing it.
    rows = stage(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    dim, n_q = rows.agg(F.max(F.size("v")), F.count_if(is_query)).first()
    if not n_q:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                                    F.lit(0.0).alias("score"))
    dealt, shards = deal(rows, k, dim)
    distinct = rows.where(is_query).groupBy("v").agg(F.min("row").alias("query"))
    queries = dealt.where(F.col("copy") == 1).join(distinct, "v").select("query", F.col("v").alias("q"), "shard")
    queries = with_position(queries, ["shard", "query"], "place").select(
        "query", "q", "shard", F.floor(F.col("place") / BLOCK_QUERIES).alias("block"))
    schema = "query bigint, vec_id bigint, row bigint, key double"

    def cell(left, right):
        names = ["query", "vec_id", "row", "key"]
        if not left.num_rows or not right.num_rows:
            return pa.table([*[pa.array([], pa.int64())] * 3, pa.array([], pa.float64())], names)
        # Rows in order of id, so a cell's result doesn't depend on the exchange.
        left, right = left.sort_by([("vec_id", "ascending"), ("row", "ascending")]), right.sort_by("query")
        bound = right["bound"].to_numpy()
        qi, vi, key = tree_search(index, k + 1, _matrix(left, "v", dim), _matrix(right, "q", dim), bound)
        return pa.table([right["query"].take(qi), left["vec_id"].take(vi), left["row"].take(vi), pa.array(key)], names)

    items = dealt.select(F.col("shard").alias("node"), "vec_id", "row", "v")
    found = stage(items.groupBy("node").cogroup(
        queries.withColumn("bound", F.lit(_INF)).groupBy("shard")).applyInArrow(cell, schema), "found")
    if shards > 1:
        kth = found.groupBy("query").agg(F.when(F.count(F.lit(1)) > k, F.max("key")).otherwise(F.lit(_INF)).alias("bound"))
        bounded = stage(queries.join(kth, "query"), "queries")
        alive = route(dealt, shards, bounded, dim, index)
        found = found.unionByName(_meet(alive, bounded.drop("shard"), items, cell, schema))
    place = F.row_number().over(Window.partitionBy("query").orderBy("key", "vec_id", "row"))
    best = found.withColumn("place", place).where(F.col("place") <= k + 1)
    # Every row that asked takes the result of its vector, without its own row.
    asked = rows.where(is_query).select(F.col("row").alias("own"), F.col("vec_id").alias("query_id"), "v").join(distinct, "v")
    each = asked.drop("v").join(best, "query").where(F.col("row") != F.col("own"))
    rank = F.row_number().over(Window.partitionBy("own").orderBy("place"))
    score = -F.col("key") if largest else F.col("key")
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))


def tree_search(index: Index, k: int, x: np.ndarray, q: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, vector, key)``: each query's best ``k`` vectors with a key within its bound.

    Inner nodes are tested first; only below those that reach the bound are leaves.
    """
    points = index.points(x)
    leaves = [np.sort(rows) for rows in halves(points, index.leaf)]
    small = np.stack([index.summary(points[rows]) for rows in leaves])
    # Neighbouring leaves of the tree share an inner node.
    groups = [np.arange(i, min(i + _LEAVES, len(leaves))) for i in range(0, len(leaves), _LEAVES)]
    big = np.stack([index.merge(small[g]) for g in groups])
    out = ([], [], [])
    for lo in range(0, len(q), index.sub):
        part, first = q[lo:lo + index.sub], bounds[lo:lo + index.sub]
        aim, best = index.aim(part), Best(len(part), k, first)
        low = np.full((len(part), len(leaves)), _INF)
        for g, reached in zip(groups, (index.low(aim, big) <= first[:, None]).T):
            rows = np.flatnonzero(reached)
            if len(rows):
                low[np.ix_(rows, g)] = index.low(aim[rows], small[g])

        def visit(rows, leaf, best=best, part=part):
            best.add(rows, leaves[leaf], index.key(part[rows], x[leaves[leaf]]))

        best_first(leaves, low, best, lambda rows, b, best=best: (b <= best.bound[rows]) & np.isfinite(b), visit)
        qi, vi, key = best.result(first)
        for a, b in zip(out, (qi + lo, vi, key)):
            a.append(b)
    return tuple(np.concatenate(a) for a in out)


def halves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Leaves of a binary tree over the rows: each node is cut at the median of
    its widest coordinate until at most ``leaf`` rows are left."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        if len(rows) <= leaf:
            done.append(rows)
            continue
        p = points[rows]
        axis = int((p.max(axis=0) - p.min(axis=0)).argmax())
        order = np.argsort(p[:, axis], kind="stable")
        mid = len(rows) // 2
        open_ += [rows[order[:mid]], rows[order[mid:]]]
    return done


class Best:
    """The best ``k`` of each query so far, ties to the smaller index of the
    vector (rows come in order of id); smaller keys are better."""

    def __init__(self, queries: int, k: int, bound: np.ndarray):
        self.key = np.full((queries, k), np.inf)
        self.at = np.full((queries, k), -1, np.int64)
        self.bound = bound.astype(float).copy()

    def add(self, rows: np.ndarray, at: np.ndarray, key: np.ndarray) -> None:
        """Offer vectors ``at`` with ``key[len(rows), len(at)]`` to some queries."""
        useful = (key <= self.bound[rows, None]).any(axis=1)
        if not useful.any():
            return
        rows, key = rows[useful], key[useful]
        k = self.key.shape[1]
        keys = np.concatenate([self.key[rows], key], axis=1)
        ats = np.concatenate([self.at[rows], np.broadcast_to(at, key.shape)], axis=1)
        order = np.lexsort((ats, keys), axis=-1)[:, :k]
        self.key[rows] = np.take_along_axis(keys, order, 1)
        self.at[rows] = np.take_along_axis(ats, order, 1)
        self.bound[rows] = np.minimum(self.bound[rows], self.key[rows, k - 1])

    def result(self, first_bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, vector, key)`` of what may still be among the best overall."""
        good = np.isfinite(self.key) & (self.key <= first_bound[:, None])
        q, c = np.nonzero(good)
        return q, self.at[q, c], self.key[q, c]


def best_first(leaves: list[np.ndarray], low: np.ndarray, best: Best, may_hold, visit) -> None:
    """Visit each query's leaves in order of their lower bound ``low[query, leaf]``.

    ``may_hold(queries, low)`` says whether a leaf at that bound can still
    matter; the first that can't ends the query's walk, since all later ones
    lie higher.  ``visit(queries, leaf)`` offers a leaf's rows to ``best``.
    """
    order = np.argsort(low, axis=1, kind="stable")
    alive = np.arange(len(low))
    for j in range(len(leaves)):
        leaf = order[alive, j]
        alive_now = may_hold(alive, low[alive, leaf])
        alive, leaf = alive[alive_now], leaf[alive_now]
        if not len(alive):
            return
        by = np.argsort(leaf, kind="stable")
        cuts = np.flatnonzero(np.diff(leaf[by])) + 1
        for group in np.split(by, cuts):
            visit(alive[group], int(leaf[group[0]]))
