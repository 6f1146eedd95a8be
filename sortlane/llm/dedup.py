"""Near-duplicate groups with an LSH forest of MinHash signatures.

Documents that have the same shingle set are one node (grouped by a 128-bit
key with map-side combine, so thousands of copies cost one row per task).
Each node has ``TREES`` sequences of ``LEVELS`` min-hashes.  Per tree the
nodes are sorted by their sequence with a range exchange; in that order the
neighbour with the longest common prefix is a node's candidate.  Runs of nodes
with a common prefix are regions, of a depth that adapts to their size.

Candidates are confirmed on the full shingle sets: a few neighbours of each
node, and each node against its regions' pivots (the best connected member),
a fixed number of pairs per node.  That joins up most groups.  Members of a
pivot's group that are still apart are compared by their differences from the
pivot, which finds every remaining link without pairing the group (see
``_across``).

Two sets at similarity 0.85 share a prefix of 5 levels in some of 32 trees
except with probability 8e-9, and one of 8 levels except with 4e-5.  At 0.8 it
is 3e-6 for 5 levels, 6e-5 for 6 and 3e-3 for 8, so the deepest regions have
the most levels, up to 8, that keep it at or below ``MISS``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sortlane.operators.order import stage

from .graph import components
from .text import Hasher, ascii_lower, chunks, separators, shingles, words

SHINGLE = 5
TREES = 32
LEVELS = 8
BASE_DEPTH = 5
REGION_ROWS = 1024
#: The deepest regions may part two sets at the threshold, in all trees, with this probability.
MISS = 1e-4
#: Neighbours of a node that are confirmed: those of longest common prefixes, and any.
BEST_LINKS = 2
RANDOM_LINKS = 3
_BYTES = 2 * LEVELS  # a level is kept as 16 bits


def _sets(text: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of each document."""
    hasher, lower, sep = Hasher(), ascii_lower(), separators()
    for lo, hi, data, offs in chunks(text):
        w = words(data, offs, sep)
        hasher.load(data, lower)
        h, doc = shingles(hasher.ranges(w.start, w.end), w, size)
        order = np.lexsort((h, doc)) if len(h) else np.zeros(0, np.int64)
        h, doc = h[order], doc[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        ends = np.searchsorted(doc, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            yield lo + i, h[ends[i]:ends[i + 1]]


def _set_key(s: np.ndarray) -> bytes | None:
    return hashlib.md5(s.tobytes(), usedforsecurity=False).digest() if len(s) else None


def _signer(seed: int):
    """Signature function: TREES * LEVELS min-hashes of 16 bits each."""
    rng = np.random.Generator(np.random.PCG64(seed))
    n = TREES * LEVELS
    a = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, n, dtype=np.uint32)

    def sign(s: np.ndarray) -> bytes:
        x = (s >> np.uint64(32)).astype(np.uint32)
        low = np.full(n, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), 512):
            np.minimum(low, (x[at:at + 512, None] * a + b).min(axis=0), out=low)
        return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2").tobytes()

    return sign


def features(docs: DataFrame, id_col: str, text_col: str, size: int, seed: int) -> DataFrame:
    """``(doc_id, n_shingles, node, sig)``; node and sig are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = _signer(seed)
        for batch in batches:
            n, node, sig = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows, [None] * batch.num_rows
            for i, s in _sets(batch.column(1), size):
                n[i] = len(s)
                if len(s):
                    node[i], sig[i] = _set_key(s), sign(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(node, pa.binary()), pa.array(sig, pa.binary())],
                ["doc_id", "n_shingles", "node", "sig"])

    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, n_shingles bigint, node binary, sig binary")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest-common-prefix neighbour of each row of a sorted partition.

    Rows without a neighbour at ``BASE_DEPTH`` are alone in their region and
    go.  The neighbours of a partition's first and last row may lie in other
    partitions; those two rows always stay.
    """
    names, kinds = ["tree", "sig", "node", "n"], [pa.int32(), pa.binary(), pa.binary(), pa.int64()]

    def shared(t: pa.Table) -> np.ndarray:
        """Levels that each row shares with the next."""
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), ">u2").reshape(-1, LEVELS)
        tree = t["tree"].to_numpy()
        return np.logical_and.accumulate((sig[1:] == sig[:-1]) & (tree[1:] == tree[:-1])[:, None], axis=1).sum(axis=1)

    held: pa.Table | None = None
    left = LEVELS  # shared levels of the held row with the one before it; unknown counts as all
    before: bytes | None = None

    def out(rows: pa.Table, prev: np.ndarray, nxt: np.ndarray, mates_prev: list, mates_next: list):
        keep = np.flatnonzero(np.maximum(prev, nxt) >= BASE_DEPTH)
        mates, lcps = [], []
        for i in keep:
            # A neighbour in another partition isn't known.
            p = prev[i] if mates_prev[i] is not None else 0
            q = nxt[i] if mates_next[i] is not None else 0
            best = max(p, q)
            mates.append(None if best < BASE_DEPTH else mates_prev[i] if p >= q else mates_next[i])
            lcps.append(best)
        got = [rows[c].combine_chunks().take(pa.array(keep)).cast(k) for c, k in zip(names, kinds)]
        return pa.RecordBatch.from_arrays(
            [*got, pa.array(mates, pa.binary()), pa.array(lcps, pa.int32())], [*names, "mate", "lcp"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([held, t]) if held is not None else t
        if t.num_rows < 2:
            held = t
            continue
        same = shared(t)
        nodes = t["node"].to_pylist()
        m = t.num_rows - 1
        prev = np.concatenate([[left], same[:-1]])
        yield out(t.slice(0, m), prev, same, [before, *nodes[:m - 1]], nodes[1:])
        left, before, held = int(same[-1]), nodes[m - 1], t.slice(m)
    if held is not None:
        yield out(held, np.array([left]), np.array([LEVELS]), [before], [None])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.where(100 * common.cast("bigint") >= percent * union.cast("bigint")).select("a", "b")


def deepest(percent: int) -> int:
    """Levels of the deepest regions."""
    return max((d for d in range(BASE_DEPTH, LEVELS + 1) if (1 - (percent / 100) ** d) ** TREES <= MISS), default=BASE_DEPTH)


def _regions(forest: DataFrame, most: int) -> DataFrame:
    """``(tree, region, node, members)``: the region of each row, of adaptive depth.

    A region is a common prefix of ``BASE_DEPTH`` levels; while it has more
    than ``REGION_ROWS`` members it is cut one level deeper, down to ``most``.
    """
    rows, at = forest.select("tree", "sig", "node"), F.lit(most)
    depths = range(BASE_DEPTH, most + 1)
    prefix = lambda depth: F.expr(f"substring(sig, 1, {2 * depth})")
    for d in depths:
        sizes = forest.groupBy("tree", prefix(d).alias(f"r{d}")).agg(F.count(F.lit(1)).alias(f"n{d}"))
        rows = rows.withColumn(f"r{d}", prefix(d)).join(sizes, ["tree", f"r{d}"])
    for d in reversed(depths[:-1]):
        at = F.when(F.col(f"n{d}") <= REGION_ROWS, d).otherwise(at)
    pick = lambda c: F.coalesce(*[F.when(at == d, F.col(f"{c}{d}")) for d in depths])
    return rows.select("tree", pick("r").alias("region"), "node", pick("n").alias("members"))


def _across(stars: DataFrame, near: DataFrame, sets: DataFrame, percent: int, held: list[DataFrame]) -> DataFrame:
    """Pairs ``(a, b)`` of different groups around one pivot that may be linked: all that are, and few others.

    A member x is written as its difference D(x) from the pivot p: the shingles
    it adds and those it lacks, those rarest in the group first.  Linked x and
    y differ in at most K = c (|x| + |y|) shingles, c = (100 - percent) / (100 +
    percent).  If D(x) and D(y) share nothing, both are linked to p.  Otherwise
    the first shared element stands at places i and j with i + j <= K, since
    all before it are differences.  So only the first K + 1 elements are
    indexed, and one side only up to K / 2.  Members of one group don't meet,
    and shared edits are rare, so the pairs stay few however large the group.
    ``held`` gets the cached tables.
    """
    group = stars.select("pivot", "node").join(near, "node", "left").select(
        "pivot", "node", F.coalesce("root", "node").alias("root"))
    hub = stars.select(F.col("pivot").alias("node")).distinct().join(near, "node", "left").select(
        F.col("node").alias("pivot"), F.coalesce("root", "node").alias("root"))
    counts = group.select("pivot", "root").unionByName(hub).groupBy("pivot", "root").agg(F.count(F.lit(1)).alias("k"))
    mixed = counts.groupBy("pivot").agg(F.max(F.struct("k", "root"))["root"].alias("top"), F.count(F.lit(1)).alias("c")).where(
        "c > 1").select("pivot", "top").persist()
    held.append(mixed)  # cached, so that the join below is of plain tables and a hot pivot's rows can be split
    members = group.join(mixed, "pivot")
    own = sets.select("node", F.col("shingles").alias("sx"))
    base = sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("sp"))
    # K for the largest y that x can be linked to.
    most = F.floor((100 - percent) * (F.col("n") + F.col("n") * 100 / percent) / (100 + percent)).alias("most")
    told = stage(members.join(own, "node").join(base, "pivot").select(
        "pivot", "node", "root", (F.col("root") != F.col("top")).alias("outside"), F.size("sx").cast("bigint").alias("n"),
        F.explode(F.concat(F.array_except("sx", "sp"), F.array_except("sp", "sx"))).alias("e")).select("*", most), "edits")
    often = told.groupBy("pivot", "e").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    # Rare elements first.  Those of one member alone take up places but needn't be indexed.
    index = told.join(often, ["pivot", "e"], "left").withColumn("at", F.row_number().over(
        Window.partitionBy("pivot", "node").orderBy(F.coalesce("often", F.lit(1)), "e")) - 1).where(
        "often is not null AND at <= most").drop("often").persist()
    held.append(index)
    return _meetings(index, percent)


def _meetings(index: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` that an index of differences ``(pivot, e, node, root, outside, n, at, most)`` lets meet.

    Whether two rows may meet depends on their sizes and places alone, so it is
    decided between cells of equal size and place, of which an element has few
    however many members hold it; only cells that pass are joined by their rows.
    """
    cell = ["outside", "n", "at"]
    side = lambda name, cols: [F.col(c).alias(f"{c}_{name}") for c in cols]
    early = index.where("2 * at <= most")
    cells = lambda rows, name: rows.select("pivot", "e", *side(name, cell)).distinct()
    # One side of a pair lies outside the pivot's largest group.
    fit = cells(early, "x").join(cells(index, "y"), ["pivot", "e"]).where(
        f"(outside_x OR outside_y) AND 100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y) "
        f"AND (at_x + at_y) * {100 + percent} <= {100 - percent} * (n_x + n_y)")
    rows = lambda of, name: of.select("pivot", "e", *side(name, ["node", "root", *cell]))
    on = lambda name: ["pivot", "e", *[f"{c}_{name}" for c in cell]]
    met = fit.join(rows(early, "x"), on("x")).join(rows(index, "y"), on("y")).where("root_x <> root_y")
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, percent: int = 85,
                    shingle: int = SHINGLE, seed: int = 11) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set
    is its distinct ``shingle``-word runs (with fewer words, the whole
    sequence).  Two documents are linked when ``100 * intersection >= percent
    * union``; ``component_id`` is the smallest id reachable over links.

    Defined results: a null, empty or blank text has an empty set, is linked
    with nothing and is its own component; equal texts and repeated rows are
    in one component (each row comes back); rows with a null id take part and
    are kept only if their whole component has no id; an empty table gives an
    empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    feats = stage(features(docs, id_col, text_col, shingle, seed), "features")
    nodes = feats.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    trees = nodes.select(
        F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "node", "n", F.col("sig").alias("all"))
    trees = trees.select(
        "tree", F.expr(f"substring(all, tree * {_BYTES} + 1, {_BYTES})").alias("sig"), "node", "n")
    ordered = trees.repartitionByRange("tree", "sig", "node").sortWithinPartitions("tree", "sig", "node")
    forest = stage(ordered.mapInArrow(
        _neighbours, "tree int, sig binary, node binary, n bigint, mate binary, lcp int"), "forest")

    # Full sets of the nodes that have a neighbour, from one document of each.
    involved = forest.select("node").distinct()
    chosen = nodes.where("rep is not null").join(involved, "node", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    size = shingle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, held, ends = [], [], [0]
            for _, s in _sets(batch.column(0), size):
                if len(s):
                    node.append(_set_key(s))
                    held.append(s.view(np.int64))
                    ends.append(ends[-1] + len(s))
            if node:
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(held)))
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), lists], ["node", "shingles"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    named = texts.join(chosen, "doc_id", "left_semi").select("text")
    without_id = texts.where("doc_id is null").select("text")
    sets = named.unionByName(without_id).mapInArrow(run, "node binary, shingles array<bigint>")
    sets = stage(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")

    # Regions, and each region's pivot: its member with the most neighbours over all trees.
    rows = stage(_regions(forest, deepest(percent)), "regions")
    degree = rows.groupBy("node").agg(F.sum("members").alias("degree"))
    pivots = rows.join(degree, "node").groupBy("tree", "region").agg(
        F.max(F.struct("degree", "node"))["node"].alias("pivot"))
    stars = rows.join(pivots, ["tree", "region"]).where("node <> pivot").select("pivot", "node").distinct().persist()
    held = [stars]
    # Besides, a few neighbours of each node: those of longest common prefixes, and any.
    offers = forest.where("mate is not null").groupBy("node", "mate").agg(F.sum("lcp").alias("score"))
    by_score = Window.partitionBy("node").orderBy(F.col("score").desc(), "mate")
    at_random = Window.partitionBy("node").orderBy(F.xxhash64("node", "mate"))
    mates = offers.withColumn("s", F.row_number().over(by_score)).withColumn("r", F.row_number().over(at_random)).where(
        (F.col("s") <= BEST_LINKS) | (F.col("r") <= RANDOM_LINKS))
    pairs = mates.select("node", F.col("mate").alias("other")).unionByName(stars.select("node", F.col("pivot").alias("other")))
    pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    near = components(_confirmed(pairs, sets, percent))

    # What the pivots' groups still hold apart.
    links = _confirmed(_across(stars, near, sets, percent, held), sets, percent)
    of = lambda c: near.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    links = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    links = links.distinct().persist()
    held.append(links)
    merged = components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).select("node", F.col("node").alias("root"))
    roots = near.unionByName(ends).groupBy("node").agg(F.min("root").alias("root"))
    label = roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("_r")), "root", "left").select(
        "node", F.coalesce("_r", "root").alias("root"))
    member = nodes.select("node", "rep").join(label, "node", "left").select(
        "node", "rep", F.coalesce("root", "node").alias("root"))
    smallest = member.groupBy("root").agg(F.min("rep").alias("component_id"))
    # Staged, so that the last join is one of two plain tables and a hot node's rows can be split.
    of_node = stage(member.join(smallest, "root").select("node", "component_id"), "component")
    for df in held:
        df.unpersist()
    out = feats.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))
