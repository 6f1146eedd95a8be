"""Mixing sources to target weights by the cube method.

A document's inclusion number is ``target / size`` of its source: its whole
part is taken outright, the fraction is sampled.  The cube method moves the
vector of fractional probabilities through the null space of the balancing
constraints (document count and word count) until each entry is 0 or 1, so
the sample's totals equal the targets up to a small landing problem.

It runs as a tree: the undecided documents of a source are dealt into
blocks of about ``BLOCK`` by a hash of their place in key order; one task solves a block exactly and leaves
at most two undecided; the leavings of all blocks are dealt again, until one
block per source is left, whose last entries are landed.  Each level shrinks
the undecided rows about a thousandfold, so a hot source is just more blocks.
Only ``(key, source, size, probability)`` moves, never texts.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortlane.functions.tables import small_table
from sortlane.operators.order import stage

from .places import placed
from .text import WORD

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST = 2
BLOCK = 4000
_EPS = 1e-9


def targets(sizes: Sequence[int], weights: Sequence[float], percent: int = SHARE_PERCENT,
            most: int = MOST) -> list[float]:
    """Share ``percent`` of the total size by weight; a target above ``most``
    times its source's size stops there and the excess is shared again by
    weight among the others, until none is above."""
    caps = [float(most * s) for s in sizes]
    out, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = sum(sizes) * percent / 100
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if unit * weights[i] > caps[i]]
        if not over:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in over:
            out[i] = caps[i]
            left -= caps[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def flight(p: list[float], x: list[float], rng) -> None:
    """Flight phase in place: balance ``sum p`` and ``sum p*x`` until at most
    two entries stay fractional.

    Three undecided entries span a null space of the two constraints; the walk
    moves along it to a face of the cube, up or down with the odds that keep
    every entry's expectation.
    """
    todo = (i for i in range(len(p)) if _EPS < p[i] < 1 - _EPS)
    live = list(itertools.islice(todo, 3))
    draws = iter(rng.random(len(p) + 3).tolist())
    while len(live) == 3:
        i, j, k = live
        # Null vector of rows (1, 1, 1) and (x_i, x_j, x_k); equal x: move i against j.
        u = (x[k] - x[j], x[i] - x[k], x[j] - x[i])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = math.inf
        for t, c in zip(live, u):
            if c > 0:
                up, down = min(up, (1 - p[t]) / c), min(down, p[t] / c)
            elif c < 0:
                up, down = min(up, p[t] / -c), min(down, (1 - p[t]) / -c)
        step = up if next(draws, 0.5) * (up + down) < down else -down
        for t, c in zip(live, u):
            v = p[t] + step * c
            p[t] = 0.0 if v < _EPS else 1.0 if v > 1 - _EPS else v
        live = [t for t in live if 0 < p[t] < 1]
        live.extend(itertools.islice(todo, 3 - len(live)))


def land(p: list[float], x: list[float]) -> None:
    """Landing phase in place: of the up to 2**k roundings of the k <= 2
    entries left, the one whose word total is nearest to the wanted one."""
    live = [i for i in range(len(p)) if 0 < p[i] < 1]
    want = sum(p[i] * x[i] for i in live)
    best = min(itertools.product((0.0, 1.0), repeat=len(live)),
               key=lambda c: (abs(sum(a * x[i] for a, i in zip(c, live)) - want), c))
    for i, c in zip(live, best):
        p[i] = c


def _solver(size_col, prob_col, names, seed, level, last):
    """Arrow function of one block: flight, and landing at the last level."""

    def solve(t):
        t = t.sort_by("_n")
        rng = np.random.Generator(np.random.PCG64([seed, level, t.num_rows, t["_block"][0].as_py()]))
        # Random order, then large documents first: the few left for the landing are small.
        order = rng.permutation(t.num_rows)
        t = t.take(order[np.argsort(-t[size_col].to_numpy()[order], kind="stable")])
        p, x = t[prob_col].to_pylist(), [float(v) for v in t[size_col].to_pylist()]
        flight(p, x, rng)
        if last:
            land(p, x)
        return t.set_column(t.column_names.index(prob_col), prob_col, pa.array(p, pa.float64())).select(names)

    return solve


def cube_sample(units: DataFrame, group_cols: Sequence[str], key_cols: Sequence[str], size_col: str = "size",
                prob_col: str = "p", seed: int = 3) -> DataFrame:
    """Add ``chosen`` (0 or 1) to ``units``; ``prob_col`` is in [0, 1].

    Balanced per group on the number of units and on ``size_col``.  Units equal
    in all key columns are interchangeable; they must tell all others apart.
    Units are dealt by their place in the order of these columns, so equal ones
    spread over the blocks.  The result depends only on the rows and the seed.
    """
    groups = list(group_cols)
    units = placed(units, [*groups, *key_cols, size_col, prob_col], "_n")
    kinds = dict(units.dtypes)
    names = list(units.columns)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names)
    done: DataFrame | None = None
    level = 0
    while True:
        counts = units.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(groups)]).agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("bigint").alias("_blocks"))
        most = counts.agg(F.max("_blocks")).first()[0] or 0
        last = most <= 1
        same = F.lit(True)
        for i, c in enumerate(groups):
            same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
        # One row per group: bounded by the number of sources, not of documents.
        dealt = units.join(counts, same).drop(*[f"_g{i}" for i in range(len(groups))])
        dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("_n", F.lit(seed + level)), F.col("_blocks")))

        solved = stage(dealt.groupBy(*groups, "_block").applyInArrow(
            _solver(size_col, prob_col, names, seed, level, last), schema), "solved")
        sure = (F.col(prob_col) <= 0) | (F.col(prob_col) >= 1)
        part = solved.where(sure)
        done = part if done is None else done.unionByName(part)
        if last:
            break
        units, level = solved.where(~sure), level + 1
    return done.withColumn("chosen", F.col(prob_col).cast("int")).drop(prob_col, "_n")


def mix_plan(spark, totals: list[tuple], weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT,
             most: int = MOST) -> DataFrame:
    """``(source, source_size, target)`` from per-source totals.

    Sources are taken in code-point order, null last; weights repeat.
    """
    ordered = sorted(totals, key=lambda r: (r[0] is None, r[0] or ""))
    w = [weights[i % len(weights)] for i in range(len(ordered))]
    t = targets([int(r[1]) for r in ordered], w, percent, most)
    rows = [(r[0], int(r[1]), float(x)) for r, x in zip(ordered, t)]
    return small_table(spark, rows, "source string, source_size bigint, target double")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
                weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT, most: int = MOST,
                seed: int = 3, row_col: str | None = None) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies, source)``, one row per input row.

    ``copies`` is how often the mix takes the document, ``taken = copies * size``.
    Each source's taken words differ from its target by at most about two
    documents' words; no document is taken more than ``most`` times.

    ``row_col`` names a unique key of each row, which is returned as the last
    column, so that the decision can be joined back to its row.  Rows are then
    told apart by a digest of all their other columns too, never by the key,
    so the rows taken don't depend on it.

    Defined results: a null, empty or blank text has size 0 and takes 0 words;
    a null source is a source of its own, last in order; a source without
    words has target 0; repeated rows are separate units, equal ones and ties
    are interchangeable, and a third of all rows may be equal; a very long text
    is one unit of its size, and the largest are decided first; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    row = [F.col(row_col), F.xxhash64(*[c for c in docs.columns if c != row_col]).alias("_tie")] if row_col else []
    carried, told = ([row_col, "_tie"], ["doc_id", "_tie"]) if row_col else ([], ["doc_id"])
    sized = stage(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        *row), "sizes")
    # One row per source goes to the driver.
    totals = [(r[0], r[1]) for r in sized.groupBy("source").agg(F.sum("size")).collect()]
    plan = mix_plan(spark, totals, weights, percent, most)
    on = sized["source"].eqNullSafe(plan["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + F.lit(1e-12)).cast("int")
    units = sized.join(F.broadcast(plan), on).select(
        "doc_id", sized["source"], "size", "source_size", "target", whole.alias("whole"),
        F.greatest(F.lit(0.0), rate - whole).alias("p"), *carried)
    out = cube_sample(units, ["source"], told, "size", "p", seed)
    copies = F.col("whole") + F.col("chosen")
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("bigint").alias("taken"),
                      copies.alias("copies"), "source", *carried[:1])
