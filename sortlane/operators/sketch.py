"""Difference of multisets without shuffling lines (A3).

Each topic is folded into a table of additive cells: every line adds its 64-bit
hash, a check number and a count of one to three cells, chosen by the remainders
of the hash by three primes.  The check number comes from a product of two remainders,
so sums of several lines' hashes don't pass for a line's.  Hashes are added in parts of
at most 22 bits, so that sums are longs (of up to 2**41 lines a cell) and not decimals.  One scan with map-side sums does it; what is
shuffled is the cells, whose number is a parameter.  Subtracting a sorted topic's
cells from the source's leaves the lines that differ, and equal lines cancel.

The difference is read back by peeling: a cell whose sums are a multiple of one
line's hashes gives that line's hash and its surplus, which are taken from its
other cells, until all cells are empty.  That works while the lines that differ
are fewer than about 0.8 of the cells.  If the first table, which the driver
reads, can't hold them, strata (tables of ever smaller samples of the hashes)
say about how many lines differ, and the lines are dealt by their hash over as
many slices as that takes, each with a table of ``SLICE_CELLS``; a task peels a
slice, so neither the driver nor a task holds more than small tables.  Of many
slices a few always fail, be it by two lines that share all three cells (about
one slice in 400); they alone are halved and read again, by other primes.  A further
scan looks up the lines by hash and counts them exactly.  Where the tables would
have more cells than the log has lines, or if those counts disagree with the
surpluses, the exact aggregation of all lines is used instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tables import small_table
from ..schema import SORT_KEYS, SOURCE_TOPIC
from .checks import multiset_reconcile
from .order import stage

FIRST_CELLS = 512
SLICE_CELLS = 2048
STRATA, STRATUM_CELLS = 32, 120
_DENSE = 2  # strata below this one, three quarters of the lines, hold more than can be read where the first table can't be
_HASHES = 3
_PARTS = (0, 22), (22, 21), (43, 21)  # first bit and bits of the parts of a hash; the last one has the sign
_CHECK = (1 << 22) - 1
_SLICED = 32  # the bits of a hash from here on choose its slice and its stratum
_A, _B = 2147483647, 2147483629  # primes below 2**31, so that a product of remainders is a long
Cells = dict[tuple[int, int], tuple[int, int, int]]


@dataclass(frozen=True)
class Difference:
    """``rows`` is ``(topic, value, n_topic, n_source)`` of the differing lines;
    ``cells`` the table that could be read back, None if the exact way was taken."""

    rows: DataFrame
    cells: int | None


def _prime(at_least: int) -> int:
    n = max(2, at_least)
    while any(n % d == 0 for d in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def moduli(cells: int) -> list[int]:
    """Three different primes that add up to about ``cells``."""
    out = [_prime(cells // _HASHES)]
    while len(out) < _HASHES:
        out.append(_prime(out[-1] + 1))
    return out


def _line() -> Column:
    return F.coalesce(F.col("value"), F.lit(""))


def _hash() -> Column:
    return F.xxhash64(F.lit("line"), _line())


def _check(h: int) -> int:
    return (h % _A) * (h % _B) & _CHECK


def _slice(slices: int) -> Column:
    return F.pmod(F.shiftright("h", _SLICED), F.lit(slices).cast("bigint"))


def _hashes(log: DataFrame, topics: Sequence[str]) -> DataFrame:
    """``(t, h)``: the topic's place in ``topics`` and the hash of every line."""
    of = F.array_position(F.array(*[F.lit(t) for t in topics]), F.col("topic")) - 1
    return log.where(F.col("topic").isin(*topics)).select(of.alias("t"), _hash().alias("h"))


def _sums(hashes: DataFrame, topics: int, primes: Sequence[int], group: Column | None = None) -> DataFrame:
    """``(group, t, at, n, h0, h1, h2, g)``: the cells of a table of every group of
    hashes and topic; ``at`` counts through the cells of all primes."""
    width, group = sum(primes), F.lit(0) if group is None else group
    check = (F.pmod("h", F.lit(_A).cast("bigint")) * F.pmod("h", F.lit(_B).cast("bigint"))).bitwiseAND(F.lit(_CHECK))
    part = lambda first, bits: F.shiftright("h", first).bitwiseAND(F.lit((1 << bits) - 1)) if first + bits < 64 else F.shiftright("h", first)
    table = (group.cast("bigint") * topics + F.col("t")) * width
    # One long is the key of a cell in all tables.
    places = [(table + sum(primes[:j]) + F.pmod("h", F.lit(p).cast("bigint"))).alias(f"_{j}") for j, p in enumerate(primes)]
    parts = [part(*x).alias(f"h{i}") for i, x in enumerate(_PARTS)]
    # An array of another projection would get a filter on its size, which computes lines and hashes once more.
    cell = F.explode(F.array(*[f"_{j}" for j in range(len(primes))])).alias("topic_cell")
    sums = hashes.select(*places, *parts, check.alias("g")).select(cell, "h0", "h1", "h2", "g").groupBy("topic_cell").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("h0", "h1", "h2", "g")])
    number = F.expr(f"topic_cell div {width}")
    return sums.select(F.expr(f"topic_cell div {width * topics}").alias("group"), F.pmod(number, F.lit(topics)).alias("t"),
                       F.pmod("topic_cell", F.lit(width)).alias("at"), "n", "h0", "h1", "h2", "g")


def _tables(sums: DataFrame, topics: Sequence[str], primes: Sequence[int]) -> dict[tuple[int, str], Cells]:
    """The tables by group and topic, on the driver."""
    places = [(j, at) for j, p in enumerate(primes) for at in range(p)]
    out: dict[tuple[int, str], Cells] = {}
    for r in sums.collect():  # at most a table per group and topic
        h = sum(r[f"h{i}"] << first for i, (first, _) in enumerate(_PARTS))
        out.setdefault((r["group"], topics[r["t"]]), {})[places[r["at"]]] = (r["n"], h, r["g"])
    return out


def fold(log: DataFrame, topics: Sequence[str], cells: int) -> dict[str, Cells]:
    """Cells ``{(which prime, place): (count, sum of hashes, sum of check numbers)}`` per topic."""
    primes = moduli(cells)
    found = _tables(_sums(_hashes(log, topics), len(topics), primes), topics, primes)
    return {t: found.get((0, t), {}) for t in topics}


def minus(a: Cells, b: Cells) -> Cells:
    out = {}
    for k in a.keys() | b.keys():
        d = tuple(x - y for x, y in zip(a.get(k, (0, 0, 0)), b.get(k, (0, 0, 0))))
        if d != (0, 0, 0):
            out[k] = d
    return out


def peel(cells: Cells, primes: Sequence[int]) -> dict[int, int] | None:
    """``{hash: surplus}`` of the lines that a difference of tables holds, or None if it can't be read."""
    cells, found = dict(cells), {}
    todo = list(cells)
    while todo:
        k = todo.pop()
        n, h, g = cells.get(k, (0, 0, 0))
        if n == 0 or h % n or g % n:
            continue
        line = h // n
        if g // n != _check(line) or not -1 << 63 <= line < 1 << 63 or line % primes[k[0]] != k[1]:
            continue
        found[line] = found.get(line, 0) + n
        for j, p in enumerate(primes):
            at = (j, line % p)
            left = tuple(x - y for x, y in zip(cells.get(at, (0, 0, 0)), (n, h, g)))
            if left == (0, 0, 0):
                cells.pop(at, None)
            else:
                cells[at] = left
                todo.append(at)
    return None if cells else {h: n for h, n in found.items() if n}


def differing(log: DataFrame, targets: Sequence[str], source: str) -> int:
    """About how many lines differ in the target that differs most.

    Stratum k holds one of 2**(k + 1) hashes, the last one what is left.  The
    strata are peeled from the sparsest on; the first that can't be read ends it,
    at ``_DENSE`` at the latest, and the lines found stand for all.
    """
    bits = F.shiftright("h", _SLICED)
    # Trailing zeros: the lowest bit set is a power of two.
    stratum = F.least(F.when(bits == 0, STRATA - 1).otherwise(
        F.log2(bits.bitwiseAND(-bits).cast("double"))).cast("int"), F.lit(STRATA - 1))
    topics, primes, most = [source, *targets], moduli(STRATUM_CELLS), 0
    sparse = _hashes(log, topics).where(bits.bitwiseAND(F.lit((1 << _DENSE) - 1)) == 0)
    tables = _tables(_sums(sparse, len(topics), primes, stratum), topics, primes)  # at most STRATA small tables per topic
    for t in targets:
        found, k = 0, STRATA - 1
        while k >= _DENSE:
            lines = peel(minus(tables.get((k, source), {}), tables.get((k, t), {})), primes)
            if lines is None:
                found = max(found, STRATUM_CELLS // 4)
                break
            found, k = found + len(lines), k - 1
        most = max(most, found << (k + 1))
    return most


def peel_tables(cells: np.ndarray, primes: Sequence[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``peel`` of several differences at once: ``cells[k, t, at]`` has number k of ``n, h0, h1, h2, g``.

    All cells that hold one line are taken in a round.  Returns the tables, hashes
    and surpluses of the lines and whether each table could be read.
    """
    _, tables, width = cells.shape
    cells = cells.reshape(len(cells), -1).copy()
    firsts = np.cumsum([0, *primes[:-1]])
    prime, first = (np.tile(np.repeat(x, primes), tables) for x in (primes, firsts))
    place = np.tile(np.arange(width), tables) - first
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(width):  # a round takes a line at least, and a table holds fewer than its cells
        at = np.flatnonzero(cells[0])
        q, r = np.divmod(cells[1:, at], cells[0, at])
        (h0, h1, h2, g) = q
        h = (h2 << _PARTS[2][0]) + (h1 << _PARTS[1][0]) + h0
        one = (r == 0).all(axis=0) & (g == (h % _A) * (h % _B) & _CHECK) & (h % prime[at] == place[at])
        for x, low, bits in ((h0, 0, _PARTS[0][1]), (h1, 0, _PARTS[1][1]), (h2, -1 << _PARTS[2][1] - 1, _PARTS[2][1])):
            one &= (x >= low) & (x < low + (1 << bits))
        if not one.any():
            break
        # A line may be alone in several of its cells.
        t, line = at[one] // width, h[one]
        order = np.lexsort((t, line))
        once = order[np.append(True, (np.diff(t[order]) != 0) | (np.diff(line[order]) != 0))]
        t, line, n = t[once], line[once], cells[0, at[one]][once]
        taken = np.stack([n, *(q[:, one][:, once] * n)])
        for p, start in zip(primes, firsts):
            for numbers, x in zip(cells, taken):
                np.subtract.at(numbers, t * width + start + line % p, x)
        found.append((t, line, n))
    read = ~cells.reshape(len(cells), tables, width).any(axis=(0, 2))
    t, line, n = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, "int64") for i in range(3))
    return t, line, n, read


def _peeled(sums: DataFrame, targets: Sequence[str], source: str, slices: int, primes: Sequence[int]) -> DataFrame:
    """``(_slice, _topic, _h, _n)``: surpluses of the lines of every slice, each peeled by
    itself; a slice that can't be read for some target gives one row without ``_h``."""
    topics = [source, *targets]
    of = [topics.index(t) for t in targets]

    def peel_slice(cells: pd.DataFrame) -> pd.DataFrame:  # at most SLICE_CELLS rows per topic
        number, tables = int(cells["group"].iloc[0]), np.zeros((5, len(topics), sum(primes)), "int64")
        tables[:, cells["t"].to_numpy(), cells["at"].to_numpy()] = cells[["n", "h0", "h1", "h2", "g"]].to_numpy().T
        t, h, n, read = peel_tables(tables[:, :1] - tables[:, of], primes)
        if not read.all() or ((h >> _SLICED) % slices != number).any():
            out = pd.DataFrame({"_topic": [None], "_h": [None], "_n": [None]})
        else:
            lines = pd.DataFrame({"t": t, "_h": h, "_n": n}).groupby(["t", "_h"], as_index=False).sum()
            out = lines[lines["_n"] != 0].assign(_topic=lambda x: np.array(topics[1:], object)[x["t"]])
        return out.assign(_slice=number)[["_slice", "_topic", "_h", "_n"]].astype({"_h": "Int64", "_n": "Int64"})

    return sums.groupBy("group").applyInPandas(peel_slice, "_slice bigint, _topic string, _h bigint, _n bigint")


def _sliced(log: DataFrame, targets: Sequence[str], source: str, slices: int, most_cells: int) -> tuple[DataFrame | None, int]:
    """The surpluses by slices, staged, and the number of slices they took; None
    if that would be more than ``most_cells``.

    Slices that can't be read are halved and read again, without the others' lines.
    """
    hashes, parts, width = _hashes(log, [source, *targets]), [], SLICE_CELLS
    todo = slices
    while todo * SLICE_CELLS <= most_cells and slices < 1 << _SLICED:
        primes = moduli(width)
        out = stage(_peeled(_sums(hashes, 1 + len(targets), primes, _slice(slices)), targets, source, slices, primes), "surplus")
        parts.append(out.where("_h IS NOT NULL").select("_topic", "_h", "_n"))
        failed = out.where("_h IS NULL").select("_slice")
        todo = 2 * failed.count()
        if not todo:
            return reduce(DataFrame.unionByName, parts), slices
        hashes = hashes.withColumn("_slice", _slice(slices)).join(F.broadcast(failed), "_slice", "left_semi").select("t", "h")
        slices, width = 2 * slices, _HASHES * (primes[-1] + 1)  # other primes part lines that share their cells
    return None, slices


def multiset_difference(log: DataFrame, targets: Sequence[str] = tuple(SORT_KEYS), source: str = SOURCE_TOPIC, *,
                        first_cells: int = FIRST_CELLS, most_cells: int | None = None) -> Difference:
    """Lines whose multiplicity differs between a target topic and the source, as
    ``checks.multiset_reconcile`` gives them, without a shuffle of the lines while few differ.

    ``most_cells``: of all slices; without it, the lines of the log.  Lines that
    differ but leave all cells of a topic empty are missed; that takes equal sums
    of 64-bit hashes and of their check numbers.
    """
    tables, primes = fold(log, [source, *targets], first_cells), moduli(first_cells)
    surplus = {t: peel(minus(tables[source], tables[t]), primes) for t in targets}
    if None not in surplus.values():
        # Fewer rows than the first table's cells, by the peeling.
        hashes = [(t, h, n) for t, hs in surplus.items() for h, n in hs.items()]
        rows = _lookup(log, F.broadcast(small_table(log.sparkSession, hashes, "_topic string, _h bigint, _n bigint")),
                       targets, source)
        return Difference(rows, first_cells) if rows is not None else Difference(multiset_reconcile(log, targets, source), None)
    if most_cells is None:
        most_cells = sum(c[0] for cells in tables.values() for (j, _), c in cells.items() if j == 0)
    slices = max(1, -(-2 * differing(log, targets, source) // SLICE_CELLS))
    wanted, slices = _sliced(log, targets, source, slices, most_cells)
    rows = None if wanted is None else _lookup(log, wanted, targets, source)
    return Difference(rows, slices * SLICE_CELLS) if rows is not None else Difference(multiset_reconcile(log, targets, source), None)


def _lookup(log: DataFrame, wanted: DataFrame, targets: Sequence[str], source: str) -> DataFrame | None:
    """The lines behind the hashes with their counts; None if these aren't the surpluses."""
    lines = log.where(F.col("topic").isin(source, *targets)).select("topic", _line().alias("value"), _hash().alias("h"))
    is_source = F.col("topic") == F.lit(source)
    hit = lines.join(wanted, (F.col("h") == F.col("_h")) & (is_source | (F.col("topic") == F.col("_topic"))))
    counts = hit.groupBy(F.col("_topic").alias("topic"), "value", "h").agg(
        F.sum(F.when(is_source, 0).otherwise(1)).cast("bigint").alias("n_topic"),
        F.sum(F.when(is_source, 1).otherwise(0)).cast("bigint").alias("n_source"))
    counts = stage(counts, "difference")
    # Every hash wanted must have lines whose counts add up to its surplus.
    found = counts.select(F.col("topic").alias("_topic"), F.col("h").alias("_h"), (F.col("n_source") - F.col("n_topic")).alias("_d"))
    sums = found.unionByName(wanted.select("_topic", "_h", (-F.col("_n")).alias("_d"))).groupBy("_topic", "_h").agg(F.sum("_d").alias("_d"))
    if sums.where("_d <> 0").limit(1).count():
        return None
    return counts.where("n_topic <> n_source").select("topic", "value", "n_topic", "n_source")
