"""Differences of multisets from additive cells."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sortlane.operators import sketch
from sortlane.operators.checks import multiset_reconcile
from sortlane.operators.sketch import fold, minus, moduli, multiset_difference, peel

LOG = "topic string, partition int, offset bigint, key string, value string"


def log_of(spark, topics):
    return spark.createDataFrame(
        [(t, 0, i, None, v) for t, lines in topics.items() for i, v in enumerate(lines)], LOG).repartition(4)


def lines(rng, n):
    return [f"{rng.randrange(n)},a,b" for _ in range(n)]


@pytest.mark.parametrize("changes", [0, 1, 40, 900])
def test_equals_the_exact_difference(spark, changes):
    rng = random.Random(changes)
    source = [*lines(rng, 3000), *["hot line"] * 1500, None, ""]
    topics = {"source": source}
    for t in ("id", "name", "continent"):
        mine = list(source)
        rng.shuffle(mine)
        for _ in range(changes):
            i = rng.randrange(len(mine))
            rng.choice([lambda: mine.pop(i), lambda: mine.append(mine[i]), lambda: mine.__setitem__(i, f"new{rng.randrange(50)}")])()
        topics[t] = mine
    log = log_of(spark, topics)
    got = multiset_difference(log)
    assert got.cells is not None and rows(got.rows) == rows(multiset_reconcile(log))


def test_grows_until_it_can_be_read_and_falls_back(spark):
    rng = random.Random(7)
    source = lines(rng, 4000)
    log = log_of(spark, {"source": source, "id": source[:2500], "name": source, "continent": source})
    want = rows(multiset_reconcile(log))
    grown = multiset_difference(log, first_cells=24)
    assert grown.cells > 24 and rows(grown.rows) == want
    exact = multiset_difference(log, first_cells=24, most_cells=200)
    assert exact.cells is None and rows(exact.rows) == want


def test_counts_that_disagree_are_not_believed(spark, monkeypatch):
    log = log_of(spark, {"source": ["a", "b"], "id": ["a"], "name": ["a", "b"], "continent": ["a", "b"]})
    real = sketch.peel
    monkeypatch.setattr(sketch, "peel", lambda c, p: {h: n + 1 for h, n in real(c, p).items()})
    got = multiset_difference(log)
    assert got.cells is None and rows(got.rows) == [("id", "b", 0, 1)]


def test_no_line_is_shuffled(spark):
    log = log_of(spark, {"source": ["x,y"] * 50, "id": ["x,y"] * 50})
    plans = []
    collect = type(log).collect

    def watched(self):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return collect(self)

    type(log).collect = watched
    try:
        fold(log, ["source", "id"], 64)
    finally:
        type(log).collect = collect
    exchange = plans[0][plans[0].index("Exchange hashpartitioning"):].split("\n")[0]
    assert "value" not in exchange and "topic" in exchange


def test_peeling_reads_sets_below_the_threshold():
    rng = random.Random(3)
    for n in (0, 1, 10, 40):
        primes, table = moduli(120), {}
        want = {rng.randrange(-1 << 63, 1 << 63): rng.choice([-3, -1, 1, 2, 5]) for _ in range(n)}
        for h, d in want.items():
            for j, p in enumerate(primes):
                a = table.get((j, h % p), (0, 0, 0))
                table[j, h % p] = (a[0] + d, a[1] + d * h, a[2] + d * sketch._check(h))
        assert peel(minus(table, {}), primes) == want
    assert len(set(moduli(10))) == 3 and peel({(0, 1): (0, 5, 5)}, primes) is None
    # Two lines less one look like one line by their hashes alone.
    a, b, c = 5 * 43 + 1, 9 * 43 + 1, 2 * 43 + 1
    mixed = {(0, 1): (1, a + b - c, sum(map(sketch._check, (a, b))) - sketch._check(c))}
    assert peel(mixed, [43, 47, 53]) is None


def test_a_large_difference_is_peeled_by_slices_outside_the_driver(spark, monkeypatch):
    rng = random.Random(11)
    source = [*[f"{i},a,b" for i in range(30000)], *["", None] * 300]
    mine = [v for i, v in enumerate(source) if i % 5] + [f"new{i}" for i in range(500)]
    rng.shuffle(mine)
    log = log_of(spark, {"source": source, "id": mine, "name": source, "continent": mine[:-1]}).cache()
    held = []
    collect = type(log).collect
    monkeypatch.setattr(type(log), "collect", lambda self: held.append(collect(self)) or held[-1])
    got = multiset_difference(log)
    monkeypatch.undo()
    assert got.cells > 4 * sketch.SLICE_CELLS and rows(got.rows) == rows(multiset_reconcile(log))
    # The driver holds the first table and the strata only.
    assert max(map(len, held)) <= 4 * sketch.STRATA * (sketch.STRATUM_CELLS + 30)
    # An estimate that is too small only costs another scan.
    monkeypatch.setattr(sketch, "differing", lambda *a: 1)
    again = multiset_difference(log)
    assert again.cells > sketch.SLICE_CELLS and rows(again.rows) == rows(got.rows)


@pytest.mark.parametrize("n", [300, 5000, 40000])
def test_strata_tell_how_many_lines_differ(spark, n):
    source = [f"{i},a,b" for i in range(60000)]
    log = log_of(spark, {"source": source, "id": source[n:]})
    assert n / 2 < sketch.differing(log, ["id"], "source") < 2 * n


def test_only_the_slices_that_fail_are_read_again(spark, monkeypatch):
    """Lines that share all cells of their slice's table can't be told apart by it."""
    slices, primes = 3, moduli(sketch.SLICE_CELLS)
    hashes = spark.range(250000).select(F.concat(F.col("id").cast("string"), F.lit(",a,b")).alias("value")).withColumn(
        "h", sketch._hash()).withColumn("s", F.pmod(F.shiftright("h", sketch._SLICED), F.lit(slices)))
    places = [F.pmod("h", F.lit(p).cast("bigint")).alias(f"p{j}") for j, p in enumerate(primes)]
    alike = hashes.groupBy("s", *places).agg(F.collect_list("value").alias("v")).where("size(v) > 1 AND s = 1").orderBy("p0", "p1").limit(2)
    stuck = [v for r in alike.collect() for v in r["v"]]
    assert len(stuck) >= 4
    source = [*stuck, *[f"other {i}" for i in range(9000)]]
    log = log_of(spark, {"source": source, "id": source[len(stuck) + 1200:], "name": source, "continent": source[5:]})
    read = []
    real = sketch._peeled
    monkeypatch.setattr(sketch, "differing", lambda *a: slices * sketch.SLICE_CELLS // 2)
    monkeypatch.setattr(sketch, "_peeled", lambda sums, *a: read.append(sums.select("group").distinct().count()) or real(sums, *a))
    # All slices halved would be more cells than allowed.
    got = multiset_difference(log, most_cells=5 * sketch.SLICE_CELLS)
    assert got.cells == 2 * slices * sketch.SLICE_CELLS and read == [3, 2]
    assert rows(got.rows) == rows(multiset_reconcile(log)) and len(rows(got.rows)) == len(stuck) + 1200 + 5


def test_tables_peel_as_one_by_one():
    rng = random.Random(5)
    primes = moduli(300)
    firsts = [sum(primes[:j]) for j in range(3)]
    arrays, tables, want = sketch.np.zeros((5, 4, sum(primes)), "int64"), [{} for _ in range(4)], []
    for t, n in enumerate((0, 30, 120, 500)):  # the last one is too full
        lines = {rng.randrange(-1 << 63, 1 << 63): rng.choice([-4, -1, 1, 3, 1 << 30]) for _ in range(n)}
        want.append(lines)
        for h, d in lines.items():
            parts = [1, h & 0x3FFFFF, h >> 22 & 0x1FFFFF, h >> 43, sketch._check(h)]
            assert parts[1] + (parts[2] << 22) + (parts[3] << 43) == h
            for j, p in enumerate(primes):
                a = tables[t].get((j, h % p), (0, 0, 0))
                tables[t][j, h % p] = (a[0] + d, a[1] + d * h, a[2] + d * sketch._check(h))
                arrays[:, t, firsts[j] + h % p] += [d * x for x in parts]
    t, h, n, read = sketch.peel_tables(arrays, primes)
    assert read.tolist() == [True, True, True, False]
    for k in range(3):
        got = {}
        for line, d in zip(h[t == k].tolist(), n[t == k].tolist()):
            got[line] = got.get(line, 0) + d
        assert {line: d for line, d in got.items() if d} == want[k] == peel(tables[k], primes)
    assert peel(tables[3], primes) is None
