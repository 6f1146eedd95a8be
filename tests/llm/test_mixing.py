import random

import numpy as np
from helpers import no_docs, odd_docs, word_list

from sortlane.llm import mixing


def shares(sizes, weights):
    """Targets by bisection: a source gets ``level * weight`` words, twice its size at most."""
    lo, hi = 0.0, 4.0 * sum(sizes) + 1
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(mid * w, 2 * s) for s, w in zip(sizes, weights)) < 1.5 * sum(sizes) else (lo, mid)
    return [min(hi * w, 2 * s) for s, w in zip(sizes, weights)]


def test_targets_share_the_excess_again():
    assert mixing.targets([100, 100, 100], [1, 1, 1]) == [150.0, 150.0, 150.0]
    t = mixing.targets([10, 100, 100], [5, 2, 1])
    assert t[0] == 20.0 and abs(sum(t) - 315) < 1e-9 and abs(t[1] / t[2] - 2) < 1e-9
    for sizes, weights in (([7, 90, 3, 400], [5, 2, 1, 5]), ([50, 50], [5, 2]), ([1, 1, 1, 1000], [5, 2, 1, 5])):
        assert max(abs(a - b) for a, b in zip(mixing.targets(sizes, weights), shares(sizes, weights))) < 1e-6
    assert mixing.targets([0, 10], [5, 2]) == [0.0, 15.0]
    assert mixing.targets([], []) == []


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    x = [float(v) for v in rng.integers(1, 500, 300)]
    p = [0.37] * 300
    mixing.flight(p, x, rng)
    live = [v for v in p if 0 < v < 1]
    assert len(live) <= 2
    assert abs(sum(p) - 0.37 * 300) < 1e-6
    assert abs(sum(a * b for a, b in zip(p, x)) - 0.37 * sum(x)) < 1e-4


def test_inclusion_probabilities_are_kept():
    taken = np.zeros(12)
    x = [float(v) for v in (5, 9, 1, 1, 30, 2, 7, 7, 7, 100, 3, 8)]
    for s in range(4000):
        rng = np.random.default_rng(s)
        p = [0.3] * 12
        mixing.flight(p, x, rng)
        taken += p
    assert np.abs(taken / 4000 - 0.3).max() < 0.04


def test_mix_meets_targets_and_agrees_with_itself(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(1, 60))), "en", f"s{i % 4 if i % 3 else 0}", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    by = {}
    for r in got:
        assert r.size == len(word_list(rows[r.doc_id][1])) and 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    names = sorted(by)
    sizes = [sum(r.size for r in by[n]) for n in names]
    want = shares(sizes, [5, 2, 1, 5])
    for n, size, t in zip(names, sizes, want):
        assert {r.source_size for r in by[n]} == {size} and abs(by[n][0].target - t) < 1e-6
        assert abs(sum(r.taken for r in by[n]) - t) <= 120


def test_blocks_of_a_hot_source_meet_again(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)
    rows = [(i, "w " * (1 + i % 9), "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == 1500
    for name in {r.source for r in got}:
        mine = [r for r in got if r.source == name]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 20


def test_odd_rows(spark):
    got = mixing.mix_sources(odd_docs(spark)).collect()
    assert len(got) == 11
    assert {r.source for r in got} == {None, "a", "b", "c"}
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert mixing.mix_sources(no_docs(spark)).count() == 0
