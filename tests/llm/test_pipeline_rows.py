"""Stages of the pipeline where ids are missing or repeated."""

import random

import corpus_pipeline as cp
from conftest import SF_SMALL
from helpers import DOC_SCHEMA

RNG = random.Random(3)
A, B, C = (" ".join(f"w{RNG.randrange(10 ** 6)}" for _ in range(60)) for _ in range(3))


def frame(spark, pairs, source="s"):
    rows = [(d, t, "en", source, len(t or "")) for d, t in pairs]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


def kept(spark, pairs):
    out = cp.near_dedup(spark, frame(spark, pairs), SF_SMALL)
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_unlike_texts_of_one_id_all_stay(spark):
    assert kept(spark, [(7, A), (7, B)]) == sorted([(7, A), (7, B)], key=str)
    assert kept(spark, [(3, B), (7, A), (7, B)]) == sorted([(3, B), (7, A)], key=str)


def test_copies_without_an_id_go(spark):
    near = A + " more"
    got = kept(spark, [(None, A), (None, A), (None, near), (5, B), (None, B), (None, C), (9, ""), (9, ""), (8, "")])
    assert got[:2] == [(5, B), (8, "")] and (9, "") in got and (None, C) in got
    assert len(got) == 5 and sum(t in (A, near) for _, t in got) == 1


def mixable(spark, ids):
    """Two sources: all of the first is taken twice, the second about 4/3 times."""
    rows = [(ids(i), f"{i} " + "word " * (i % 7), "en", s, i) for s, n in (("a", 300), ("b", 900)) for i in range(n)]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


def test_mix_decides_row_by_row(spark):
    for ids in (lambda i: None, lambda i: i % 2):
        docs = mixable(spark, ids)
        out = cp.mix(spark, docs, SF_SMALL).collect()
        sizes = {s: sum(len(r.text.split()) for r in docs.collect() if r.source == s) for s in "ab"}
        taken = {s: sum(len(r.text.split()) for r in out if r.source == s) for s in "ab"}
        total = 1.5 * sum(sizes.values())
        want = dict(a=min(2 * sizes["a"], total * 5 / 7))
        want["b"] = min(2 * sizes["b"], total - want["a"])
        assert all(abs(taken[s] - want[s]) <= 14 for s in "ab"), (taken, want)
        copies = {}
        for r in out:
            copies[r.source, r.text] = copies.get((r.source, r.text), 0) + 1
        assert max(copies.values()) <= 2
