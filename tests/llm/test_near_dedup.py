import random
import time

import numpy as np
import pytest
from helpers import no_docs, odd_docs, word_list

from sortlane.llm import dedup
from sortlane.llm.graph import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, percent=85):
    """(doc_id, n_shingles, component_id) per row by comparing all sets."""
    sets = []
    for _, text in rows:
        w = word_list((text or "").translate(LOWER))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        low.setdefault(find(i), []).append(d)
    return sorted((d, len(sets[i]), min(low[find(i)])) for i, (d, _) in enumerate(rows))


def near_copies(seed, groups=12, size=14):
    """Groups around the threshold: chains of texts that each change a few words."""
    rng = random.Random(seed)
    rows, d = [], 0
    for g in range(groups):
        words = [f"w{g}x{rng.randrange(400)}" for _ in range(rng.choice([9, 40, 120]))]
        for _ in range(size):
            rows.append((d, " ".join(words)))
            d += 1
            for _ in range(rng.choice([0, 1, 1, 2])):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_comparing_all_pairs(spark, seed):
    rows = near_copies(seed)
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())
    assert got == brute(rows)


def test_regions_with_many_groups_are_cut_deeper(spark, monkeypatch):
    monkeypatch.setattr(dedup, "REGION_ROWS", 4)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    rows = []
    for d in range(120):  # all pairs near the threshold, many below it
        words = list(base)
        for _ in range(3):
            words[rng.randrange(300)] = f"n{d}x{rng.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())
    assert got == brute(rows)


def test_edits_of_one_text_and_edits_of_those(spark):
    """Copies near a hub, others too far from it that are near one another."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]

    def edit(words, k):
        words = list(words)
        for _ in range(k):
            i = rng.randrange(len(words))
            what = rng.random()
            if what < 0.2:
                words.insert(i, f"i{rng.randrange(10**6)}")
            elif what < 0.4:
                del words[i]
            else:
                words[i] = f"n{rng.randrange(10**6)}"
        return words

    texts = [base] + [edit(base, rng.choice([1, 2, 3, 4, 6])) for _ in range(150)]
    texts += [edit(rng.choice(texts), rng.choice([1, 2])) for _ in range(150)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()) == brute(rows)


def test_odd_rows(spark):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in dedup.near_duplicates(odd_docs(spark)).collect()),
                 key=lambda r: (r[0] is None, r))
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 4, 5, True), (6, 4, 5, False), (6, 4, 5, False),
                   (7, 1, 7, True), (8, 1, 8, True), (9, 1, 8, False), (10, 1, 10, True), (None, 7, None, True)]
    assert dedup.near_duplicates(no_docs(spark)).count() == 0


def test_a_copy_without_id_joins_the_one_with(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (2, "A b c d e f")]
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in out.collect()), key=str) == [
        (2, 2, True), (4, 2, False), (None, 2, False)]


def test_components_of_chains_stars_and_nothing(spark):
    links = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(200)] + [("hub", f"s{i:03d}") for i in range(150)] + [
        ("x", "x"), (None, "y")]
    random.Random(1).shuffle(links)
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    chain = {out[f"c{i:03d}"] for i in range(201)}
    star = {out["hub"], *(out[f"s{i:03d}"] for i in range(150))}
    assert len(chain) == len(star) == 1 and chain != star and len(out) == 201 + 151
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_signatures_agree_as_often_as_the_sets():
    sign = dedup._signer(11)
    rng = np.random.default_rng(0)
    common, rest = rng.integers(0, 2**64, 800, dtype=np.uint64), rng.integers(0, 2**64, 200, dtype=np.uint64)
    a = np.frombuffer(sign(np.concatenate([common, rest[:100]])), ">u2")
    b = np.frombuffer(sign(np.concatenate([common, rest[100:]])), ">u2")
    assert abs((a == b).mean() - 0.8) < 0.1


def template_copies(n, own):
    """One template of 60 words, each document with some words of its own in its middle."""
    base = [f"t{i}" for i in range(60)]
    return [(i, " ".join(base[:30] + [f"d{i}o{k}" for k in range(own)] + base[30:])) for i in range(n)]


@pytest.mark.parametrize("own", [2, 3, 9, 12])
def test_documents_of_one_template_around_the_threshold(spark, own):
    rows = template_copies(60, own)
    out = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()) == brute(rows)


def test_members_at_places_that_cannot_meet_are_not_paired(spark):
    """30,000 members hold one element too late to meet: 900 million pairs if they were joined by it."""
    late = spark.range(30000).selectExpr(
        "1L AS pivot", "7L AS e", "id AS node", "id AS root", "true AS outside", "cast(70 + id % 3 as bigint) AS n",
        "6 AS at", "12L AS most")
    near = spark.range(4).selectExpr(
        "1L AS pivot", "8L AS e", "id AS node", "id AS root", "id > 0 AS outside", "70L AS n", "cast(id as int) AS at", "10L AS most")
    began = time.time()
    got = sorted(tuple(r) for r in dedup._meetings(late.unionByName(near), 85).collect())
    assert got == [(a, b) for a in range(4) for b in range(a + 1, 4)] and time.time() - began < 60
