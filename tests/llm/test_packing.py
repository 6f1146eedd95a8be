import random
from collections import Counter

import pytest
from helpers import no_docs, odd_docs, word_list

from sortlane.llm import packing


def check(rows, lengths):
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for items in bins.values():
        at = 0
        for r in sorted(items, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.length
        assert {r.used for r in items} == {at}
        assert {r.capacity for r in items} == {min(c for c in lengths if c >= at)}
    return bins


def best_fit_decreasing(sizes, cap):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            i = min(fits, key=lambda i: rooms[i])
            rooms[i] -= s
        else:
            rooms.append(cap - s)
    return sorted(cap - r for r in rooms)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_length_equals_best_fit_decreasing(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randrange(1, 101), 50, 33]) for _ in range(400)]
    _, bins = packing.plan_bins(Counter(sizes), [100])
    got = sorted(u for f, e, u, _ in bins for _ in range(f, e))
    assert got == best_fit_decreasing(sizes, 100)


@pytest.mark.parametrize("seed", [4, 5])
def test_plan_covers_every_piece_once_and_is_tight(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randrange(1, 4097) if rng.random() < 0.3 else rng.randrange(1, 600) for _ in range(3000))
    ranges, bins = packing.plan_bins(counts)
    for s, c in counts.items():
        own = sorted(r[1:3] for r in ranges if r[0] == s)
        assert own[0][0] == 0 and own[-1][1] == c and all(a[1] == b[0] for a, b in zip(own, own[1:]))
    assert sum(cap * (e - f) for f, e, _, cap in bins) <= 1.05 * sum(s * c for s, c in counts.items())


def test_documents_are_whole(spark):
    rng = random.Random(6)
    texts = {i: " ".join("w" for _ in range(rng.choice([rng.randrange(60), rng.randrange(9000)]))) for i in range(150)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    rows = packing.pack_documents(docs).collect()
    check(rows, packing.LENGTHS)
    for i, t in texts.items():
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.start for r in mine] == [4096 * k for k in range(len(mine))]
        assert sum(r.length for r in mine) == len(word_list(t)) + 1
    again = packing.pack_documents(docs.repartition(6)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_many_equal_pieces_share_few_runs():
    ranges, bins = packing.plan_bins({300: 10_000_000, 7: 123_456_789})
    assert len(ranges) < 200 and len(bins) < 200


def test_odd_rows(spark):
    rows = packing.pack_documents(odd_docs(spark)).collect()
    check(rows, packing.LENGTHS)
    assert Counter(r.doc_id for r in rows) == {1: 1, 2: 1, 3: 1, None: 1, 5: 1, 6: 2, 7: 8, 8: 1, 9: 1, 10: 1}
    assert {r.length for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert packing.pack_documents(no_docs(spark)).count() == 0
