"""Queries that SQL can't express whole, on a whole given table against direct computations."""

import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from helpers import word_list
from test_mixing import shares
from test_packing import best_fit_decreasing, check

from sortlane.llm import packing, registry


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()


def test_mix(spark, documents):
    got = registry.op3_mix_sources(spark, SF_SMALL).collect()
    sizes = Counter()
    for d in documents:
        sizes[d["source"]] += len(word_list(d["text"]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(names, shares([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])))
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter(
        (d["doc_id"], len(word_list(d["text"])), sizes[d["source"]]) for d in documents)
    for s in names:
        mine = [r for r in got if r.source == s]
        whole = int(target[s] / sizes[s] + 1e-9) if sizes[s] else 0
        assert all(abs(r.target - target[s]) < 1e-6 * max(1, target[s]) for r in mine)
        assert all(r.taken in (whole * r.size, min(2, whole + 1) * r.size) for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= 2 * max(r.size for r in mine)


def test_shards(spark, documents):
    got = registry.op9_shuffle_shards(spark, SF_SMALL).collect()
    raw = [(d["text"] or "").encode() for d in documents]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d["doc_id"], len(t) + 8, zlib.crc32(t)) for d, t in zip(documents, raw))
    count = Counter(r.shard for r in got)
    assert sorted(count) == list(range(24)) and max(count.values()) - min(count.values()) <= 1
    for s in count:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(count[s]))


def test_packing(spark, documents):
    got = registry.op10_pack(spark, SF_SMALL).collect()
    bins = check(got, packing.LENGTHS)
    most = max(packing.LENGTHS)
    pieces = Counter()
    for d in documents:
        n = len(word_list(d["text"])) + 1
        for i, start in enumerate(range(0, n, most)):
            pieces[d["doc_id"], i, start, min(most, n - start)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in got) == pieces

    def cost(used):
        return sum(min(c for c in packing.LENGTHS if c >= u) + packing.OVERHEAD for u in used)

    # One length alone, downsized too.
    alone = cost(best_fit_decreasing([k[3] for k in pieces.elements()], most))
    assert cost([items[0].used for items in bins.values()]) <= 1.01 * alone
