"""The pipeline's near-duplicates are linked from 0.8 on."""

import random

import corpus_pipeline as cp
import pytest
from conftest import SF_SMALL
from helpers import DOC_SCHEMA

from sortlane.llm import dedup


def grams(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def groups(seed):
    """Chains of texts that each change a place or two of their predecessor, most at 0.75 to 0.9."""
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        text = [f"g{g}w{rng.randrange(10 ** 6)}" for _ in range(60)]
        for _ in range(10):
            rows.append((len(rows) + 1, " ".join(text)))
            text = text.copy()
            for _ in range(rng.choice((1, 1, 2))):
                text[rng.choice((0, 1, 2, 3, 20, 40, 57, 58, 59))] = f"x{rng.randrange(10 ** 6)}"
    return rows


def lowest(rows, percent):
    sets, low = [grams(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    return sorted(rows[i][0] for i in range(len(rows)) if find(i) == i)


@pytest.mark.parametrize("region", [1024, 2])
def test_links_from_eighty_percent_on(spark, monkeypatch, region):
    monkeypatch.setattr(dedup, "REGION_ROWS", region)
    rows = groups(5)
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], DOC_SCHEMA).repartition(3)
    want = lowest(rows, 80)
    assert sorted(r.doc_id for r in cp.near_dedup(spark, docs, SF_SMALL).collect()) == want
    assert len(want) < len(lowest(rows, 85))


def test_depth_by_threshold():
    assert dedup.deepest(85) == dedup.LEVELS and dedup.deepest(80) == 6
