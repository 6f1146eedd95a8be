"""The driver contract: entry smoke run and every registered query vs its oracle (sf0.001)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle import compare

#: Queries of this library; those of an installed subpackage have tests of their own.
NAMES = sorted(n for n, f in entry.queries().items() if f.__module__.startswith("sortlane.plans"))


def test_registry_is_consistent():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(NAMES) <= set(o)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["topic", "partition", "offset", "key", "value"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    fn = entry.queries()[name]
    problems, n = compare(spark, name, fn, entry.oracle_sql()[name], SF_SMALL)
    assert not problems, problems
