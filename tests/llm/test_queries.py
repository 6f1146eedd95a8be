"""Every registered query of the subpackage: its columns, and its SQL where there is one."""

import pytest
from conftest import SF_SMALL
from oracle import compare

from sortlane.llm import registry

COLUMNS = {
    "op1": ["doc_id", "n_shingles", "component_id", "kept"],
    "op3": ["doc_id", "size", "source_size", "target", "taken"],
    "op4": ["doc_id", "held_out", "score", "predicted"],
    "op6": ["query_id", "rank", "vec_id", "score"],
    "op7": ["doc_id", "held_out", "score", "predicted"],
    "op8": ["query_id", "rank", "vec_id", "score"],
    "op11": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12": ["lang", "source", "part", "item", "value", "rank"],
    "op13": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
}


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in registry.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, SF_SMALL)
    head = COLUMNS.get(name.split("_")[0], [])
    assert df.columns[:len(head)] == head
    if name in registry.oracle_sql():
        problems, n = compare(spark, name, registry.queries()[name], registry.oracle_sql()[name], SF_SMALL)
        assert not problems and n
    else:
        assert df.count() > 0
