import zlib
from collections import Counter

import numpy as np
from helpers import no_docs, odd_docs

from sortlane.llm import sharding


def docs(spark, n):
    return spark.createDataFrame([(i, f"text {i} é") for i in range(n)], "doc_id bigint, text string")


def test_exact_sizes_gapless_slots_and_reruns(spark):
    frame = docs(spark, 1003)
    rows = sharding.shard_documents(frame).collect()
    count = Counter(r.shard for r in rows)
    assert set(count) == set(range(24)) and max(count.values()) - min(count.values()) <= 1
    for s in range(24):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))
    for r in rows:
        raw = f"text {r.doc_id} é".encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw) and r.law == "rows" and r.grown_shard is None
    again = sharding.shard_documents(frame.repartition(5)).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in rows) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_matrix_has_the_margins():
    m = sharding.communication_matrix([5, 0, 17, 8], [10, 10, 10], 1)
    assert m.sum(axis=1).tolist() == [5, 0, 17, 8] and m.sum(axis=0).tolist() == [10, 10, 10]
    assert sharding.shard_sizes(7, 3).tolist() == [3, 2, 2]


def test_every_place_is_about_equally_likely(spark):
    hits, order = np.zeros((12, 3)), np.zeros(3)
    frame = docs(spark, 12)
    key = sharding.digest(frame).cache()
    for seed in range(40):
        got = sharding.uniform_shards(key, ["doc_id", "text_crc32"], 3, seed * 10).collect()
        for r in got:
            hits[r.doc_id, r.shard] += 1
            order[r.shard] += r.slot * (r.doc_id < 6)
    assert np.abs(hits / 40 - 1 / 3).max() < 0.35
    chi = ((hits - 40 / 3) ** 2 / (40 / 3)).sum()
    assert chi < 60  # 22 degrees of freedom


def test_odd_rows(spark):
    rows = sharding.shard_documents(odd_docs(spark)).collect()
    assert len(rows) == 11 and len({(r.shard, r.slot) for r in rows}) == 11
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(8, 0)}
    assert sharding.shard_documents(no_docs(spark)).count() == 0


def test_written_shards_hold_whole_rows(spark, tmp_path):
    frame = docs(spark, 100)
    sharding.write_shards(frame, str(tmp_path / "s"), shards=4)
    got = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(map(tuple, frame.collect()))
    assert sorted(r["count"] for r in got.groupBy("shard").count().collect()) == [25, 25, 25, 25]
