"""Checks are green on a correct published log and red on each planted fault."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sortlane.operators import checks, order
from sortlane.plans.batch import run_batch


@pytest.fixture(scope="module")
def good_log(spark):
    run = run_batch(spark, ids=spark.range(0, 3000).withColumnRenamed("id", "rid"), seed=11)
    assert run.counters["generated"] == run.counters["consumed"] == 3000
    assert run.counters["sorted"] == run.counters["produced"] == 9000
    return order.stage(run.log(spark), "good-log")


def _failing(spark, log):
    out = checks.validate_all(spark, log, block=64)
    return {(r["check"], r["scope"]) for r in out.where(~F.col("ok")).collect()}


def test_clean_log_passes_everything(spark, good_log):
    assert _failing(spark, good_log) == set()


def _rows(log, topic, partition):
    return sorted(log.where((F.col("topic") == topic) & (F.col("partition") == partition)).collect(),
                  key=lambda r: r["offset"])


def _replace(spark, log, topic, partition, new_rows):
    keep = log.where(~((F.col("topic") == topic) & (F.col("partition") == partition)))
    return keep.unionByName(spark.createDataFrame(new_rows, log.schema))


def _id(v):
    return int(v.split(",")[0])


def test_swapped_neighbours(spark, good_log):
    rs = _rows(good_log, "id", 0)
    i = next(i for i in range(len(rs) - 1) if _id(rs[i]["value"]) < _id(rs[i + 1]["value"]))
    vals = [r["value"] for r in rs]
    vals[i], vals[i + 1] = vals[i + 1], vals[i]
    bad = _replace(spark, good_log, "id", 0, [r.asDict() | {"value": v} for r, v in zip(rs, vals)])
    assert ("sorted_id", "id:within") in _failing(spark, bad)


def test_dropped_row(spark, good_log):
    bad = good_log.where(~((F.col("topic") == "name") & (F.col("partition") == 1) & (F.col("offset") == 3)))
    fails = _failing(spark, bad)
    assert ("counts", "name") in fails and ("permutation", "name") in fails


def test_duplicated_row(spark, good_log):
    dup = good_log.where((F.col("topic") == "continent") & (F.col("offset") == 0) & (F.col("partition") == 2))
    fails = _failing(spark, good_log.unionByName(dup))
    assert ("counts", "continent") in fails and ("permutation", "continent") in fails


def test_replaced_value_keeps_count(spark, good_log):
    rs = _rows(good_log, "continent", 3)
    rows = [r.asDict() for r in rs]
    rows[5]["value"] = rows[4]["value"]  # order still holds, content does not
    fails = _failing(spark, _replace(spark, good_log, "continent", 3, rows))
    assert ("permutation", "continent") in fails and ("counts", "continent") not in fails


def test_reversed_id_tiebreak(spark, good_log):
    rs = [r.asDict() for r in _rows(good_log, "name", 0)]
    # a run of equal names is rare in random names; plant one: copy one name onto two rows
    a, b = rs[10], rs[11]
    fa, fb = a["value"].split(","), b["value"].split(",")
    if _id(a["value"]) == _id(b["value"]):
        pytest.skip("equal ids")
    lo, hi = sorted([fa, fb], key=lambda f: int(f[0]))
    a["value"] = ",".join([hi[0], fa[1], hi[2], hi[3]])  # same name, larger id first
    b["value"] = ",".join([lo[0], fa[1], lo[2], lo[3]])
    fails = _failing(spark, _replace(spark, good_log, "name", 0, rs))
    assert ("sorted_name", "name:within") in fails


def test_swapped_partitions_breaks_only_the_seam(spark, good_log):
    swapped = good_log.withColumn("partition", F.when(
        F.col("topic") == "id",
        F.when(F.col("partition") == 0, 1).when(F.col("partition") == 1, 0).otherwise(F.col("partition")),
    ).otherwise(F.col("partition")))
    fails = _failing(spark, swapped)
    assert ("sorted_id", "id:across") in fails and ("sorted_id", "id:within") not in fails


def test_removed_topic(spark, good_log):
    fails = _failing(spark, good_log.where(F.col("topic") != "continent"))
    assert ("topics", "continent") in fails


def test_detect_runs_counts_descents(spark):
    vals = [1, 2, 2, 1, 5, 0, 0, 3]
    df = spark.createDataFrame([("t", 0, i, None, f"{v},a,b,c") for i, v in enumerate(vals)],
                               "topic string, partition int, offset bigint, key string, value string")
    for block in (2, 3, 100):
        got = sorted((r["run_no"], r["first_offset"], r["last_offset"], r["n"])
                     for r in checks.detect_runs(df, "id", block).collect())
        assert got == [(0, 0, 2, 3), (1, 3, 4, 2), (2, 5, 7, 3)]


def test_order_check_block_size_invariant(spark, good_log):
    shuffled = good_log.where(F.col("topic") == "id").withColumn(
        "offset", (F.col("offset") * 7919) % 1000003)
    want = {(r["topic"], r["scope"], r["violations"]) for r in checks.check_sorted(shuffled, "id").collect()}
    for block in (1, 5, 64):
        got = {(r["topic"], r["scope"], r["violations"]) for r in checks.check_sorted(shuffled, "id", block).collect()}
        assert got == want


def test_only_the_keys_topic_is_read(spark, good_log):
    assert {r["topic"] for r in checks.check_sorted(good_log, "id").collect()} == {"id"}


def test_missing_and_empty_topics(spark, good_log):
    gone = good_log.where(F.col("topic") != "name")
    row = checks.count_reconcile(gone).where("topic = 'name'").first()
    assert (row["n"], row["n_source"], row["ok"]) == (0, 3000, False)
    empty = good_log.limit(0)
    there = checks.REQUIRED_TOPICS
    assert checks.validate_all(spark, empty, existing=there).where(~F.col("ok")).count() == 0
    assert {r["topic"]: r["present"] for r in checks.check_topics(spark, empty, existing=["id"]).collect()} == {
        "source": False, "id": True, "name": False, "continent": False}


def test_fingerprint_sums_differ_independently(spark):
    rows = [("t", 0, i, None, v) for i, v in enumerate(["a", "b"])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string")
    r = checks.multiset_fingerprint(df, ["t"]).first()
    assert r["n"] == 2 and r["h1"] != r["h2"]
