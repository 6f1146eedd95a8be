"""Global position (E6), sorts (E1-E3, E7), runs (E4, E5) and plan shape."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sortlane.operators import order, runs
from sortlane.sources import fixtures


def _truth(df, order_cols):
    w = Window.orderBy(*order_cols)  # test oracle only: single-task window on small data
    return df.withColumn("pos", F.row_number().over(w) - 1)


@pytest.mark.parametrize("buckets", [1, 4, 13])
def test_position_invariant_to_bucket_count(spark, buckets):
    recs = fixtures.records(spark, SF_SMALL)
    got = order.sort_records(recs, "name", ["rid"], num_buckets=buckets)
    want = _truth(recs, ["name", "id", "rid"])
    assert rows(got, "rid", "pos") == rows(want, "rid", "pos")


@pytest.mark.parametrize("key,cols", [("id", ["id", "rid"]), ("continent", ["continent", "id", "rid"])])
def test_sort_keys(spark, key, cols):
    recs = fixtures.records(spark, SF_SMALL)
    got = order.sort_records(recs, key, ["rid"], total_col="n")
    assert rows(got, "rid", "pos") == rows(_truth(recs, cols), "rid", "pos")
    assert {r[0] for r in got.select("n").distinct().collect()} == {recs.count()}


def test_hot_key_still_spreads_and_orders(spark):
    # a third of the rows share one name: range cuts on (name, id, rid) split it
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("rid"), (F.col("id") % 7).cast("int").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("name"),
        F.lit("a").alias("address"), F.lit("Asia").alias("continent"))
    got = order.sort_records(df, "name", ["rid"], num_buckets=8)
    assert rows(got, "rid", "pos") == rows(_truth(df, ["name", "id", "rid"]), "rid", "pos")
    staged = df.repartitionByRange(8, "name", "id", "rid")
    sizes = [r[1] for r in staged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < n / 3  # the hot value does not land in one task


def test_empty_and_single_row(spark):
    schema = "rid bigint, id int, name string, address string, continent string"
    empty = spark.createDataFrame([], schema)
    out = order.sort_by_name(empty)
    assert out.count() == 0 and "pos" in out.columns
    one = spark.createDataFrame([(1, 2, "n", "a", "Asia")], schema)
    assert [r["pos"] for r in order.sort_by_name(one).collect()] == [0]


def test_all_equal_keys_use_tiebreak(spark):
    df = spark.range(500).select(F.col("id").alias("rid"), F.lit(1).alias("id"), F.lit("x").alias("name"),
                                 F.lit("a").alias("address"), F.lit("Asia").alias("continent"))
    got = order.sort_by_name(df)
    assert all(r["pos"] == r["rid"] for r in got.collect())


def test_with_index_is_dense(spark):
    df = spark.range(0, 1000, 1, 7)
    got = order.with_index(df, "idx")
    assert sorted(r["idx"] for r in got.collect()) == list(range(1000))


def test_fanout_has_three_orders(spark):
    recs = order.stage(fixtures.records(spark, SF_SMALL))
    out = order.sort_fanout(recs)
    assert {r[0]: r[1] for r in out.groupBy("sort_key").count().collect()} == \
        {k: recs.count() for k in ("id", "name", "continent")}


def test_unknown_sort_key_raises(spark):
    with pytest.raises(ValueError):
        order.sort_records(fixtures.records(spark, SF_SMALL), "address")


def _single_partition_outside_broadcast(plan: str) -> list[str]:
    """``Exchange SinglePartition`` lines over record-sized data.

    Allowed: under a broadcast (the small side of a join), or fed directly by
    an aggregate (a per-bucket / per-partition summary table).
    """
    lines = plan.splitlines()

    def depth(line: str) -> int:
        return len(line) - len(line.lstrip(" :+-|"))

    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        child = next((c for c in lines[i + 1:] if depth(c) > depth(line)), "")
        if "Aggregate" in child:
            continue
        d, under = depth(line), False
        for prev in reversed(lines[:i]):
            if depth(prev) < d:
                d = depth(prev)
                if "BroadcastExchange" in prev or "BroadcastQueryStage" in prev:
                    under = True
                    break
        if not under:
            bad.append(line)
    return bad


def test_plan_has_no_single_partition_over_records(spark):
    recs = fixtures.records(spark, SF_SMALL)
    df = order.sort_by_name(recs)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert _single_partition_outside_broadcast(plan) == []
    assert "BroadcastHashJoin" in plan
    log_plan = runs.sorted_runs(recs, "name", 100, ["rid"])._jdf.queryExecution().executedPlan().toString()
    assert _single_partition_outside_broadcast(log_plan) == []
    # the assertion does catch a single-task window over the records
    truth = _truth(recs, ["name", "id", "rid"])
    truth.collect()
    assert _single_partition_outside_broadcast(truth._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("chunk", [1, 7, 300, 10_000_000])
def test_merge_of_runs_equals_sort(spark, chunk):
    recs = fixtures.records(spark, SF_SMALL)
    r = runs.sorted_runs(recs, "name", chunk, ["rid"])
    # each run is sorted on its own and holds `chunk` consecutive rids
    by_run = {}
    for row in r.select("run_id", "pos", "name", "id", "rid", "seq").collect():
        by_run.setdefault(row["run_id"], []).append(row)
    for run_id, members in by_run.items():
        members.sort(key=lambda m: m["pos"])
        assert [m["pos"] for m in members] == list(range(len(members)))
        keys = [(m["name"], m["id"], m["rid"]) for m in members]
        assert keys == sorted(keys)
        assert all(m["seq"] // chunk == run_id for m in members)
    merged = runs.merge_runs(r, "name", ["rid"], "pos2")
    assert rows(merged, "rid", "pos2") == rows(order.sort_by_name(recs), "rid", "pos")


def test_position_with_coalesced_ranges(spark):
    """AQE merging adjacent range partitions keeps positions exact."""
    conf = {
        "spark.sql.shuffle.partitions": "50",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(40000).select(
            F.col("id").alias("rid"), (F.col("id") * 7919 % 1000).cast("int").alias("id"),
            F.concat(F.lit("n"), (F.col("id") % 97).cast("string")).alias("name"),
            F.lit("address-xxxxxxxxxxxxxxxx").alias("address"), F.lit("Asia").alias("continent"))
        got = order.sort_records(df, "name", ["rid"])
        buckets = got.sparkSession.read.parquet(got.inputFiles()[0].rsplit("/", 1)[0]).inputFiles()
        assert 1 < len(buckets) < 50  # some ranges merged, not all
        assert rows(got, "rid", "pos") == rows(_truth(df, ["name", "id", "rid"]), "rid", "pos")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_position_invariant_to_input_split(spark):
    recs = order.stage(fixtures.records(spark, SF_SMALL), "resplit")
    one = order.sort_by_continent(recs.coalesce(1))
    many = order.sort_by_continent(recs.repartition(11, "name"))
    assert rows(one, "rid", "pos") == rows(many, "rid", "pos")


def test_check_and_publish_plans_have_no_single_partition_over_records(spark):
    from sortlane.operators import checks
    from sortlane.sinks import publish
    recs = fixtures.records(spark, SF_SMALL)
    srt = order.sort_records(recs, "name", ["rid"], total_col="_total")
    log = publish.publish_sorted(srt, "name")
    for df in (log, checks.check_sorted(log, "name", block=64), checks.detect_runs(log, "name", block=64)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert _single_partition_outside_broadcast(plan) == [], plan
