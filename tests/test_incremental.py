"""Incremental validation: any cut of a log gives what a full validation gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sortlane.operators import incremental
from sortlane.operators.checks import validate_all
from sortlane.operators.incremental import Node, Validator, block_summaries, fold_partitions
from sortlane.plans.batch import run_batch
from sortlane.session import list_folder, work_path
from sortlane.sources import fixtures


@pytest.fixture(scope="module")
def log(spark):
    return run_batch(spark, fixtures.dirty_log(spark, SF_SMALL), on_error="skip").log(spark).cache()


def upto(log, cuts):
    """The part of the log below an offset of each (topic, partition)."""
    keep = F.lit(False)
    for (t, p), o in cuts.items():
        keep = keep | ((F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") < o))
    return log.where(keep)


def faulty(log):
    """Swapped and changed values, a lost line and a bad line."""
    bad = F.when((F.col("topic") == "id") & (F.col("partition") == 1) & (F.col("offset") == 30), F.lit("5,aa,bb,Asia"))
    bad = bad.when((F.col("topic") == "name") & (F.col("offset") == 0) & (F.col("partition") == 2), F.lit("1,a,b,Asia"))
    bad = bad.when((F.col("topic") == "continent") & (F.col("offset") == 7), F.lit("not a record"))
    return log.withColumn("value", F.coalesce(bad, "value")).where("topic != 'id' OR partition != 3 OR offset < 100")


@pytest.mark.parametrize("broken", [False, True])
@pytest.mark.parametrize("block", [16, 1 << 16])
def test_equals_full_validation_for_any_growth(spark, log, broken, block):
    rng = random.Random(block)
    log = faulty(log) if broken else log
    ends = {(r["topic"], r["partition"]): r["n"] for r in log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("n")).collect()}
    v, cuts = Validator(work_path(spark, "validator"), block), dict.fromkeys(ends, 0)
    for _ in range(3):
        cuts = {k: min(n, cuts[k] + rng.choice([0, 0, 1, rng.randrange(n + 1)])) for k, n in ends.items()}
        part = upto(log, cuts)
        assert rows(v.validate(spark, part)) == rows(validate_all(spark, part))
    got = rows(v.validate(spark, log))
    assert got == rows(validate_all(spark, log))
    assert any(not r[3] for r in got) and (broken == any(r[0] == "sorted_id" and not r[3] for r in got))


def test_only_new_offsets_reach_the_scan(spark, log):
    path = work_path(spark, "log")
    half = log.where("topic = 'id' AND offset < 40")
    half.write.parquet(path)
    v = Validator(work_path(spark, "validator"), 16)
    nodes = v.advance(spark, spark.read.parquet(path))
    assert sum(n.n for n in nodes["id"].values()) == half.count()
    log.where("topic = 'id' AND offset >= 40").write.mode("append").parquet(path)
    grown = spark.read.parquet(path)
    fresh = v.unread(grown, nodes)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,40)" in plan[plan.index("PushedFilters"):]
    assert fresh.count() == grown.where("offset >= 40").count()
    v.advance(spark, grown)
    leaves = v.leaves(spark)
    assert {r["version"]: r["lo"] for r in leaves.groupBy("version").agg(F.min("first_offset").alias("lo")).collect()} == {0: 0, 1: 40}
    # Each message is in one leaf.
    assert leaves.agg(F.sum("n")).first()[0] == grown.count()


def test_a_call_without_news_changes_nothing(spark, log):
    v = Validator(work_path(spark, "validator"))
    v.advance(spark, log)
    number = v.state(spark)[0]
    v.advance(spark, log)
    assert v.state(spark)[0] == number == 0 and list_folder(spark, f"{v.folder}/leaves") == ["version=0"]
    assert rows(Validator(work_path(spark, "none")).validate(spark, log.limit(0))) == rows(validate_all(spark, log.limit(0)))


def test_a_crash_before_the_version_is_read_again(spark, log, monkeypatch):
    v, create = Validator(work_path(spark, "validator")), incremental.create_state
    monkeypatch.setattr(incremental, "create_state", lambda *a: (_ for _ in ()).throw(OSError("planted")))
    with pytest.raises(OSError):
        v.advance(spark, log.where("offset < 50"))
    monkeypatch.setattr(incremental, "create_state", create)
    assert v.state(spark) == (-1, {})
    assert rows(v.validate(spark, log)) == rows(validate_all(spark, log))


def test_folding_is_associative(spark, log):
    """Leaves of any size fold to the same nodes, by Spark's fold and by ``Node.then``."""
    want = None
    for block in (1, 3, 50, 1 << 16):
        leaves = block_summaries(log, block)
        got = rows(fold_partitions(leaves).withColumn("first", F.to_json("first")).withColumn("last", F.to_json("last")))
        want = want or got
        assert got == want
    by = {}
    for r in block_summaries(log, 7).orderBy("topic", "partition", "blk").collect():
        key = lambda k: None if k is None else [k["text"], k["id"]]
        node = Node(r["next_offset"], r["n"], str(r["h1"]), str(r["h2"]), r["descents"], key(r["first"]), key(r["last"]),
                    [r[x] for x in incremental.RULES])
        at = (r["topic"], r["partition"])
        by[at] = by[at].then(node) if at in by else node
    for r in fold_partitions(block_summaries(log)).collect():
        n = by[r["topic"], r["partition"]]
        assert (n.n, n.h1, n.h2, n.descents, n.next_offset) == (r["n"], str(r["h1"]), str(r["h2"]), r["descents"], r["next_offset"])
