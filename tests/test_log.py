"""Log sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sortlane.operators import order
from sortlane.session import work_path
from sortlane.sinks import publish
from sortlane.sources import fixtures, generate
from sortlane.sources import log as logsrc
from sortlane.operators import checks


def test_generator_independent_of_partitioning(spark):
    a = generate.generate_records(spark, 2000, seed=7, num_partitions=1)
    b = generate.generate_records(spark, 2000, seed=7, num_partitions=9)
    assert rows(a) == rows(b)
    c = generate.generate_records(spark, 2000, seed=8, num_partitions=3)
    assert rows(a) != rows(c)


def test_generator_meets_record_contract(spark):
    recs = generate.generate_records(spark, 5000, seed=3)
    log = publish.publish_balanced(recs, "source", order=["rid"])
    assert {r["rule"]: r["violations"] for r in checks.check_schema(log).collect()} == {
        "field_count": 0, "name_length": 0, "address_length": 0, "continent_domain": 0}
    assert all(r["violations"] == 0 for r in checks.check_charset(recs).collect())
    assert recs.select("continent").distinct().count() == 6


def test_publish_balanced_sizes_and_dense_offsets(spark):
    recs = fixtures.records(spark, SF_SMALL)
    log = publish.publish_balanced(recs, "source", partitions=4)
    offs = logsrc.topic_offsets(log).collect()
    sizes = [r["n"] for r in offs]
    assert max(sizes) - min(sizes) <= 1
    assert all(r["first_offset"] == 0 and r["next_offset"] == r["n"] for r in offs)


def test_publish_hash_keyed_colocates_keys(spark):
    recs = fixtures.records(spark, SF_SMALL)
    log = publish.publish_hash_keyed(recs, "name", "name", ["rid"])
    assert log.groupBy("key").agg(F.countDistinct("partition").alias("p")).where("p > 1").count() == 0
    offs = logsrc.topic_offsets(log).collect()
    assert all(r["first_offset"] == 0 and r["next_offset"] == r["n"] for r in offs)


def test_publish_sorted_orders_within_and_across(spark):
    recs = fixtures.records(spark, SF_SMALL)
    srt = order.sort_records(recs, "name", ["rid"], total_col="_total")
    log = publish.publish_sorted(srt, "name")
    res = {(r["scope"]): r["violations"] for r in checks.check_sorted(log, "name").collect()}
    assert res == {"within": 0, "across": 0}
    sizes = [r["n"] for r in logsrc.topic_offsets(log).collect()]
    assert max(sizes) - min(sizes) <= 1


def test_first_n_and_resume_partition_the_topic(spark):
    log = fixtures.log(spark, SF_SMALL)
    total = log.count()
    for n in (0, 1, 250, 251, total, total + 5):
        first = logsrc.read_first_n(log, "source", n)
        assert first.count() == min(n, total)
        committed = logsrc.commit_offsets(first, "g")
        rest = logsrc.read_resume(log, committed, "g")
        assert first.count() + rest.count() == total
        assert first.join(rest, ["partition", "offset"]).count() == 0


def test_head_is_first_k_in_order(spark):
    log = fixtures.log(spark, SF_SMALL)
    got = [(r["partition"], r["offset"]) for r in logsrc.head(log, "source", 10).collect()]
    assert got == [(0, i) for i in range(10)]


def test_read_lines_keeps_blank_and_cr(spark):
    path = work_path(spark, "lines-test")
    df = spark.createDataFrame([("1,a,b,c\r",), ("",), ("2,a\rb,c,d",)], "value string")
    publish.export_lines(df.coalesce(1), path)
    got = sorted(r[0] for r in logsrc.read_lines(spark, path).collect())
    assert got == sorted(["1,a,b,c\r", "", "2,a\rb,c,d"])


def test_idempotent_republish(spark):
    recs = fixtures.records(spark, SF_SMALL)
    msgs = order.stage(publish.publish_balanced(recs, "source", order=["rid"]))
    base = work_path(spark, "idem-test")
    publish.publish_idempotent(msgs.unionByName(msgs.withColumn("topic", F.lit("name"))), base, 9)
    publish.publish_idempotent(msgs, base, 9)  # a retry without the name topic leaves none of it
    back = publish.read_published(spark, base)
    assert rows(back, "topic", "partition", "offset", "value") == rows(msgs, "topic", "partition", "offset", "value")
    short = msgs.where("offset < 3")
    publish.publish_idempotent(short, base, 10)  # by number, not as text, and without the longer run's tail
    back = publish.read_published(spark, base)
    assert rows(back, "partition", "offset", "value") == rows(short, "partition", "offset", "value")
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()
    # A run whose manifest is missing isn't seen.
    short.limit(1).write.partitionBy("topic").parquet(f"{base}/run=11")
    assert publish.read_published(spark, base).count() == short.count()


def test_first_n_with_gaps_is_exact(spark):
    log = fixtures.log(spark, SF_SMALL).withColumn("offset", F.col("offset") * 10 + F.col("partition"))
    want = sorted((r["partition"], r["offset"]) for r in log.select("partition", "offset").collect())
    for n in (0, 1, 3, 300, 999, 5000):
        for block in (7, 64, 1 << 16):
            got = sorted((r["partition"], r["offset"]) for r in logsrc.read_first_n(log, "source", n, block).collect())
            assert got == want[:n]


def test_generator_letters_are_equally_likely(spark):
    recs = generate.generate_records(spark, 60000, seed=1)
    letters = {r[0]: r[1] for r in recs.select(F.explode(F.split(F.substring("name", 1, 10), "")).alias("c")).where(
        "c <> ''").groupBy("c").count().collect()}
    assert len(letters) == 26
    mean = sum(letters.values()) / 26
    assert max(abs(v / mean - 1) for v in letters.values()) < 0.025
    symbols = {r[0]: r[1] for r in recs.select(F.explode(F.split(F.substring("address", 1, 15), "")).alias("c")).where(
        "c <> ''").groupBy("c").count().collect()}
    assert len(symbols) == 63
    mean = sum(symbols.values()) / 63
    assert max(abs(v / mean - 1) for v in symbols.values()) < 0.04


def test_kafka_edges_on_static_frames(spark):
    src = spark.createDataFrame(
        [("id", 1, 5, bytearray(b"k"), bytearray("é,1".encode())), ("id", 0, 7, None, bytearray(b"x"))],
        "topic string, partition int, offset long, key binary, value binary").withColumn(
        "timestamp", F.current_timestamp()).withColumn("timestampType", F.lit(0))
    log = logsrc.kafka_to_log(src)
    assert log.columns == ["topic", "partition", "offset", "key", "value"]
    assert sorted((r["partition"], r["offset"], r["key"], r["value"]) for r in log.collect()) == [
        (0, 7, None, "x"), (1, 5, "k", "é,1")]
    recs = fixtures.records(spark, SF_SMALL)
    sorted_log = publish.publish_sorted(order.sort_records(recs, "name", ["rid"], total_col="_total"), "name")
    out = publish.log_to_kafka(sorted_log)
    assert dict(out.dtypes) == {"topic": "string", "partition": "int", "key": "binary", "value": "binary"}
    # Each Kafka partition is written by one task, in offset order.
    sent = out.select("partition", F.col("value").cast("string").alias("value"), F.spark_partition_id().alias("task"),
                      F.monotonically_increasing_id().alias("at")).collect()
    want = {}
    for r in sorted(sorted_log.collect(), key=lambda r: r["offset"]):
        want.setdefault(r["partition"], []).append(r["value"])
    for p, values in want.items():
        mine = sorted((r for r in sent if r["partition"] == p), key=lambda r: r["at"])
        assert len({r["task"] for r in mine}) == 1 and [r["value"] for r in mine] == values
