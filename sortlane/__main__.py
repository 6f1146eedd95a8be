"""Command line: ``python -m sortlane {batch,stream,validate} ...`` (or spark-submit).

Mirrors the original pipeline's switches: record count, run length,
streaming vs batch, continuous vs bounded, skip generation, skip sorting.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.checks import validate_all
from .plans.batch import run_batch
from .schema import DEFAULT_RUN_LENGTH, SORTED_TOPICS, SOURCE_TOPIC
from .session import ensure_checkpoint_dir
from .sinks.publish import publish_balanced, write_kafka
from .sinks.versions import publish_atomic
from .sources.generate import generate_records
from .sources.log import list_topics, read_kafka_log, read_log
from .streaming.runs import StreamRuns, start_stream


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sortlane")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="generate -> publish -> snapshot -> 3 sorts -> publish")
    b.add_argument("--records", type=int, default=50_000_000)
    b.add_argument("--seed", type=int, default=42)
    b.add_argument("--out", required=True, help="log table folder (shared storage)")
    b.add_argument("--source", help="existing log table to sort (implies --skip-generate)")
    b.add_argument("--skip-generate", action="store_true")
    b.add_argument("--skip-sort", action="store_true")
    b.add_argument("--on-error", choices=["fail", "skip"], default="fail")
    b.add_argument("--consume", type=int, help="snapshot exactly the first N available source messages")
    b.add_argument("--accept-short", action="store_true", help="go on with fewer than --consume messages")
    b.add_argument("--source-topic", default=SOURCE_TOPIC)
    b.add_argument("--sorted-topics", default=",".join(SORTED_TOPICS), help="names of the id, name and continent topics")
    b.add_argument("--buckets", type=int, help="sort buckets; size them so that one fits a task's memory")
    b.add_argument("--kafka", help="bootstrap servers: read the source topic from Kafka and publish the sorted topics there too")
    b.add_argument("--group", help="consumer group: resume after its committed offsets")
    b.add_argument("--offsets", help="table that gets a copy of the group's offsets")
    b.add_argument("--chunk", type=int, default=0,
                   help="accepted for compatibility: batch sorts are bounded by Spark's memory manager")
    s = sub.add_parser("stream", help="count-triggered sorted runs from arriving log files")
    s.add_argument("--source", required=True, help="folder of arriving log files, or a Kafka topic")
    s.add_argument("--kafka", help="bootstrap servers: read the source from Kafka")
    s.add_argument("--files-per-trigger", type=int, help="most files of a micro-batch (all new ones without it)")
    s.add_argument("--state", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--chunk", type=int, default=DEFAULT_RUN_LENGTH)
    s.add_argument("--continuous", action="store_true", help="processing-time trigger instead of availableNow")
    s.add_argument("--trigger", default="10 seconds")
    s.add_argument("--flush", action="store_true", help="publish open runs when the input is drained")
    v = sub.add_parser("validate", help="all checks over a log table")
    v.add_argument("--log", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("sortlane").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "batch":
        if args.skip_sort:
            recs = generate_records(spark, args.records, args.seed)
            publish_atomic(spark, args.out, {args.source_topic: publish_balanced(recs, args.source_topic, index="rid")})
            print(json.dumps({"generated": args.records}))
            return 0
        names = {"source_topic": args.source_topic, "sorted_topics": args.sorted_topics.split(","),
                 "num_buckets": args.buckets}
        if args.kafka or args.source or args.skip_generate:
            log = (read_kafka_log(spark, args.kafka, args.source_topic) if args.kafka
                   else read_log(spark, args.source or args.out))
            run = run_batch(spark, log, out=args.out, on_error=args.on_error, consume=args.consume,
                            on_short="accept" if args.accept_short else "fail", group=args.group,
                            offsets_path=args.offsets, **names)
        else:
            run = run_batch(spark, records=args.records, seed=args.seed, out=args.out, on_error=args.on_error, **names)
        if args.kafka:
            published = read_log(spark, args.out, version=run.version).where(F.col("topic").isin(*names["sorted_topics"]))
            write_kafka(published, args.kafka)
        print(json.dumps({"counters": run.counters, "stages": run.stages}))
    elif args.cmd == "stream":
        runner = StreamRuns(args.state, args.chunk)
        kafka = {"source_format": "kafka", "options": {"kafka.bootstrap.servers": args.kafka}} if args.kafka else {}
        query = start_stream(spark, args.source, runner, args.checkpoint, files_per_trigger=args.files_per_trigger,
                             available_now=not args.continuous, processing_time=args.trigger, **kafka)
        query.awaitTermination()
        if args.flush:
            runner.flush_open_runs(spark)
    else:
        out = validate_all(spark, read_log(spark, args.log), existing=list_topics(spark, args.log))
        bad = out.where(~F.col("ok")).collect()  # a few rows per topic
        for r in bad:
            print(json.dumps(r.asDict()))
        return 1 if bad else 0
    return 0


if __name__ == "__main__":
    sys.exit(main())
