"""Headline timings: prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to restrict), BENCH_GEN_ROWS (generated rows for
the generate-and-sort run; default = lineitem row count of the scale).
Every query is fully executed into the ``noop`` sink (nothing is collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sortlane.operators.checks import validate_all  # noqa: E402
from sortlane.plans import catalog  # noqa: E402
from sortlane.plans.batch import run_batch  # noqa: E402
from sortlane.session import local_session  # noqa: E402
from sortlane.sources import fixtures  # noqa: E402


def _sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = {q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q}
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="sortlane-bench")

    def gen_and_sort(spark, sf):
        n = int(os.environ.get("BENCH_GEN_ROWS", "0")) or fixtures.read_table(spark, sf, "lineitem").count()
        run = run_batch(spark, records=n)
        return run.log(spark).where(F.col("topic") != "source")

    built = {}

    def batch_job(spark, sf):
        built["log"] = run_batch(spark, fixtures.log(spark, sf)).log(spark)
        return built["log"]

    def validate(spark, sf):
        """All checks over the log that ``batch_job`` built; building it is not in this time."""
        if "log" not in built:
            batch_job(spark, sf)
        return validate_all(spark, built["log"])

    plan = {
        "sort_by_id": catalog.q_sort_by_id,
        "sort_by_name": catalog.q_sort_by_name,
        "sort_by_continent": catalog.q_sort_by_continent,
        "sort_fanout": catalog.q_sort_fanout,
        "batch_job": batch_job,
        "generate_and_sort": gen_and_sort,
        "validate_all": validate,
        "stream_fanout": catalog.q_stream_fanout,
    }
    # Warm-up (reported separately): JVM start, first scans and code generation.
    t = time.time()
    smallest = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm_dir = smallest if os.path.isdir(smallest) else sf_dir
    _sink(catalog.q_sort_by_name(spark, warm_dir))
    _sink(catalog.q_decode_tolerant(spark, warm_dir))
    warmup = round(time.time() - t, 3)

    timings: dict[str, float] = {}
    for name, fn in plan.items():
        if only and name not in only:
            continue
        t = time.time()
        _sink(fn(spark, sf_dir))
        timings[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "warmup_sec": warmup,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
