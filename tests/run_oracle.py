"""Compare every registered query with its oracle: python tests/run_oracle.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402
from oracle import compare  # noqa: E402

from sortlane.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8, 8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"{name:28s} rows-only  rows={n} {time.time()-t:.1f}s", flush=True)
            continue
        try:
            problems, n = compare(spark, name, fn, sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            problems, n = [f"error: {type(exc).__name__}: {str(exc)[:400]}"], -1
        status = "OK" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{name:28s} {status:5s} rows={n} {time.time()-t:.1f}s {'; '.join(problems)}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
