"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is run to completion through Spark's ``noop`` sink, which
computes every row and column without collecting anything to the driver.
One untimed warm-up run of the flagship on the smallest data set loads the
JVM code paths first; deriving the domain tables from the driver's tables
(the stand-in for loading the source tables) is reported as ``setup_sec``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from coursematch.config import build_session
    from coursematch.queries import QUERIES

    names = sys.argv[1:] or list(QUERIES)
    scratch = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    spark = build_session(f"local[{cpus}]", max(cpus, 8), app_name="coursematch-bench",
                          extra={"spark.local.dir": scratch})

    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        QUERIES["course_match"](spark, warm).write.format("noop").mode("overwrite").save()

    # Setup (untimed in "value"): derive the domain tables from the driver's
    # tables and store them, as loading the source tables would.
    from coursematch.sources.derive import domain
    t0 = time.perf_counter()
    domain(spark, sf_dir).load()
    setup = round(time.perf_counter() - t0, 3)

    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)  # some stage tables while they are built: timed
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "all_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "setup_sec": setup,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
