"""Benchmark: run the registered queries at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]`` and print one JSON line.

Each query is planned and executed to completion through the ``noop`` sink
(no rows are pulled into Python); queries that write (sinks) include their
writes. ``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablepipe import plans  # noqa: E402
from tablepipe.session import build_session  # noqa: E402


def run_once(spark, fn, sf):
    t0 = time.perf_counter()
    df = fn(spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = set(a for a in sys.argv[1:])
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = plans.queries()
    for warm in ("measure_pivot", "conflict_append", "html_table_rows"):  # JIT, Python workers
        run_once(spark, qs[warm], sf)
    times, errors = {}, {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            runs = [run_once(spark, fn, sf) for _ in range(reps)]
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # noqa: BLE001 - report, keep measuring the rest
            errors[name] = (str(e).splitlines() or [type(e).__name__])[0][:300]
    spark.stop()
    sf_label = os.path.basename(sf).replace("sf", "")
    out = {"metric": "sum_of_query_medians", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf_label, "cpus": int(cpus), "reps": reps}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
