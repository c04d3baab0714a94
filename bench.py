"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed end to end (``noop`` sink: the whole plan
runs, nothing is collected) once to warm up and then ``$BENCH_REPS`` times;
the median wall time is recorded. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import QUERIES  # noqa: E402
from tessera.session import local_session  # noqa: E402


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    event_log = os.environ.get("BENCH_EVENT_LOG")       # a folder; read with tools/stage_times.py
    spark = local_session(cpus, checkpoint_dir=os.path.join(scratch, "ckpt"), event_log_dir=event_log,
                          extra={"spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    times, errors = {}, {}
    for name in only or sorted(QUERIES):
        fn = QUERIES[name]
        spark.sparkContext.setJobGroup(name, name)
        try:
            run_once(spark, fn, sf_dir)
            times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(reps)), 4)
        except Exception as e:  # noqa: BLE001 - record and go on; the line is still printed
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
        print(f"{name}: {times.get(name, 'error')}", file=sys.stderr, flush=True)
    spark.stop()
    out = {"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "reps": reps, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
