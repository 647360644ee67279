"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and then BENCH_RUNS times, of which the median counts. All rows
are produced (``noop`` sink); nothing is collected.
"""

from __future__ import annotations

import json
import os
import pathlib
import statistics
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from statlake.queries import QUERIES  # noqa: E402
from statlake.session import local_session  # noqa: E402


# These look at the other outputs of the job that ``crawl_job_progress`` runs, so it has warmed up.
SAME_JOB = {"crawl_job_stats", "crawl_job_export", "crawl_job_rejected"}


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)
    spark = local_session(cpus, "statlake-bench")
    times, failed = {}, {}
    for name in names:
        try:
            if name not in SAME_JOB:
                seconds(spark, name, sf_dir)
            times[name] = round(
                statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3
            )
        except Exception as exc:
            failed[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}"
        print(f"{name} {times.get(name, failed.get(name))}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": pathlib.Path(sf_dir).name,
        "cpus": cpus,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
