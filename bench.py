"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query to completion (results written to Spark's ``noop`` sink, so nothing is pulled to
the driver) and prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Before timing, every query runs once on the smallest driver tables (``BENCH_WARMUP_DIR``,
default /root/testdata/sf0.001; set it empty to skip) so that JIT and code generation warm-up
is not counted.  Each query is then timed ``BENCH_REPEATS`` times (default 3) and its median is
reported; the single runs are listed under ``runs``.  Nothing is cached between runs: every run
reads its tables again.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kestrel.plans.catalog import QUERIES  # noqa: E402
from kestrel.session import local_session  # noqa: E402

HEADLINE = [
    "mention_rank", "mention_rank_full", "mention_index", "page_record_parse",
    "posting_parse", "qa_pairs", "qa_high_score", "stratified_sample",
    "kmeans_fit", "cluster_summary", "wide_table_read", "time_usage_grouped",
    "time_usage_grouped_typed",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # optional stage/task timings, written to a scratch folder
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * cpus), app="kestrel-bench", extra=extra)
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warmup_dir and os.path.isdir(warmup_dir):
        for name in names:
            try:
                run(spark, name, warmup_dir)
            except Exception:  # the timed run reports the failure
                pass
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    timings, runs, errors = {}, {}, {}
    for name in names:
        try:
            runs[name] = [round(run(spark, name, sf_dir), 3) for _ in range(repeats)]
            timings[name] = round(statistics.median(runs[name]), 3)
        except Exception as exc:  # keep the one-line JSON contract; report the failure
            timings[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(t for t in timings.values() if t is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeats": repeats,
        "runs": runs,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
