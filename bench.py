"""Benchmark: the six check suites over the driver tables.

Runs every suite of the fixture catalog (the same six the replaced system
times) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line. The headline value is a full
run through ``run()`` — all six suites with shared table scans, in a few
checkpointed stages — the counterpart of the published run-everything total.
The same checks as one lazy plan, and each suite on its own, are also timed.
Times are end to end (plan construction included), best of
``$BENCH_REPEATS`` after one warm-up run of the whole thing.
"""

from __future__ import annotations

import gc
import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from verisift.operators import joins, profile  # noqa: E402
from verisift.operators.rollup import suite_rollup  # noqa: E402
from verisift.plans import catalog as C  # noqa: E402
from verisift.plans.fixtures import fixture_tables  # noqa: E402
from verisift.plans.suites import pattern_sub_results, run, suite_sub_results  # noqa: E402
from verisift.session import local_session  # noqa: E402


def suites(t):
    cat = C.CATALOG
    return {
        "null_columns": lambda: profile.null_columns_sub_results(t, cat.null_tables),
        "empty_tables": lambda: profile.empty_tables_sub_results(t, cat.empty_tables, cat.empty_exclude),
        "column_completeness": lambda: profile.column_completeness_sub_results(t, cat.completeness),
        "referential_integrity": lambda: joins.referential_sub_results(t, cat.relationships),
        "person_patterns": lambda: pattern_sub_results(t, cat.patterns),
        "concept_mapping": lambda: joins.concept_sub_results(t, cat.concepts, cat.terminology),
    }


def timed(fn, repeats: int):
    best = None
    for _ in range(repeats):
        gc.collect()  # release gateway references left by earlier plans before timing
        t0 = time.perf_counter()
        rows = fn().collect()
        dt = time.perf_counter() - t0
        if os.environ.get("BENCH_VERBOSE"):
            print(f"  {dt:.3f}s", file=sys.stderr)
        best = dt if best is None else min(best, dt)
    return best, rows


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8))
    t = fixture_tables(spark, sf_dir)

    # Warm-up: the whole run once.
    run(t, C.CATALOG)["suites"].collect()

    # Headline first: run() -- all six suites in a few checkpointed stages.
    full, _ = timed(lambda: run(t, C.CATALOG)["suites"], repeats)
    one_job, _ = timed(lambda: suite_rollup(suite_sub_results(t, C.CATALOG)), repeats)
    times, tests = {"run_all": round(full, 3), "all_suites_one_lazy_plan": round(one_job, 3)}, {}
    for name, fn in suites(t).items():
        sec, rows = timed(fn, repeats)
        times[name] = round(sec, 3)
        tests[name] = len(rows)
    times["sum_of_separate_suites"] = round(sum(times[k] for k in tests), 3)
    print(
        json.dumps(
            {
                "metric": "run_all_suites_seconds",
                "value": round(full, 3),
                "unit": "sec",
                "queries": times,
                "data_tests": tests,
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
