"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up (compiled code, file cache), then $BENCH_REPS
times; the median is reported. Queries that read stored pages, messages or
tables write fresh ones in each run; that time is taken off and reported by
itself (`fixtures`), so `queries` holds the work of the library alone. Results
are forced with the `noop` sink (full execution, nothing collected to the
driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harborline.plans import fixtures  # noqa: E402
from harborline.plans.catalog import QUERIES  # noqa: E402
from harborline.session import local_session  # noqa: E402

HEADLINE = ["upsert_ports", "upsert_chokepoints", "upsert_master", "upsert_duplicates", "backfill_ports",
            "stat_scan", "page_stop", "zone_filter", "zone_filter_grid", "ais_summary",
            "ais_summary_stream", "stats_read", "sql_latest", "page_slice", "master_scan", "backfill_job",
            "upsert_narrow", "page_seek", "stats_by_id", "zone_traffic", "ais_distinct_stream", "incremental_job"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    times, stands, errors = {}, {}, {}
    for name in names:
        fn = QUERIES[name]
        runs, writes = [], []
        try:
            for i in range(reps + 1):
                t0, w0 = time.perf_counter(), fixtures.written_seconds
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    writes.append(fixtures.written_seconds - w0)
                    runs.append(time.perf_counter() - t0 - writes[-1])
            times[name] = round(statistics.median(runs), 3)
            stands[name] = round(statistics.median(writes), 3)
        except Exception as e:  # report and go on with the other queries
            times[name] = None
            errors[name] = str(e)[:300]
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {"metric": "sum_of_median_query_seconds",
           "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "fixtures": stands, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": int(cpus), "reps": reps, "spark": spark.version,
           "machine": platform.machine(), "python": platform.python_version()}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
