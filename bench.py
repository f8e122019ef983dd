"""Benchmark: ingest, warehouse load and every registered query on one data directory.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 2). Prints one JSON line: {"metric", "value" (sum of query
seconds), "unit", "queries": {name: seconds}, "sf", ...}. A query's time is the
best of its repeats; queries over five seconds run once. Reports are collected
(small results); table-sized outputs are forced with the no-op sink so nothing
large reaches the driver. The first runs of ingest and load are timed on their own.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from quarry.session import build_session
    scratch = tempfile.mkdtemp(prefix="quarry-bench-")
    spark = build_session(f"local[{cpus}]", app_name="quarry-bench",
                          extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                                 "spark.local.dir": f"{scratch}/local"})
    from quarry.plans import ingest, load
    from quarry.plans.etl_queries import ETL_QUERIES
    from quarry.plans.reports import REPORTS

    times: dict[str, float] = {}

    def timed(name, fn, again=0):
        best = None
        for _ in range(1 + again):
            t0 = time.perf_counter()
            fn()
            took = time.perf_counter() - t0
            best = took if best is None else min(best, took)
            if took > 5:
                break
        times[name] = round(best, 3)

    # warm the JVM and the file listing cache (not timed)
    spark.read.parquet(f"{sf_dir}/region.parquet").collect()

    timed("ingest", lambda: ingest.silver_for(spark, sf_dir))
    timed("load_star", lambda: load.star_for(spark, sf_dir))
    star = load.star_for(spark, sf_dir)
    for name, fn in REPORTS.items():
        if name.startswith("all_"):  # as many rows as the fact
            timed(name, lambda fn=fn: fn(star).write.format("noop").mode("overwrite").save(), repeats - 1)
        else:
            timed(name, lambda fn=fn: fn(star).collect(), repeats - 1)
    for name, fn in ETL_QUERIES.items():
        timed(name, lambda fn=fn: fn(spark, sf_dir).write.format("noop").mode("overwrite").save(), repeats - 1)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
        "sf": sf, "cpus": cpus, "engine": "spark-local", "repeats": repeats,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
