"""DuckDB seconds of every report on a stored star: the yardstick for bench.py.

Usage: python tools/duckdb_bench.py [sf_dir]

Spark's reports read a star that was loaded before, so DuckDB gets the same: the
star tables are built once, then each report's SQL runs on them (best of three).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.oracle import STAR_CTES, report_sql  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem".split()
STAR = ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"SET threads = {os.environ.get('BENCH_CPUS', '8')}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    start = time.perf_counter()
    for t in STAR:
        con.execute(f"CREATE TABLE stored_{t} AS WITH {STAR_CTES} SELECT * FROM {t}")
    times = {"load_star": round(time.perf_counter() - start, 3)}
    for t in STAR:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM stored_{t}")
    for name, sql in report_sql().items():
        own = sql.replace(f"WITH RECURSIVE {STAR_CTES},", "WITH RECURSIVE ").replace(f"WITH RECURSIVE {STAR_CTES}", "")
        best = min(_timed(con, own) for _ in range(3))
        times[name] = round(best, 3)
    print(json.dumps({"engine": "duckdb " + duckdb.__version__, "sf_dir": sf_dir, "queries": times,
                      "value": round(sum(times.values()), 3)}))


def _timed(con, sql: str) -> float:
    start = time.perf_counter()
    con.execute(sql).fetchall()
    return time.perf_counter() - start


if __name__ == "__main__":
    main()
