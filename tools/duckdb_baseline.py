"""Single-node reference timings: DuckDB runs each registered query's oracle
SQL on the same parquet tables. Prints one JSON line like bench.py."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewright.driver_oracle import ORACLE  # noqa: E402
from tests.oracle_util import duck  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    con = duck(sf_dir)
    con.execute(f"SET threads={os.environ.get('BENCH_CPUS', '8')}")
    times = {}
    for name, sql in ORACLE.items():
        t0 = time.perf_counter()
        con.execute(f"SELECT count(*) FROM ({sql}) q").fetchall()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "duckdb_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf_dir": sf_dir}))


if __name__ == "__main__":
    main()
