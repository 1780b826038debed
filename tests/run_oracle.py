"""Run driver queries against their DuckDB oracles: python -m tests.run_oracle [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewright.session import get_session  # noqa: E402
from tests.oracle_util import compare, duck  # noqa: E402


def main(argv):
    import __spark_entry__ as se
    sf = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    qs, sqls = se.queries(), se.oracle_sql()
    names = argv or list(qs)
    fails = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, sf)
            if n in sqls:
                ok, msg = compare(df, con, sqls[n])
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as e:  # report and continue
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        fails += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n:28s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(names) - fails}/{len(names)} passed")
    return 1 if fails else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
