"""Time the DuckDB oracle statements (single-node context for bench.py).

    python -m checks.oracle_bench [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import json
import statistics
import time

from checks.compare import oracle_connection
from checks.oracle_sql import ORACLE


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--repeats", type=int, default=3)
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    con = oracle_connection(args.sf_dir)
    out = {}
    for name in args.names or list(ORACLE):
        sql = ORACLE[name]
        con.sql(sql).fetchall()  # warm-up
        runs = []
        for _ in range(args.repeats):
            t0 = time.perf_counter()
            con.sql(sql).fetchall()
            runs.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(runs), 3)
    print(json.dumps({"engine": "duckdb", "sf_dir": args.sf_dir, "queries": out}))


if __name__ == "__main__":
    main()
