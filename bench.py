"""Headline-query benchmark.

Runs the registered queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``; each query is built and
fully materialised through the ``noop`` sink: one warm-up run, then the
median of ``$BENCH_REPEATS`` (default 3).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_orders",
    "daily_sales_summary",
    "customer_metrics",
    "product_performance",
    "product_rank_global",
    "silver_accounts",
    "gold_country_analytics",
    "gold_size_analytics",
    "accounts_upsert",
]


# Settings that differ from ``strata.session.SCALE_SETTINGS`` for this run
# (override or extend with BENCH_CONF="key=value,key=value").
BENCH_SETTINGS: dict[str, str] = {}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE

    from strata.plans.queries import QUERIES
    from strata.session import build_session

    extra = dict(BENCH_SETTINGS)
    for item in filter(None, os.environ.get("BENCH_CONF", "").split(",")):
        key, _, value = item.partition("=")
        extra[key.strip()] = value.strip()
    spark = build_session(
        f"local[{cpus}]", app_name="strata-bench", shuffle_partitions=cpus, extra=extra
    )
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        build = QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()  # warm-up
        times[name] = round(statistics.median(run() for _ in range(repeats)), 3)
        rows[name] = build(spark, sf_dir).count()

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows": rows,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeats": repeats,
                "spark": spark.version,
                "settings": extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
