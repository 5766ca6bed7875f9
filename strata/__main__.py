"""Command-line job runner (``python -m strata`` or ``spark-submit``).

    python -m strata accounts --schema crm --input /landing/accounts --format csv
    python -m strata sales --schema shop --customers P --products P --orders P
    python -m strata star --schema demo --star-dir /root/testdata/sf0.01

Under ``spark-submit`` the cluster's master and settings are used; only
options the session leaves unset are filled from ``SCALE_SETTINGS``.
Prints one JSON line per job with the rows written and the run summary.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from strata import schemas
from strata.plans.jobs import run_accounts_job, run_sales_job
from strata.session import SCALE_SETTINGS, ensure_checkpoint_dir
from strata.sources import feeds
from strata.sources.intake import read_landing


def session(master: str | None) -> SparkSession:
    builder = SparkSession.builder.appName("strata-jobs")
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    for key, value in SCALE_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            if spark.conf.isModifiable(key):
                spark.conf.set(key, value)
            else:  # a static option: the launcher has to set it
                print(f"setting {key} is left to the launcher", file=sys.stderr)
    ensure_checkpoint_dir(spark)
    return spark


def read_input(spark: SparkSession, path: str, schema, fmt: str):
    if fmt in ("csv", "json"):
        return read_landing(spark, path, schema, fmt)
    return feeds.read_feed(spark, path, schema, fmt)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    ap.add_argument("--as-of", default=None, help="processing instant (UTC); default now")
    sub = ap.add_subparsers(dest="job", required=True)

    a = sub.add_parser("accounts", help="accounts layers from a landing folder")
    a.add_argument("--schema", required=True)
    a.add_argument("--input", required=True)
    a.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    a.add_argument("--key-buckets", type=int, default=None)

    s = sub.add_parser("sales", help="sales layers from three landing folders")
    s.add_argument("--schema", required=True)
    s.add_argument("--customers", required=True)
    s.add_argument("--products", required=True)
    s.add_argument("--orders", required=True)
    s.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    s.add_argument("--partition-facts-by-month", action="store_true")
    s.add_argument("--unique-dims", action="store_true", help="fail on repeated dimension keys")
    s.add_argument(
        "--spread-null-keys", action="store_true", help="scatter NULL foreign keys (no AQE)"
    )

    st = sub.add_parser("star", help="both jobs on feeds derived from star-schema tables")
    st.add_argument("--schema", required=True)
    st.add_argument("--star-dir", required=True)
    st.add_argument("--key-buckets", type=int, default=None)
    for job in (a, s, st):
        job.add_argument("--run", help="name of the run: a rerun goes on where it stopped")
    for job in (a, st):
        job.add_argument("--changes-only", action="store_true", help="rewrite changed accounts only")

    args = ap.parse_args(argv)
    spark = session(args.master)
    reports = {}
    if args.job == "accounts":
        raw = read_input(spark, args.input, schemas.ACCOUNTS, args.format)
        reports["accounts"] = run_accounts_job(spark, raw, args.schema, args.as_of, args.key_buckets, args.changes_only, args.run)
    elif args.job == "sales":
        reports["sales"] = run_sales_job(
            spark,
            read_input(spark, args.customers, schemas.CUSTOMERS, args.format),
            read_input(spark, args.products, schemas.PRODUCTS, args.format),
            read_input(spark, args.orders, schemas.ORDERS, args.format),
            args.schema,
            args.as_of,
            args.partition_facts_by_month,
            args.unique_dims,
            args.spread_null_keys,
            args.run,
        )
    else:
        base = args.star_dir
        reports["accounts"] = run_accounts_job(
            spark, feeds.accounts_from_star(spark, base), args.schema, args.as_of, args.key_buckets,
            args.changes_only, args.run,
        )
        reports["sales"] = run_sales_job(
            spark,
            feeds.customers_from_star(spark, base),
            feeds.products_from_star(spark, base),
            feeds.orders_from_star(spark, base),
            args.schema,
            args.as_of,
            run=args.run,
        )
    for job, report in reports.items():
        print(json.dumps({"job": job, "rows": report.rows, "summary": report.summary}, default=str))


if __name__ == "__main__":
    main()
