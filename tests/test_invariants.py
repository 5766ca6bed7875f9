"""Invariants across the registered datasets at sf0.01."""

import pytest
from pyspark.sql import functions as F

from strata.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q(spark):
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = QUERIES[name](spark, SF).cache()
        return cache[name]

    return get


def test_quality_partition(q):
    s = q("accounts_run_summary").first()
    assert s.valid_records + s.quarantined_records == s.bronze_records == q("bronze_accounts").count()
    assert q("accounts_valid").count() == s.valid_records
    assert q("accounts_quarantine_detail").count() == s.quarantined_records
    assert q("accounts_quarantine").count() <= s.quarantined_records


def test_size_and_tier_counts_add_up(q):
    sizes = ["enterprise", "large", "medium", "small", "micro"]
    country = q("gold_country_analytics")
    assert country.filter(sum(F.col(f"{x}_accounts") for x in sizes) != F.col("total_accounts")).count() == 0
    size = q("gold_size_analytics")
    assert size.filter(sum(F.col(f"tier{i}_accounts") for i in range(1, 5)) != F.col("total_accounts")).count() == 0
    n = q("silver_accounts").count()
    assert country.agg(F.sum("total_accounts")).first()[0] == n
    assert size.agg(F.sum("total_accounts")).first()[0] == n
    assert abs(size.agg(F.sum("pct_of_total_accounts")).first()[0] - 100) < 0.05
    assert abs(size.agg(F.sum("pct_of_total_revenue")).first()[0] - 100) < 0.05


def test_sales_totals_agree(q):
    fact = q("fact_orders")
    done = fact.filter("status_category = 'Completed'")
    units = done.agg(F.sum("quantity")).first()[0]
    assert q("daily_sales_summary").agg(F.sum("total_units_sold")).first()[0] == units
    assert q("customer_metrics").agg(F.sum("total_items")).first()[0] == units
    assert q("product_performance").agg(F.sum("total_units_sold")).first()[0] == units
    assert fact.count() == q("bronze_orders").filter("quantity > 0").count()
    assert fact.filter("customer_name IS NULL OR product_name IS NULL").count() == 0


def test_rank_invariants(q):
    r = q("product_rank_global")
    distinct = r.select("total_revenue").distinct().count()
    assert r.agg(F.max("revenue_dense_rank")).first()[0] == distinct
    assert r.agg(F.min("revenue_rank")).first()[0] == 1
    assert r.filter("revenue_rank < revenue_dense_rank").count() == 0
    perf = q("product_performance").select("product_id", F.col("revenue_rank").alias("perf_rank"))
    joined = r.join(perf, "product_id")
    assert joined.filter("perf_rank != revenue_dense_rank").count() == 0


def test_upsert_keeps_every_key(q):
    up = q("accounts_upsert")
    assert up.count() == up.select("account_id").distinct().count()
    assert up.join(q("silver_accounts").select("account_id"), "account_id", "left_anti").count() > 0
