from strata.plans.jobs import run_accounts_job, run_sales_job
from tests.fixtures import AS_OF, accounts_df, customers_df, orders_df, products_df


def test_accounts_job_and_rerun(spark, fresh_schema):
    rep = run_accounts_job(spark, accounts_df(spark), fresh_schema, AS_OF)
    assert rep.rows["bronze_accounts"] == 12
    assert rep.rows["silver_accounts"] == 11
    assert rep.rows["accounts_quarantine"] == 1
    assert rep.rows["gold_country_analytics"] == 7
    assert rep.rows["gold_size_analytics"] == 5
    assert rep.summary["processing_rate_pct"] == 91.7
    q = spark.table(f"{fresh_schema}.accounts_quarantine").first()
    assert q.failed_rules == ["has_account_name", "employees_not_negative", "revenue_not_negative"]
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {fresh_schema}.gold_size_analytics").collect()}
    assert props["refresh_pattern"] == "full_overwrite"
    before = sorted(tuple(r) for r in spark.table(f"{fresh_schema}.silver_accounts").collect())
    rep2 = run_accounts_job(spark, accounts_df(spark), fresh_schema, AS_OF)
    assert rep2.rows["bronze_accounts"] == 12 and rep2.rows["silver_accounts"] == 11
    after = sorted(tuple(r) for r in spark.table(f"{fresh_schema}.silver_accounts").collect())
    assert before == after


def test_accounts_upsert_never_deletes(spark, fresh_schema):
    run_accounts_job(spark, accounts_df(spark), fresh_schema, AS_OF)
    # ACC001 now arrives broken: it is quarantined, its silver row stays
    broken = [("ACC001", None, "Technology", "Enterprise", "USA", "USA", 5000, 1.0)]
    run_accounts_job(spark, accounts_df(spark, broken), fresh_schema, AS_OF)
    silver = {r.account_id: r for r in spark.table(f"{fresh_schema}.silver_accounts").collect()}
    assert silver["ACC001"].annual_revenue == 50000000.0
    assert spark.table(f"{fresh_schema}.bronze_accounts").filter("AccountId = 'ACC001'").first().AccountName is None


def test_sales_job(spark, fresh_schema):
    rep = run_sales_job(
        spark, customers_df(spark), products_df(spark), orders_df(spark), fresh_schema, AS_OF,
        partition_facts_by_month=True, unique_dims=True, spread_null_keys=True,
    )
    assert rep.rows == {
        "raw_customers": 5, "raw_products": 5, "raw_orders": 6, "dim_customers": 5, "dim_products": 5,
        "fact_orders": 6, "daily_sales_summary": 5, "customer_metrics": 5, "product_performance": 5,
    }
    top = spark.table(f"{fresh_schema}.product_performance").filter("revenue_rank = 1").first()
    assert top.product_id == 101


def test_accounts_job_with_key_buckets(spark, fresh_schema):
    rep = run_accounts_job(spark, accounts_df(spark), fresh_schema, AS_OF, key_buckets=8)
    assert rep.rows["bronze_accounts"] == 12 and rep.rows["silver_accounts"] == 11
    broken = [("ACC001", None, "Technology", "Enterprise", "USA", "USA", 5000, 1.0)]
    rep2 = run_accounts_job(spark, accounts_df(spark, broken), fresh_schema, AS_OF, key_buckets=8)
    assert rep2.rows["bronze_accounts"] < 12  # only ACC001's bucket rewritten
    assert spark.table(f"{fresh_schema}.bronze_accounts").count() == 12
    silver = {r.account_id: r for r in spark.table(f"{fresh_schema}.silver_accounts").collect()}
    assert len(silver) == 11 and silver["ACC001"].annual_revenue == 50000000.0
    assert rep2.rows["gold_country_analytics"] == 7


def test_use_schema(spark, fresh_schema):
    from strata.sources.tables import use_schema

    use_schema(spark, fresh_schema)
    try:
        assert spark.catalog.currentDatabase() == fresh_schema
    finally:
        use_schema(spark, "default")


def test_every_column_of_the_accounts_tables_is_documented(spark, fresh_schema):
    run_accounts_job(spark, accounts_df(spark), fresh_schema, AS_OF)
    for name in ("bronze_accounts", "silver_accounts", "gold_accounts", "gold_country_analytics", "gold_size_analytics"):
        rows = spark.sql(f"DESCRIBE TABLE {fresh_schema}.{name}").collect()
        named = [r for r in rows if r.col_name in spark.table(f"{fresh_schema}.{name}").columns]
        assert all(r.comment for r in named if r.col_name != "_key_bucket"), name
    for name, kind in (("gold_accounts", "dimension"), ("gold_country_analytics", "aggregation")):
        props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {fresh_schema}.{name}").collect()}
        # Spark reserves "table_type": ALTER TABLE refuses it
        assert props["table_role"] == kind
