"""Registered queries: each builds one dataset from the star-schema tables
under ``base`` (``customer nation region part orders lineitem``), through
the same transforms a production run uses.  Audit timestamps are pinned to
``AS_OF`` so results are reproducible and comparable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.plans import accounts as acc
from strata.plans import sales
from strata.session import ensure_checkpoint_dir
from strata.sources import feeds
from strata.sources.intake import RESCUE_COLUMN, read_landing

AS_OF = "2024-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


# --- sales ----------------------------------------------------------------------


def bronze_customers(spark: SparkSession, base: str) -> DataFrame:
    return sales.bronze_sales(feeds.customers_from_star(spark, base), "customers", AS_OF)


def bronze_products(spark: SparkSession, base: str) -> DataFrame:
    return sales.bronze_sales(feeds.products_from_star(spark, base), "products", AS_OF)


def bronze_orders(spark: SparkSession, base: str) -> DataFrame:
    return sales.bronze_sales(feeds.orders_from_star(spark, base), "orders", AS_OF)


def orders_quarantine_detail(spark: SparkSession, base: str) -> DataFrame:
    """Every order line failing a rule, with the failed rules as a
    comma-separated list."""
    detail = sales.split_orders(bronze_orders(spark, base)).quarantine_with_reasons()
    return detail.withColumn("failed_rules", F.array_join("failed_rules", ","))


def orders_quarantine_reasons(spark: SparkSession, base: str) -> DataFrame:
    return sales.split_orders(bronze_orders(spark, base)).failure_counts()


def dim_customers(spark: SparkSession, base: str) -> DataFrame:
    return sales.dim_customers(bronze_customers(spark, base), AS_OF)


def dim_products(spark: SparkSession, base: str) -> DataFrame:
    return sales.dim_products(bronze_products(spark, base), AS_OF)


def fact_orders(spark: SparkSession, base: str) -> DataFrame:
    return sales.fact_orders(
        bronze_orders(spark, base),
        dim_customers(spark, base),
        dim_products(spark, base),
        AS_OF,
    )


def fact_orders_missing_dims(spark: SparkSession, base: str) -> DataFrame:
    """Facts looked up in active customers and available products only: lines
    of any other customer or product keep NULL attributes."""
    return sales.fact_orders(
        bronze_orders(spark, base),
        dim_customers(spark, base).where("is_active"),
        dim_products(spark, base).where("is_available"),
        AS_OF,
    )


def order_lines(spark: SparkSession, base: str) -> DataFrame:
    """Order lines before any dimension is looked up (not registered)."""
    return sales.order_lines(bronze_orders(spark, base))


def daily_sales_summary(spark: SparkSession, base: str) -> DataFrame:
    return sales.daily_sales_summary(order_lines(spark, base), AS_OF)


def report_daily_sales(spark: SparkSession, base: str) -> DataFrame:
    return sales.report_daily_sales(daily_sales_summary(spark, base))


def customer_metrics(spark: SparkSession, base: str) -> DataFrame:
    return sales.customer_metrics(
        order_lines(spark, base), AS_OF, customers=dim_customers(spark, base)
    )


def product_performance(spark: SparkSession, base: str) -> DataFrame:
    return sales.product_performance(
        order_lines(spark, base), AS_OF, products=dim_products(spark, base)
    )


def product_performance_window(spark: SparkSession, base: str) -> DataFrame:
    """``product_performance`` with the rank in the window function's type
    (int); computed by ranges as well, no window sees all products."""
    ranked = product_performance(spark, base)
    return ranked.withColumn("revenue_rank", F.col("revenue_rank").cast("int"))


def product_rank_global(spark: SparkSession, base: str) -> DataFrame:
    """Both ranks of every product by completed revenue (ties included)."""
    from strata.operators.ranking import global_ranks

    totals = sales.product_totals(order_lines(spark, base), dim_products(spark, base))
    return global_ranks(
        totals.select("product_id", "total_revenue"),
        "total_revenue",
        rank_col="revenue_rank",
        dense_rank_col="revenue_dense_rank",
    )


# --- landing files ---------------------------------------------------------------


def _landing(spark: SparkSession, name: str) -> str:
    """A new folder for a landing copy in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing/{name}-{uuid.uuid4().hex}"


def customers_landing_rescue(spark: SparkSession, base: str) -> DataFrame:
    """All customers landed as JSON lines, some with a field that the feed does
    not declare, some with an id that is no number, some cut off; read by field."""
    path, k = _landing(spark, "customers"), F.col("customer_id")
    text = '{"customer_id":%s,"first_name":"%s","last_name":"%s","city":"%s"'
    named = (k.cast("string"), "first_name", "last_name", F.coalesce("city", F.lit("?")))
    head = F.format_string(text, *named)
    line = (
        F.when(k % 31 == 0, head)
        .when(k % 7 == 0, F.concat(head, F.lit(',"loyalty":"gold","points":'), (k % 5).cast("string"), F.lit("}")))
        .when(k % 9 == 0, F.concat(F.regexp_replace(head, "^(.{15})([0-9]+)", '$1"n$2"'), F.lit("}")))
        .otherwise(F.concat(head, F.lit("}")))
    )
    feeds.customers_from_star(spark, base).select(line.alias("value")).write.text(path)
    read = read_landing(spark, path, schemas.CUSTOMERS, "json", level="field")
    return read.select("customer_id", "first_name", "last_name", "city", "status", RESCUE_COLUMN)


def products_landing_rescue(spark: SparkSession, base: str) -> DataFrame:
    """All products landed as CSV files of two layouts: the declared order with
    some prices that are no number, and a reordered one with a column more and
    others missing; read by each file's header."""
    path, k = _landing(spark, "products"), F.col("product_id")
    products = feeds.products_from_star(spark, base)
    price = F.when(k % 10 == 0, F.lit("on request")).otherwise(F.col("price").cast("string"))
    products.where(k % 2 == 0).select(
        "product_id", "product_name", "category", price.alias("price"), "stock_quantity"
    ).write.csv(f"{path}/a", header=True)
    products.where(k % 2 == 1).select(
        "price", F.when(k % 3 == 0, F.concat(F.lit("promo, "), k.cast("string"))).alias("promo"),
        "product_name", "product_id",
    ).write.csv(f"{path}/b", header=True)
    read = read_landing(spark, f"{path}/*", schemas.PRODUCTS, "csv", level="field")
    return read.select("product_id", "product_name", "category", "price", "stock_quantity", RESCUE_COLUMN)


# --- accounts -------------------------------------------------------------------


def raw_accounts(spark: SparkSession, base: str) -> DataFrame:
    return feeds.accounts_from_star(spark, base)


def bronze_accounts(spark: SparkSession, base: str) -> DataFrame:
    return acc.bronze_accounts(raw_accounts(spark, base), AS_OF)


def accounts_valid(spark: SparkSession, base: str) -> DataFrame:
    return acc.split_accounts(bronze_accounts(spark, base)).valid


def accounts_quarantine(spark: SparkSession, base: str) -> DataFrame:
    return acc.split_accounts(bronze_accounts(spark, base)).quarantine_distinct()


def accounts_quarantine_detail(spark: SparkSession, base: str) -> DataFrame:
    """Every failing bronze row (duplicates kept) with its failed rules as a
    comma-separated list (the quarantine table itself keeps the array)."""
    detail = acc.split_accounts(bronze_accounts(spark, base)).quarantine_with_reasons()
    return detail.withColumn("failed_rules", F.array_join("failed_rules", ","))


def accounts_quarantine_reasons(spark: SparkSession, base: str) -> DataFrame:
    return acc.quarantine_reason_counts(bronze_accounts(spark, base))


def accounts_run_summary(spark: SparkSession, base: str) -> DataFrame:
    return acc.run_summary(bronze_accounts(spark, base))


def silver_accounts(spark: SparkSession, base: str) -> DataFrame:
    valid = acc.split_accounts(bronze_accounts(spark, base)).valid
    return acc.silver_accounts(valid, AS_OF)


def gold_accounts(spark: SparkSession, base: str) -> DataFrame:
    return acc.gold_accounts(silver_accounts(spark, base))


def gold_country_analytics(spark: SparkSession, base: str) -> DataFrame:
    return acc.gold_country_analytics(silver_accounts(spark, base), AS_OF)


def gold_size_analytics(spark: SparkSession, base: str) -> DataFrame:
    return acc.gold_size_analytics(silver_accounts(spark, base), AS_OF)


def report_country(spark: SparkSession, base: str) -> DataFrame:
    return acc.report_country(gold_country_analytics(spark, base))


def report_size(spark: SparkSession, base: str) -> DataFrame:
    return acc.report_size(gold_size_analytics(spark, base))


def report_size_distribution(spark: SparkSession, base: str) -> DataFrame:
    return acc.report_size_distribution(gold_accounts(spark, base))


def accounts_sample(spark: SparkSession, base: str) -> DataFrame:
    return acc.sample(silver_accounts(spark, base), "account_id", 5)


def accounts_upsert(spark: SparkSession, base: str) -> DataFrame:
    """Keyed upsert of this run's silver accounts into the previous silver
    state (see ``accounts.previous_silver_state``: built a day earlier under
    an id-only rule from the accounts that had an industry, at half today's
    revenue).  Keys in both take this run's row; accounts quarantined today
    keep their previous row; accounts without an industry then are new."""
    from strata.operators.upsert import upsert

    bronze = bronze_accounts(spark, base)
    previous = acc.previous_silver_state(bronze, AS_OF)
    current = acc.silver_accounts(acc.split_accounts(bronze).valid, AS_OF)
    return upsert(previous, current, ["account_id"])


def _previous_accounts(spark: SparkSession, base: str) -> DataFrame:
    """Bronze accounts as of a day earlier: those that had an industry."""
    return acc.bronze_accounts(
        raw_accounts(spark, base).where("AccountIndustry is not null"), "2023-12-31 00:00:00"
    )


def bronze_accounts_upsert(spark: SparkSession, base: str) -> DataFrame:
    """An incremental feed (the accounts with a type) upserted into
    yesterday's bronze table."""
    from strata.operators.upsert import upsert

    current = bronze_accounts(spark, base).where("AccountType is not null")
    return upsert(_previous_accounts(spark, base), current, ["AccountId"])


def gold_accounts_upsert(spark: SparkSession, base: str) -> DataFrame:
    """This run's enterprise accounts upserted into yesterday's gold dimension."""
    from strata.operators.upsert import upsert

    yesterday = acc.split_accounts(_previous_accounts(spark, base)).valid
    previous = acc.gold_accounts(acc.silver_accounts(yesterday, "2023-12-31 00:00:00"))
    current = gold_accounts(spark, base).where("account_type = 'Enterprise'")
    return upsert(previous, current, ["account_id"])


QUERIES: dict[str, Query] = {
    "bronze_accounts": bronze_accounts,
    "bronze_customers": bronze_customers,
    "bronze_products": bronze_products,
    "bronze_orders": bronze_orders,
    "accounts_valid": accounts_valid,
    "accounts_quarantine": accounts_quarantine,
    "accounts_quarantine_detail": accounts_quarantine_detail,
    "accounts_quarantine_reasons": accounts_quarantine_reasons,
    "accounts_run_summary": accounts_run_summary,
    "silver_accounts": silver_accounts,
    "gold_accounts": gold_accounts,
    "gold_country_analytics": gold_country_analytics,
    "gold_size_analytics": gold_size_analytics,
    "report_country": report_country,
    "report_size": report_size,
    "report_size_distribution": report_size_distribution,
    "accounts_sample": accounts_sample,
    "accounts_upsert": accounts_upsert,
    "bronze_accounts_upsert": bronze_accounts_upsert,
    "gold_accounts_upsert": gold_accounts_upsert,
    "orders_quarantine_detail": orders_quarantine_detail,
    "orders_quarantine_reasons": orders_quarantine_reasons,
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "fact_orders": fact_orders,
    "fact_orders_missing_dims": fact_orders_missing_dims,
    "daily_sales_summary": daily_sales_summary,
    "report_daily_sales": report_daily_sales,
    "customer_metrics": customer_metrics,
    "product_performance": product_performance,
    "product_performance_window": product_performance_window,
    "product_rank_global": product_rank_global,
    "customers_landing_rescue": customers_landing_rescue,
    "products_landing_rescue": products_landing_rescue,
}
