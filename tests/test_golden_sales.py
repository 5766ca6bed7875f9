"""Sales layers on the sample feeds."""

import datetime as dt

import pytest

from strata.plans import sales
from tests.fixtures import AS_OF, by_key, customers_df, products_df, sales_fact


@pytest.fixture(scope="module")
def fact(spark):
    return sales_fact(spark).cache()


def test_dims(spark):
    c = by_key(sales.dim_customers(sales.bronze_sales(customers_df(spark), "customers", AS_OF), AS_OF), "customer_id")
    assert c[1]["full_name"] == "John Doe"
    assert c[4]["is_active"] is False
    assert c[1]["_source_system"] == "CRM"
    p = by_key(sales.dim_products(sales.bronze_sales(products_df(spark), "products", AS_OF), AS_OF), "product_id")
    assert {k: v["price_tier"] for k, v in p.items()} == {
        101: "Luxury",
        102: "Budget",
        103: "Budget",
        104: "Premium",
        105: "Premium",
    }
    assert all(v["is_available"] for v in p.values())


def test_fact_shape(fact):
    assert fact.columns == sales.FACT_COLUMNS
    rows = by_key(fact, "order_id")
    assert len(rows) == 6
    r = rows[1002]
    assert r["line_total"] == 59.98
    assert r["order_date"] == dt.datetime(2024, 1, 5, 10, 30)
    assert r["order_date_only"] == dt.date(2024, 1, 5)
    assert r["status_category"] == "Completed"
    assert (r["customer_name"], r["product_name"], r["price_tier"]) == ("John Doe", "Wireless Mouse", "Budget")


def test_daily(fact):
    out = {r.order_date_only.isoformat(): r for r in sales.daily_sales_summary(fact, AS_OF).collect()}
    got = {k: (v.total_orders, v.total_units_sold, v.total_revenue, v.unique_customers) for k, v in out.items()}
    assert got == {
        "2024-01-05": (2, 3, 1359.97, 1),
        "2024-01-08": (1, 1, 399.99, 1),
        "2024-01-10": (1, 1, 299.99, 1),
        "2024-01-12": (1, 1, 1299.99, 1),
        "2024-01-15": (1, 2, 99.98, 1),
    }


def test_customer_metrics(fact):
    out = by_key(sales.customer_metrics(fact, AS_OF), "customer_id")
    got = {
        k: (v["total_orders"], v["total_items"], v["total_revenue"], v["avg_order_value"], v["customer_segment"])
        for k, v in out.items()
    }
    assert got == {
        1: (2, 3, 1359.97, 679.99, "VIP"),  # 679.985 rounds half up
        2: (1, 1, 399.99, 399.99, "Regular"),
        3: (1, 1, 299.99, 299.99, "Regular"),
        4: (1, 1, 1299.99, 1299.99, "VIP"),
        5: (1, 2, 99.98, 99.98, "Regular"),
    }


@pytest.mark.parametrize("fn", [sales.product_performance])
def test_product_performance(fact, fn):
    out = by_key(fn(fact, AS_OF), "product_id")
    got = {
        k: (v["times_ordered"], v["total_units_sold"], v["total_revenue"], v["unique_customers"], v["revenue_rank"], v["price_tier"])
        for k, v in out.items()
    }
    assert got == {
        101: (2, 2, 2599.98, 2, 1, "Luxury"),
        104: (1, 1, 399.99, 1, 2, "Premium"),
        105: (1, 1, 299.99, 1, 3, "Premium"),
        103: (1, 2, 99.98, 1, 4, "Budget"),
        102: (1, 2, 59.98, 1, 5, "Budget"),
    }
