"""Boundary and NULL behaviour of every rule and classification."""

import pytest

from strata.plans import accounts as acc
from strata.plans import sales
from tests.fixtures import AS_OF, accounts_df, by_key, sales_fact

ROW = ("X", "Name", "Ind", "Type", "hq", "c", 10, 1.0)


def _acct(i, **kw):
    base = dict(zip(["AccountId", "AccountName", "AccountIndustry", "AccountType",
                     "AccountHQCountry", "AccountCountry", "NumberOfEmployees", "AnnualRevenue"], ROW))
    base["AccountId"] = f"A{i:03d}"
    base.update(kw)
    return tuple(base.values())


def test_validity_rules(spark):
    rows = [
        _acct(1, AccountId=None),
        _acct(2, AccountId=""),
        _acct(3, AccountName=None),
        _acct(4, AccountName=""),
        _acct(5, AccountName="  "),  # blank-only passes (checked before trim)
        _acct(6, NumberOfEmployees=None),
        _acct(7, NumberOfEmployees=0),
        _acct(8, NumberOfEmployees=-1),
        _acct(9, AnnualRevenue=None),
        _acct(10, AnnualRevenue=0.0),
        _acct(11, AnnualRevenue=-1.0),
        _acct(12, AccountName=None),
        _acct(12, AccountName=None),  # identical bad rows
    ]
    bronze = acc.bronze_accounts(accounts_df(spark, rows), AS_OF)
    split = acc.split_accounts(bronze)
    valid = sorted(r.AccountId for r in split.valid.collect())
    assert valid == ["A005", "A006", "A007", "A009", "A010"]
    assert split.quarantine.count() == 8  # every bad row kept
    assert split.quarantine_distinct().count() == 7  # EXCEPT DISTINCT collapses copies
    # multiset invariant: valid + quarantine = bronze
    assert split.valid.count() + split.quarantine.count() == bronze.count()
    silver = by_key(acc.silver_accounts(split.valid, AS_OF), "account_id")
    assert silver["A005"]["account_name"] == ""


def test_defaults_and_trimming(spark):
    rows = [
        _acct(1, AccountIndustry=None, AccountType=None, AccountHQCountry=None, AccountCountry=None),
        _acct(2, AccountIndustry="", AccountType="", AccountHQCountry="", AccountCountry=""),
        _acct(3, AccountIndustry="  Tech ", AccountType=" SMB", AccountHQCountry=" uSa ", AccountCountry="germany  "),
    ]
    silver = by_key(acc.silver_accounts(acc.bronze_accounts(accounts_df(spark, rows), AS_OF), AS_OF), "account_id")
    assert [silver["A001"][k] for k in ("industry", "account_type", "hq_country", "country")] == [
        "Unknown", "Unknown", "UNKNOWN", "UNKNOWN"]
    assert [silver["A002"][k] for k in ("industry", "account_type", "hq_country", "country")] == ["", "", "", ""]
    assert [silver["A003"][k] for k in ("industry", "account_type", "hq_country", "country")] == [
        "Tech", "SMB", "USA", "GERMANY"]


@pytest.mark.parametrize(
    "employees,size",
    [(0, "Micro"), (9, "Micro"), (10, "Small"), (99, "Small"), (100, "Medium"), (999, "Medium"),
     (1000, "Large"), (9999, "Large"), (10000, "Enterprise"), (None, "Micro")],
)
def test_company_size(spark, employees, size):
    df = accounts_df(spark, [_acct(1, NumberOfEmployees=employees)])
    assert acc.silver_accounts(acc.bronze_accounts(df, AS_OF), AS_OF).first().company_size == size


@pytest.mark.parametrize(
    "revenue,tier",
    [(0.0, 4), (999999.99, 4), (1e6, 3), (9999999.99, 3), (1e7, 2), (99999999.99, 2), (1e8, 1),
     (None, 4), (-2e8, 1)],
)
def test_revenue_tier(spark, revenue, tier):
    df = accounts_df(spark, [_acct(1, AnnualRevenue=revenue)])
    row = acc.silver_accounts(acc.bronze_accounts(df, AS_OF), AS_OF).first()
    assert acc.TIER_ORDER.index(row.revenue_tier) + 1 == tier
    assert row.annual_revenue_abs == abs(revenue or 0.0)


def test_zero_totals(spark):
    rows = [_acct(1, NumberOfEmployees=0, AnnualRevenue=0.0), _acct(2, NumberOfEmployees=5, AnnualRevenue=0.0)]
    silver = acc.silver_accounts(acc.bronze_accounts(accounts_df(spark, rows), AS_OF), AS_OF)
    size = acc.gold_size_analytics(silver, AS_OF).first()
    assert size.total_revenue == 0.0
    assert size.pct_of_total_revenue is None  # zero total: no division error
    assert size.pct_of_total_accounts == 100.0
    assert size.revenue_per_employee == 0.0
    country = acc.gold_country_analytics(silver, AS_OF).first()
    assert country.revenue_per_employee == 0.0
    empty = acc.split_accounts(acc.bronze_accounts(accounts_df(spark, []), AS_OF)).summary().first()
    assert (empty.bronze_records, empty.processing_rate_pct) == (0, None)


def test_rank_ties(spark):
    rows = [_acct(1, AccountCountry="A", AnnualRevenue=5.0), _acct(2, AccountCountry="B", AnnualRevenue=5.0),
            _acct(3, AccountCountry="C", AnnualRevenue=3.0), _acct(4, AccountCountry="C", AnnualRevenue=0.0)]
    silver = acc.silver_accounts(acc.bronze_accounts(accounts_df(spark, rows), AS_OF), AS_OF)
    out = by_key(acc.gold_country_analytics(silver, AS_OF), "country")
    assert {k: v["revenue_rank"] for k, v in out.items()} == {"A": 1, "B": 1, "C": 3}
    assert {k: v["accounts_rank"] for k, v in out.items()} == {"C": 1, "A": 2, "B": 2}


PRODUCTS = [
    (1, "p1", "c", "s", 49.99, 1, "active"),
    (2, "p2", "c", "s", 50.0, 0, "active"),
    (3, "p3", "c", "s", 199.99, None, "active"),
    (4, "p4", "c", "s", 200.0, 1, "discontinued"),
    (5, "p5", "c", "s", 499.99, 0, "discontinued"),
    (6, "p6", "c", "s", 500.0, 1, None),
    (7, "p7", "c", "s", None, 0, None),
    (8, "p8", "c", "s", 10.0, None, None),
]


def test_price_tier_and_availability(spark):
    from tests.fixtures import products_df

    p = by_key(sales.dim_products(sales.bronze_sales(products_df(spark, PRODUCTS), "products", AS_OF), AS_OF), "product_id")
    assert {k: v["price_tier"] for k, v in p.items()} == {
        1: "Budget", 2: "Mid-Range", 3: "Mid-Range", 4: "Premium", 5: "Premium", 6: "Luxury", 7: "Luxury", 8: "Budget"}
    # three-valued: NULL status with stock > 0 is NULL, with stock <= 0 false
    assert {k: v["is_available"] for k, v in p.items()} == {
        1: True, 2: False, 3: None, 4: False, 5: False, 6: None, 7: False, 8: None}


def test_customer_names_and_activity(spark):
    from tests.fixtures import customers_df

    rows = [(1, "A", None, "X@Y.COM", None, None, None, None), (2, None, "B", None, None, None, None, "active"),
            (3, None, None, None, None, None, None, "inactive")]
    c = by_key(sales.dim_customers(sales.bronze_sales(customers_df(spark, rows), "customers", AS_OF), AS_OF), "customer_id")
    assert [c[i]["full_name"] for i in (1, 2, 3)] == ["A", "B", ""]
    assert [c[i]["is_active"] for i in (1, 2, 3)] == [False, True, False]
    assert c[1]["email"] == "x@y.com"


ORDERS = [
    (1, 1, 101, 1, 10.0, "2024-01-01 00:00:00", "delivered", "x"),
    (2, 1, 101, 0, 10.0, "2024-01-01 00:00:00", "delivered", "x"),
    (3, 1, 101, -1, 10.0, "2024-01-01 00:00:00", "delivered", "x"),
    (4, 1, 101, None, 10.0, "2024-01-01 00:00:00", "delivered", "x"),
    (5, 1, 101, 1, 10.0, "not a date", "delivered", "x"),
    (6, 1, 101, 1, 10.0, "2024-01-02 00:00:00", None, "x"),
    (7, 1, 101, 1, 10.0, "2024-01-02 00:00:00", "cancelled", "x"),
    (8, 99, 999, 2, 0.125, "2024-01-03 00:00:00", "delivered", "x"),
]


def test_order_edges(spark):
    fact = by_key(sales_fact(spark, orders=ORDERS), "order_id")
    assert sorted(fact) == [1, 5, 6, 7, 8]  # quantity > 0 only
    assert fact[5]["order_date"] is None and fact[5]["order_date_only"] is None
    assert fact[6]["status_category"] == "In Progress"
    assert fact[7]["status_category"] == "In Progress"
    assert fact[8]["customer_name"] is None and fact[8]["product_name"] is None  # unmatched dims
    assert fact[8]["line_total"] == 0.25
    assert fact[1]["customer_name"] == "John Doe"


def test_segments(spark):
    orders = [
        (1, 1, 101, 1, 999.99, "2024-01-01 00:00:00", "delivered", "x"),
        (2, 2, 101, 1, 1000.0, "2024-01-01 00:00:00", "delivered", "x"),
        (3, 3, 101, 1, 10.0, "2024-01-01 00:00:00", "delivered", "x"),
        (4, 3, 101, 1, 10.0, "2024-01-02 00:00:00", "delivered", "x"),
    ]
    out = by_key(sales.customer_metrics(sales_fact(spark, orders=orders), AS_OF), "customer_id")
    assert {k: v["customer_segment"] for k, v in out.items()} == {1: "Regular", 2: "VIP", 3: "Loyal"}


def test_exact_cent_average(spark):
    # 0.01 + 0.02 average 0.015: half-up to 0.02; 3 lines of 0.01,0.01,0.02 -> 0.0133 -> 0.01
    orders = [
        (1, 1, 101, 1, 0.01, "2024-01-01 00:00:00", "delivered", "x"),
        (2, 1, 101, 1, 0.02, "2024-01-01 00:00:00", "delivered", "x"),
        (3, 2, 101, 1, 0.01, "2024-01-01 00:00:00", "delivered", "x"),
        (4, 2, 101, 1, 0.01, "2024-01-01 00:00:00", "delivered", "x"),
        (5, 2, 101, 1, 0.02, "2024-01-01 00:00:00", "delivered", "x"),
    ]
    out = by_key(sales.customer_metrics(sales_fact(spark, orders=orders), AS_OF), "customer_id")
    assert (out[1]["avg_order_value"], out[2]["avg_order_value"]) == (0.02, 0.01)
    assert (out[1]["total_revenue"], out[2]["total_revenue"]) == (0.03, 0.04)


def test_product_rank_ties_and_missing_revenue(spark):
    orders = [
        (1, 1, 101, 1, 10.0, "2024-01-01 00:00:00", "delivered", "x"),
        (2, 1, 102, 1, 10.0, "2024-01-01 00:00:00", "delivered", "x"),
        (3, 1, 103, 1, 5.0, "2024-01-01 00:00:00", "delivered", "x"),
        (4, 1, 104, 1, None, "2024-01-01 00:00:00", "delivered", "x"),
    ]
    fact = sales_fact(spark, orders=orders)
    for fn in (sales.product_performance,):
        out = by_key(fn(fact, AS_OF), "product_id")
        assert {k: v["revenue_rank"] for k, v in out.items()} == {101: 1, 102: 1, 103: 2, 104: 3}
        assert out[104]["total_revenue"] is None


def test_unique_dims_guard(spark):
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException

    from strata.plans import sales
    from tests.fixtures import CUSTOMERS, customers_df, orders_df, products_df

    dup = CUSTOMERS + [CUSTOMERS[0]]
    c = sales.dim_customers(sales.bronze_sales(customers_df(spark, dup), "customers", AS_OF), AS_OF)
    p = sales.dim_products(sales.bronze_sales(products_df(spark), "products", AS_OF), AS_OF)
    o = sales.bronze_sales(orders_df(spark), "orders", AS_OF)
    # without the guard a repeated key repeats its lines (as a plain left join does)
    assert sales.fact_orders(o, c, p, AS_OF).count() == 8
    with pytest.raises((PySparkException, Py4JJavaError), match="duplicate key"):
        sales.fact_orders(o, c, p, AS_OF, unique_dims=True).collect()
    clean = sales.dim_customers(sales.bronze_sales(customers_df(spark), "customers", AS_OF), AS_OF)
    assert sales.fact_orders(o, clean, p, AS_OF, unique_dims=True).count() == 6


def test_order_quarantine(spark):
    from tests.fixtures import orders_df

    split = sales.split_orders(orders_df(spark, ORDERS))
    bad = {r.order_id: r.failed_rules for r in split.quarantine_with_reasons().collect()}
    assert bad == {2: ["quantity_positive"], 3: ["quantity_positive"], 4: ["quantity_positive"],
                   5: ["order_date_parses"]}
    counts = {r.rule: r.failed_records for r in split.failure_counts().collect()}
    assert counts == {"quantity_positive": 3, "order_date_parses": 1}
