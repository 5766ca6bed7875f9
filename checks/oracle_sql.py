"""Independent DuckDB SQL for every registered query.

Each statement rebuilds its dataset from the base tables (views ``customer
nation region part orders lineitem``) in plain SQL, so a Spark result can be
compared with an engine that shares none of its code.  Pitfalls handled:
DuckDB ``sum(int)`` is HUGEINT and ``rank()`` BIGINT (cast to Spark's
bigint / int), ``CAST(double AS INTEGER)`` rounds in DuckDB but truncates in
Spark (``trunc`` first), NULL ordering is spelled out.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-01 00:00:00'"
AS_OF_PREVIOUS = "TIMESTAMP '2023-12-31 00:00:00'"

GEO = """customer LEFT JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN region ON n_regionkey = r_regionkey"""

# Revenue is summed to the cent, exactly.
REVENUE = "CAST(sum(CAST(annual_revenue_abs AS DECIMAL(28,2))) AS DOUBLE)"

# Exact power sums of cents about the integer part of the mean.
_CENTS = "CAST(CAST(annual_revenue_abs AS DECIMAL(28,2)) * 100 AS HUGEINT)"
_S1, _S2, _N = f"sum({_CENTS})", f"sum({_CENTS} * {_CENTS})", f"count({_CENTS})"
_ABOUT = f"CAST(CAST({_S2} - ({_S1} // {_N}) * ({_S1} + {_S1} % {_N}) AS VARCHAR) AS DOUBLE)"
_REST = f"CAST({_S1} % {_N} AS DOUBLE)"
STDDEV = (
    f"CASE WHEN {_N} > 1 THEN sqrt(({_ABOUT} - {_REST} * {_REST} / CAST({_N} AS DOUBLE))"
    f" / CAST({_N} - 1 AS DOUBLE)) / 100 END"
)

RAW_ACCOUNTS = f"""raw_accounts AS (
  SELECT c_name AS AccountId,
    CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN ''
         ELSE concat(' ', c_name, ' ') END AS AccountName,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS AccountIndustry,
    CASE c_custkey % 4 WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'SMB' WHEN 2 THEN 'Startup' END
      AS AccountType,
    lower(r_name) AS AccountHQCountry,
    CASE WHEN c_custkey % 13 = 0 THEN '' ELSE n_name END AS AccountCountry,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN -1
         ELSE CAST(power(10, c_custkey % 5) AS INTEGER) * CAST(1 + c_custkey % 7 AS INTEGER)
    END AS NumberOfEmployees,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_acctbal * 20000 END AS AnnualRevenue
  FROM {GEO})"""

BRONZE_ACCOUNTS = f"""bronze_accounts AS (
  SELECT *, {AS_OF} AS ingestion_timestamp, 'source_crm' AS source_system,
         CAST(NULL AS VARCHAR) AS _rescued_data
  FROM raw_accounts)"""

RULES = {
    "has_account_id": "AccountId IS NOT NULL AND length(AccountId) > 0",
    "has_account_name": "AccountName IS NOT NULL AND length(AccountName) > 0",
    "employees_not_negative": "NumberOfEmployees IS NULL OR NumberOfEmployees >= 0",
    "revenue_not_negative": "AnnualRevenue IS NULL OR AnnualRevenue >= 0",
}
VALID = " AND ".join(f"coalesce(({p}), false)" for p in RULES.values())

VALID_ACCOUNTS = f"valid_accounts AS (SELECT * FROM bronze_accounts WHERE {VALID})"


def silver_select(source: str, revenue: str, stamp: str) -> str:
    rev = f"coalesce({revenue}, 0.0)"
    emp = "coalesce(NumberOfEmployees, 0)"
    return f"""SELECT AccountId AS account_id, trim(AccountName) AS account_name,
    coalesce(trim(AccountIndustry), 'Unknown') AS industry,
    coalesce(trim(AccountType), 'Unknown') AS account_type,
    coalesce(upper(trim(AccountHQCountry)), 'UNKNOWN') AS hq_country,
    coalesce(upper(trim(AccountCountry)), 'UNKNOWN') AS country,
    {emp} AS employee_count,
    {rev} AS annual_revenue,
    ingestion_timestamp, source_system,
    abs({rev}) AS annual_revenue_abs,
    CASE WHEN {emp} >= 10000 THEN 'Enterprise' WHEN {emp} >= 1000 THEN 'Large'
         WHEN {emp} >= 100 THEN 'Medium' WHEN {emp} >= 10 THEN 'Small' ELSE 'Micro' END
      AS company_size,
    CASE WHEN abs({rev}) >= 100000000 THEN 'Tier 1 - $100M+'
         WHEN abs({rev}) >= 10000000 THEN 'Tier 2 - $10M-$100M'
         WHEN abs({rev}) >= 1000000 THEN 'Tier 3 - $1M-$10M'
         ELSE 'Tier 4 - Under $1M' END AS revenue_tier,
    {stamp} AS processed_timestamp
  FROM {source}"""


SILVER = f"silver AS ({silver_select('valid_accounts', 'AnnualRevenue', AS_OF)})"
GOLD = """gold AS (SELECT account_id, account_name, account_type, industry, country,
    hq_country, employee_count, company_size, annual_revenue_abs, revenue_tier,
    processed_timestamp FROM silver)"""

ACCOUNTS_FROM_RAW = [BRONZE_ACCOUNTS, VALID_ACCOUNTS, SILVER]
ACCOUNTS_BASE = [RAW_ACCOUNTS] + ACCOUNTS_FROM_RAW

COUNTRY = f"""country_analytics AS (
  SELECT *,
    CAST(rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS INTEGER) AS revenue_rank,
    CAST(rank() OVER (ORDER BY total_accounts DESC NULLS LAST) AS INTEGER) AS accounts_rank,
    CASE WHEN total_employees > 0 THEN round(total_revenue / total_employees, 2)
         ELSE 0.0 END AS revenue_per_employee,
    {AS_OF} AS processed_timestamp
  FROM (
    SELECT country, count(*) AS total_accounts,
      count(DISTINCT industry) AS unique_industries,
      CAST(sum(employee_count) AS BIGINT) AS total_employees,
      avg(employee_count) AS avg_employees_per_account,
      max(employee_count) AS max_employees,
      {REVENUE} AS total_revenue,
      {REVENUE} / count(annual_revenue_abs) AS avg_revenue_per_account,
      max(annual_revenue_abs) AS max_revenue,
      count(*) FILTER (WHERE company_size = 'Enterprise') AS enterprise_accounts,
      count(*) FILTER (WHERE company_size = 'Large') AS large_accounts,
      count(*) FILTER (WHERE company_size = 'Medium') AS medium_accounts,
      count(*) FILTER (WHERE company_size = 'Small') AS small_accounts,
      count(*) FILTER (WHERE company_size = 'Micro') AS micro_accounts
    FROM silver GROUP BY country))"""

SIZE = f"""size_analytics AS (
  SELECT *,
    CASE company_size WHEN 'Enterprise' THEN 1 WHEN 'Large' THEN 2 WHEN 'Medium' THEN 3
         WHEN 'Small' THEN 4 ELSE 5 END AS size_order,
    CASE WHEN sum(total_accounts) OVER () <> 0
         THEN round(total_accounts / sum(total_accounts) OVER () * 100, 2) END
      AS pct_of_total_accounts,
    CASE WHEN sum(total_revenue) OVER () <> 0
         THEN round(total_revenue / sum(total_revenue) OVER () * 100, 2) END
      AS pct_of_total_revenue,
    CASE WHEN total_employees > 0 THEN round(total_revenue / total_employees, 2)
         ELSE 0.0 END AS revenue_per_employee,
    {AS_OF} AS processed_timestamp
  FROM (
    SELECT company_size, count(*) AS total_accounts,
      count(DISTINCT country) AS unique_countries,
      count(DISTINCT industry) AS unique_industries,
      CAST(sum(employee_count) AS BIGINT) AS total_employees,
      avg(employee_count) AS avg_employees,
      min(employee_count) AS min_employees,
      max(employee_count) AS max_employees,
      {REVENUE} AS total_revenue,
      {REVENUE} / count(annual_revenue_abs) AS avg_revenue,
      min(annual_revenue_abs) AS min_revenue,
      max(annual_revenue_abs) AS max_revenue,
      {STDDEV} AS revenue_stddev,
      count(*) FILTER (WHERE revenue_tier = 'Tier 1 - $100M+') AS tier1_accounts,
      count(*) FILTER (WHERE revenue_tier = 'Tier 2 - $10M-$100M') AS tier2_accounts,
      count(*) FILTER (WHERE revenue_tier = 'Tier 3 - $1M-$10M') AS tier3_accounts,
      count(*) FILTER (WHERE revenue_tier = 'Tier 4 - Under $1M') AS tier4_accounts
    FROM silver GROUP BY company_size))"""

# --- sales --------------------------------------------------------------------

BRONZE_CUSTOMERS = f"""bronze_customers AS (
  SELECT c_custkey AS customer_id,
    split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
    concat(c_name, '@EXAMPLE.COM') AS email, CAST(NULL AS VARCHAR) AS phone,
    n_name AS city, r_name AS state,
    CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'inactive' END AS status,
    {AS_OF} AS _ingested_at, 'CRM' AS _source_system
  FROM {GEO})"""

BRONZE_PRODUCTS = f"""bronze_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
    p_brand AS subcategory,
    CAST((CAST(p_retailprice AS DECIMAL(12,2)) - 900) * 10 AS DOUBLE) AS price,
    p_size - 5 AS stock_quantity,
    CASE WHEN p_partkey % 10 = 0 THEN 'discontinued' ELSE 'active' END AS status,
    {AS_OF} AS _ingested_at, 'INVENTORY' AS _source_system
  FROM part)"""

BRONZE_ORDERS = f"""bronze_orders AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
    CAST(trunc(l_quantity) AS INTEGER) - 1 AS quantity,
    l_extendedprice AS unit_price,
    CAST(o_orderdate AS VARCHAR) AS order_date,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending'
                       WHEN 'P' THEN 'shipped' END AS status,
    o_orderpriority AS payment_method,
    {AS_OF} AS _ingested_at, 'ORDERS' AS _source_system
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

DIM_CUSTOMERS = f"""dim_customers AS (
  SELECT customer_id, first_name, last_name,
    concat_ws(' ', first_name, last_name) AS full_name,
    lower(email) AS email, phone, city, state,
    coalesce(status = 'active', false) AS is_active,
    {AS_OF} AS _transformed_at, _source_system
  FROM bronze_customers)"""

DIM_PRODUCTS = f"""dim_products AS (
  SELECT product_id, product_name, category, subcategory, price,
    CASE WHEN price < 50 THEN 'Budget' WHEN price < 200 THEN 'Mid-Range'
         WHEN price < 500 THEN 'Premium' ELSE 'Luxury' END AS price_tier,
    stock_quantity,
    (status = 'active') AND (stock_quantity > 0) AS is_available,
    status, {AS_OF} AS _transformed_at, _source_system
  FROM bronze_products)"""

FACT = f"""lines AS (
  SELECT product_id, customer_id, order_id, quantity, unit_price,
    try_cast(order_date AS TIMESTAMP) AS order_date, status, payment_method,
    _ingested_at, _source_system,
    CAST(try_cast(order_date AS TIMESTAMP) AS DATE) AS order_date_only,
    round(quantity * unit_price, 2) AS line_total,
    CASE WHEN status = 'delivered' THEN 'Completed' ELSE 'In Progress' END AS status_category
  FROM bronze_orders WHERE quantity > 0),
fact AS (
  SELECT l.product_id, l.customer_id, l.order_id, l.quantity, l.unit_price, l.order_date,
    l.status, l.payment_method, l._ingested_at, l._source_system, l.order_date_only,
    l.line_total, l.status_category,
    c.full_name AS customer_name, c.city AS customer_city, c.state AS customer_state,
    p.product_name, p.category AS product_category, p.price_tier,
    {AS_OF} AS _transformed_at
  FROM lines l
  LEFT JOIN dim_customers c ON l.customer_id = c.customer_id
  LEFT JOIN dim_products p ON l.product_id = p.product_id)"""

SALES_FROM_BRONZE = [DIM_CUSTOMERS, DIM_PRODUCTS, FACT]
SALES_BASE = [BRONZE_CUSTOMERS, BRONZE_PRODUCTS, BRONZE_ORDERS] + SALES_FROM_BRONZE

MONEY_SUM = "CAST(sum(CAST(line_total AS DECIMAL(18,2))) AS DOUBLE)"

PRODUCT_TOTALS = f"""product_totals AS (
  SELECT product_id, product_name, product_category, price_tier,
    count(DISTINCT order_id) AS times_ordered,
    CAST(sum(quantity) AS BIGINT) AS total_units_sold,
    {MONEY_SUM} AS total_revenue,
    count(DISTINCT customer_id) AS unique_customers
  FROM fact WHERE status_category = 'Completed'
  GROUP BY product_id, product_name, product_category, price_tier)"""


# Gold statements over the ``fact`` / ``product_totals`` CTEs.
DAILY_SALES_SUMMARY_SQL = f"""SELECT order_date_only,
              count(DISTINCT order_id) AS total_orders,
              CAST(sum(quantity) AS BIGINT) AS total_units_sold,
              {MONEY_SUM} AS total_revenue,
              count(DISTINCT customer_id) AS unique_customers,
              {AS_OF} AS _aggregated_at
            FROM fact WHERE status_category = 'Completed'
            GROUP BY order_date_only"""

CUSTOMER_METRICS_SQL = f"""SELECT customer_id, customer_name, customer_city, customer_state,
              total_orders, total_items, total_revenue,
              CASE WHEN n > 0 THEN sign(s) * ((2 * abs(s) + n) // (2 * n)) / 100
              END AS avg_order_value,
              CASE WHEN total_revenue >= 1000 THEN 'VIP'
                   WHEN total_orders >= 2 THEN 'Loyal' ELSE 'Regular' END
                AS customer_segment,
              {AS_OF} AS _aggregated_at
            FROM (
              SELECT customer_id, customer_name, customer_city, customer_state,
                count(DISTINCT order_id) AS total_orders,
                CAST(sum(quantity) AS BIGINT) AS total_items,
                {MONEY_SUM} AS total_revenue,
                sum(CAST(round(line_total * 100) AS BIGINT)) AS s,
                count(line_total) AS n
              FROM fact WHERE status_category = 'Completed'
              GROUP BY customer_id, customer_name, customer_city, customer_state)"""

PRODUCT_PERFORMANCE_SQL = f"""SELECT *, dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST)
                      AS revenue_rank,
                   {AS_OF} AS _aggregated_at
            FROM product_totals"""

PRODUCT_RANK_GLOBAL_SQL = """SELECT product_id, total_revenue,
             rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank,
             dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_dense_rank
           FROM product_totals"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


ORACLE: dict[str, str] = {
    "bronze_accounts": with_([RAW_ACCOUNTS, BRONZE_ACCOUNTS], "SELECT * FROM bronze_accounts"),
    "bronze_customers": with_([BRONZE_CUSTOMERS], "SELECT * FROM bronze_customers"),
    "bronze_products": with_([BRONZE_PRODUCTS], "SELECT * FROM bronze_products"),
    "bronze_orders": with_([BRONZE_ORDERS], "SELECT * FROM bronze_orders"),
    "accounts_valid": with_(
        [RAW_ACCOUNTS, BRONZE_ACCOUNTS, VALID_ACCOUNTS], "SELECT * FROM valid_accounts"
    ),
    "accounts_quarantine": with_(
        [RAW_ACCOUNTS, BRONZE_ACCOUNTS, VALID_ACCOUNTS],
        "SELECT * FROM bronze_accounts EXCEPT SELECT * FROM valid_accounts",
    ),
    "accounts_quarantine_detail": with_(
        [RAW_ACCOUNTS, BRONZE_ACCOUNTS],
        "SELECT *, array_to_string(list_filter(["
        + ", ".join(
            f"CASE WHEN NOT coalesce(({pred}), false) THEN '{name}' END"
            for name, pred in RULES.items()
        )
        + f"], lambda x: x IS NOT NULL), ',') AS failed_rules"
        + f" FROM bronze_accounts WHERE NOT ({VALID})",
    ),
    "accounts_quarantine_reasons": with_(
        [RAW_ACCOUNTS, BRONZE_ACCOUNTS],
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce(({pred}), false))"
            f" AS failed_records FROM bronze_accounts"
            for name, pred in RULES.items()
        ),
    ),
    "accounts_run_summary": with_(
        [RAW_ACCOUNTS, BRONZE_ACCOUNTS],
        f"""SELECT bronze_records, valid_records, quarantined_records,
          CASE WHEN bronze_records > 0
               THEN ((valid_records * 2000 + bronze_records) // (2 * bronze_records)) / 10
          END AS processing_rate_pct
        FROM (SELECT count(*) AS bronze_records,
                     count(*) FILTER (WHERE {VALID}) AS valid_records,
                     count(*) FILTER (WHERE NOT ({VALID})) AS quarantined_records
              FROM bronze_accounts)""",
    ),
    "silver_accounts": with_(ACCOUNTS_BASE, "SELECT * FROM silver"),
    "gold_accounts": with_(ACCOUNTS_BASE + [GOLD], "SELECT * FROM gold"),
    "gold_country_analytics": with_(ACCOUNTS_BASE + [COUNTRY], "SELECT * FROM country_analytics"),
    "gold_size_analytics": with_(ACCOUNTS_BASE + [SIZE], "SELECT * FROM size_analytics"),
    "report_country": with_(
        ACCOUNTS_BASE + [COUNTRY],
        """SELECT country, total_accounts, total_revenue, revenue_rank
           FROM country_analytics ORDER BY revenue_rank""",
    ),
    "report_size": with_(
        ACCOUNTS_BASE + [SIZE],
        """SELECT company_size, total_accounts, pct_of_total_accounts, total_revenue,
                  pct_of_total_revenue
           FROM size_analytics ORDER BY size_order""",
    ),
    "report_size_distribution": with_(
        ACCOUNTS_BASE + [GOLD],
        f"""SELECT company_size, count(*) AS "count",
                  round({REVENUE} / count(annual_revenue_abs), 2) AS avg_revenue
           FROM gold GROUP BY company_size ORDER BY avg_revenue DESC NULLS LAST""",
    ),
    "accounts_sample": with_(
        ACCOUNTS_BASE, "SELECT * FROM silver ORDER BY account_id NULLS FIRST LIMIT 5"
    ),
    "accounts_upsert": with_(
        ACCOUNTS_BASE
        + [
            "previous_input AS (SELECT * REPLACE (AnnualRevenue / 2 AS AnnualRevenue)"
            f" FROM bronze_accounts WHERE coalesce(({RULES['has_account_id']}), false)"
            " AND AccountIndustry IS NOT NULL)",
            f"previous AS ({silver_select('previous_input', 'AnnualRevenue', AS_OF_PREVIOUS)})",
        ],
        """SELECT * FROM previous p
           WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.account_id = p.account_id)
           UNION ALL
           SELECT * FROM silver""",
    ),
    "bronze_accounts_upsert": with_(
        [
            RAW_ACCOUNTS,
            BRONZE_ACCOUNTS,
            "feed AS (SELECT * FROM bronze_accounts WHERE AccountType IS NOT NULL)",
        ],
        f"""SELECT * REPLACE ({AS_OF_PREVIOUS} AS ingestion_timestamp) FROM bronze_accounts p
           WHERE AccountIndustry IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM feed s WHERE s.AccountId = p.AccountId)
           UNION ALL
           SELECT * FROM feed""",
    ),
    "gold_accounts_upsert": with_(
        ACCOUNTS_BASE
        + [
            GOLD,
            "current AS (SELECT * FROM gold WHERE account_type = 'Enterprise')",
            "yesterday_input AS (SELECT * FROM valid_accounts WHERE AccountIndustry IS NOT NULL)",
            f"yesterday AS ({silver_select('yesterday_input', 'AnnualRevenue', AS_OF_PREVIOUS)})",
        ],
        """SELECT account_id, account_name, account_type, industry, country, hq_country,
             employee_count, company_size, annual_revenue_abs, revenue_tier, processed_timestamp
           FROM yesterday y
           WHERE NOT EXISTS (SELECT 1 FROM current c WHERE c.account_id = y.account_id)
           UNION ALL
           SELECT * FROM current""",
    ),
    "orders_quarantine_detail": with_(
        [BRONZE_ORDERS],
        """SELECT *, array_to_string(list_filter([
                 CASE WHEN NOT coalesce(quantity > 0, false) THEN 'quantity_positive' END,
                 CASE WHEN NOT coalesce(order_date IS NULL
                     OR try_cast(order_date AS TIMESTAMP) IS NOT NULL, false)
                      THEN 'order_date_parses' END], lambda x: x IS NOT NULL), ',')
                 AS failed_rules
           FROM bronze_orders
           WHERE NOT (coalesce(quantity > 0, false) AND coalesce(order_date IS NULL
                 OR try_cast(order_date AS TIMESTAMP) IS NOT NULL, false))""",
    ),
    "orders_quarantine_reasons": with_(
        [BRONZE_ORDERS],
        """SELECT 'quantity_positive' AS rule,
                  count(*) FILTER (WHERE NOT coalesce(quantity > 0, false)) AS failed_records
           FROM bronze_orders
           UNION ALL
           SELECT 'order_date_parses',
                  count(*) FILTER (WHERE NOT coalesce(order_date IS NULL
                      OR try_cast(order_date AS TIMESTAMP) IS NOT NULL, false))
           FROM bronze_orders""",
    ),
    "customers_landing_rescue": with_(
        [BRONZE_CUSTOMERS],
        """SELECT
          CASE WHEN customer_id % 31 = 0 OR (customer_id % 9 = 0 AND customer_id % 7 <> 0) THEN NULL
               ELSE CAST(customer_id AS INTEGER) END AS customer_id,
          CASE WHEN customer_id % 31 <> 0 THEN first_name END AS first_name,
          CASE WHEN customer_id % 31 <> 0 THEN last_name END AS last_name,
          CASE WHEN customer_id % 31 <> 0 THEN coalesce(city, '?') END AS city,
          CAST(NULL AS VARCHAR) AS status,
          CASE WHEN customer_id % 31 = 0
                 THEN concat('{"customer_id":', customer_id, ',"first_name":"', first_name,
                             '","last_name":"', last_name, '","city":"', coalesce(city, '?'), '"')
               WHEN customer_id % 7 = 0
                 THEN concat('{"loyalty":"gold","points":"', customer_id % 5, '"}')
               WHEN customer_id % 9 = 0 THEN concat('{"customer_id":"n', customer_id, '"}')
          END AS _rescued_data
        FROM bronze_customers""",
    ),
    "products_landing_rescue": with_(
        [BRONZE_PRODUCTS],
        """SELECT CAST(product_id AS INTEGER) AS product_id, product_name,
          CASE WHEN product_id % 2 = 0 THEN category END AS category,
          CASE WHEN product_id % 10 <> 0 THEN price END AS price,
          CASE WHEN product_id % 2 = 0 THEN CAST(stock_quantity AS INTEGER) END AS stock_quantity,
          CASE WHEN product_id % 10 = 0 THEN '{"price":"on request"}'
               WHEN product_id % 2 = 1 AND product_id % 3 = 0
                 THEN concat('{"promo":"promo, ', product_id, '"}') END AS _rescued_data
        FROM bronze_products""",
    ),
    "dim_customers": with_([BRONZE_CUSTOMERS, DIM_CUSTOMERS], "SELECT * FROM dim_customers"),
    "dim_products": with_([BRONZE_PRODUCTS, DIM_PRODUCTS], "SELECT * FROM dim_products"),
    "fact_orders": with_(SALES_BASE, "SELECT * FROM fact"),
    "fact_orders_missing_dims": with_(
        [BRONZE_CUSTOMERS, BRONZE_PRODUCTS, BRONZE_ORDERS, DIM_CUSTOMERS, DIM_PRODUCTS]
        + [
            FACT.replace("LEFT JOIN dim_customers c", "LEFT JOIN active c").replace(
                "LEFT JOIN dim_products p", "LEFT JOIN available p"
            ).replace(
                "fact AS (",
                "active AS (SELECT * FROM dim_customers WHERE is_active),\n"
                "available AS (SELECT * FROM dim_products WHERE is_available),\nfact AS (",
            )
        ],
        "SELECT * FROM fact",
    ),
    "daily_sales_summary": with_(SALES_BASE, DAILY_SALES_SUMMARY_SQL),
    "report_daily_sales": with_(SALES_BASE, DAILY_SALES_SUMMARY_SQL + " ORDER BY order_date_only"),
    "customer_metrics": with_(SALES_BASE, CUSTOMER_METRICS_SQL),
    "product_performance": with_(SALES_BASE + [PRODUCT_TOTALS], PRODUCT_PERFORMANCE_SQL),
    "product_performance_window": with_(
        SALES_BASE + [PRODUCT_TOTALS],
        f"""SELECT *, CAST(dense_rank() OVER (ORDER BY total_revenue DESC NULLS LAST)
                           AS INTEGER) AS revenue_rank,
                   {AS_OF} AS _aggregated_at
            FROM product_totals""",
    ),
    "product_rank_global": with_(SALES_BASE + [PRODUCT_TOTALS], PRODUCT_RANK_GLOBAL_SQL),
}
