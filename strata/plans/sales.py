"""Sales star schema: bronze feeds -> dimensions and facts -> gold tables.

Every function is a pure ``DataFrame -> DataFrame`` transform; the caller
decides where results are stored.  ``as_of`` pins the audit timestamps so a
rerun reproduces its output (``None`` = now).

Scale notes
-----------
* ``fact_orders`` joins the lines to their dimensions: two left equi-joins.
  The planner broadcasts a dimension only when its measured size is under the
  broadcast threshold; otherwise both sides shuffle on the key and AQE splits
  skewed (hot or NULL-key) partitions.
* Gold tables aggregate order lines by key first and look dimensions up
  afterwards, one row per key (``customers`` / ``products`` arguments): lines
  are never shuffled for a join whose attributes the totals do not need, and
  the distinct counts spread a hot customer or product by its orders.
* ``product_performance`` ranks with ``global_rank`` instead of an
  unpartitioned window; that runs jobs when called, everything else is lazy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import (
    as_of_literal,
    bucketize,
    money_avg,
    money_sum,
    stamp,
)
from strata.functions.columns import MONEY
from strata.operators.quality import QualitySplit, Rule, guard_unique, split
from strata.operators.ranking import global_rank
from strata.sources.colocated import SPREAD

AsOf = dt.datetime | str | None

# --- fixed values: business classifications -----------------------------------
PRICE_TIERS = [(50, "Budget"), (200, "Mid-Range"), (500, "Premium")]
PRICE_TIER_TOP = "Luxury"
ACTIVE_STATUS = "active"
DELIVERED_STATUS = "delivered"
STATUS_COMPLETED = "Completed"
STATUS_IN_PROGRESS = "In Progress"
SEGMENT_VIP_REVENUE = 1000
SEGMENT_LOYAL_ORDERS = 2
SEGMENTS = ("VIP", "Loyal", "Regular")
# -------------------------------------------------------------------------------

# The fact table's columns, in order.
FACT_COLUMNS = [
    "product_id",
    "customer_id",
    "order_id",
    "quantity",
    "unit_price",
    "order_date",
    "status",
    "payment_method",
    "_ingested_at",
    "_source_system",
    "order_date_only",
    "line_total",
    "status_category",
    "customer_name",
    "customer_city",
    "customer_state",
    "product_name",
    "product_category",
    "price_tier",
    "_transformed_at",
]


# --- bronze ------------------------------------------------------------------------


def bronze_sales(raw: DataFrame, feed: str, as_of: AsOf = None) -> DataFrame:
    """Stamp a raw sales feed (``customers``/``products``/``orders``) with its
    ingestion time and source-system label."""
    return stamp(
        raw,
        {
            "_ingested_at": as_of_literal(as_of),
            "_source_system": schemas.SOURCE_SYSTEMS[feed],
        },
    )


# --- silver ------------------------------------------------------------------------


def dim_customers(raw_customers: DataFrame, as_of: AsOf = None) -> DataFrame:
    return raw_customers.select(
        "customer_id",
        "first_name",
        "last_name",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        F.lower("email").alias("email"),
        "phone",
        "city",
        "state",
        # NULL status is not active: two-valued on purpose.
        F.coalesce(F.col("status") == ACTIVE_STATUS, F.lit(False)).alias("is_active"),
        as_of_literal(as_of).alias("_transformed_at"),
        "_source_system",
    )


def price_tier(price: str = "price"):
    """``<50`` Budget, ``<200`` Mid-Range, ``<500`` Premium, else (and NULL)
    Luxury."""
    return bucketize(price, PRICE_TIERS, PRICE_TIER_TOP, op="<")


def dim_products(raw_products: DataFrame, as_of: AsOf = None) -> DataFrame:
    return raw_products.select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "price",
        price_tier("price").alias("price_tier"),
        "stock_quantity",
        # Three-valued on purpose: NULL status with stock > 0 gives NULL.
        ((F.col("status") == ACTIVE_STATUS) & (F.col("stock_quantity") > 0)).alias(
            "is_available"
        ),
        "status",
        as_of_literal(as_of).alias("_transformed_at"),
        "_source_system",
    )


def order_lines(raw_orders: DataFrame) -> DataFrame:
    """Positive-quantity order lines with parsed dates, line totals and
    status category (the fact before its dimension lookups)."""
    ts = F.try_to_timestamp(F.col("order_date"))
    derived = {
        "order_date": ts,
        "order_date_only": F.to_date(ts),
        "line_total": F.round(F.col("quantity") * F.col("unit_price"), 2),
        "status_category": F.when(
            F.col("status") == DELIVERED_STATUS, F.lit(STATUS_COMPLETED)
        ).otherwise(F.lit(STATUS_IN_PROGRESS)),
    }
    return raw_orders.filter(F.col("quantity") > 0).withColumns(derived)


def order_rules() -> list[Rule]:
    """Quality of an order line: a positive quantity (lines failing it are
    left out of the facts) and, when a date is present, one that parses
    (such lines stay in the facts with a NULL date)."""
    date = F.col("order_date")
    return [
        Rule("quantity_positive", F.col("quantity") > 0),
        Rule("order_date_parses", date.isNull() | F.try_to_timestamp(date).isNotNull()),
    ]


def split_orders(raw_orders: DataFrame) -> QualitySplit:
    """Order lines split by ``order_rules``: ``.quarantine_with_reasons()``
    lists the lines to review, ``.failure_counts()`` counts them per rule."""
    return split(raw_orders, order_rules())


def left_lookup(facts: DataFrame, dim: DataFrame, key: str, spread: int) -> DataFrame:
    """``facts LEFT JOIN dim USING (key)`` with NULL keys spread out.

    A NULL key never matches, but a shuffle join would still send every
    NULL-key fact to the one partition NULL hashes to - a hot partition when
    many facts lack the key.  The join runs on the pair ``(key, s)``: ``s`` is
    0 for dimension rows and non-NULL fact keys, and a deterministic hash
    bucket in ``[0, spread)`` for NULL-key facts, which therefore scatter over
    the shuffle.  Dimension rows with a NULL key (which can never match) are
    dropped first, so no NULL pair can meet another."""
    fact_cols = [c for c in facts.columns if c != key]
    salt = F.when(
        F.col(key).isNull(), F.pmod(F.xxhash64(*fact_cols), F.lit(spread)).cast("int")
    ).otherwise(F.lit(0))
    left = facts.withColumn("_lookup", F.struct(F.col(key).alias("k"), salt.alias("s")))
    right = dim.filter(F.col(key).isNotNull()).select(
        F.struct(F.col(key).alias("k"), F.lit(0).alias("s")).alias("_lookup"),
        *[c for c in dim.columns if c != key],
    )
    return left.join(right, "_lookup", "left").drop("_lookup")


def customer_lookup(dim_customers_df: DataFrame) -> DataFrame:
    return dim_customers_df.select(
        "customer_id",
        *(c for c in (SPREAD,) if c in dim_customers_df.columns),
        F.col("full_name").alias("customer_name"),
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
    )


def product_lookup(dim_products_df: DataFrame) -> DataFrame:
    return dim_products_df.select(
        "product_id",
        "product_name",
        F.col("category").alias("product_category"),
        "price_tier",
    )


def fact_orders(
    raw_orders: DataFrame,
    dim_customers_df: DataFrame,
    dim_products_df: DataFrame,
    as_of: AsOf = None,
    unique_dims: bool = False,
    spread_null_keys: bool = False,
) -> DataFrame:
    """Order lines left-joined to their customer and product attributes.

    Unmatched lines keep NULL attributes.  Only the looked-up columns of
    each dimension are read (column pruning reaches the dimension scans).
    A repeated dimension key would repeat its order lines; with
    ``unique_dims`` the job fails instead (checked inside the plan).

    Hot keys (including NULL foreign keys) in a shuffle join are split at run
    time by AQE's skew handling.  ``spread_null_keys`` scatters NULL-key lines
    explicitly instead (``left_lookup``), for sessions without AQE; it costs
    a struct join key per line (~10-20 % on this step when the dimensions
    are broadcast, where NULL keys cause no skew at all), so it is off by
    default.

    Orders and customers stored alike (``sources/colocated.py``; both have a
    ``SPREAD`` column) are joined bucket by bucket, without a shuffle of either.
    """
    alike = SPREAD in raw_orders.columns and SPREAD in dim_customers_df.columns
    if not alike:
        raw_orders, dim_customers_df = raw_orders.drop(SPREAD), dim_customers_df.drop(SPREAD)
    elif spread_null_keys:
        raise ValueError("fact_orders: orders stored alike with customers are spread already")
    customer_key = ["customer_id", SPREAD] if alike else ["customer_id"]
    customers = customer_lookup(dim_customers_df)
    products = product_lookup(dim_products_df)
    if unique_dims:
        customers = guard_unique(customers, customer_key, "dim_customers")
        products = guard_unique(products, ["product_id"], "dim_products")
    stamped = [as_of_literal(as_of).alias(c) if c == "_transformed_at" else c for c in FACT_COLUMNS]
    if not spread_null_keys:
        return (
            order_lines(raw_orders)
            .join(customers, customer_key, "left")
            .join(products, "product_id", "left")
            .select(*stamped)
        )
    spread = int(raw_orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with_customers = left_lookup(order_lines(raw_orders), customers, "customer_id", spread)
    return left_lookup(with_customers, products, "product_id", spread).select(*stamped)


# --- gold --------------------------------------------------------------------------


def completed(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("status_category") == STATUS_COMPLETED)


def daily_sales_summary(lines: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Completed sales per day, from order lines or facts; no dimension column
    is used.  Lines are first reduced to one row per day, order and customer,
    so the two distinct counts expand orders, not lines.  Unordered:
    ``report_daily_sales`` sorts."""
    orders = (
        completed(lines)
        .groupBy("order_date_only", "order_id", "customer_id")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum(F.col("line_total").cast(MONEY)).alias("revenue"),
        )
    )
    return (
        orders.groupBy("order_date_only")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("units").alias("total_units_sold"),
            F.sum("revenue").cast("double").alias("total_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .withColumn("_aggregated_at", as_of_literal(as_of))
    )


def report_daily_sales(daily: DataFrame) -> DataFrame:
    """The daily summary in date order."""
    return daily.orderBy("order_date_only")


def customer_segment(revenue: str = "total_revenue", orders: str = "total_orders"):
    return (
        F.when(F.col(revenue) >= SEGMENT_VIP_REVENUE, F.lit(SEGMENTS[0]))
        .when(F.col(orders) >= SEGMENT_LOYAL_ORDERS, F.lit(SEGMENTS[1]))
        .otherwise(F.lit(SEGMENTS[2]))
    )


CUSTOMER_LOOKUP = ("customer_name", "customer_city", "customer_state")
PRODUCT_LOOKUP = ("product_name", "product_category", "price_tier")


def _looked_up(totals: DataFrame, lookup: DataFrame, key: str, attributes, label: str) -> DataFrame:
    """One row of totals per key, with the attributes of a unique-keyed lookup."""
    joined = totals.join(guard_unique(lookup, [key], label), key, "left")
    rest = [c for c in totals.columns if c != key]
    return joined.select(key, *attributes, *rest)


def customer_totals(
    lines: DataFrame, by: tuple[str, ...] = ("customer_id", *CUSTOMER_LOOKUP)
) -> DataFrame:
    return (
        completed(lines)
        .groupBy(*by)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("total_items"),
            money_sum("line_total").alias("total_revenue"),
            money_avg("line_total").alias("avg_order_value"),
        )
    )


def customer_metrics(
    lines: DataFrame, as_of: AsOf = None, customers: DataFrame | None = None
) -> DataFrame:
    """Completed sales per customer; ``avg_order_value`` is the exact,
    half-up-rounded average line total.

    With ``customers`` (the dimension; its keys must be unique, which is
    checked) order lines are aggregated by key first and one row per customer
    is looked up: no line is shuffled for a join, and a hot customer is spread
    by its orders.  Without, ``lines`` are facts that carry the attributes."""
    if customers is None:
        totals = customer_totals(lines)
    else:
        totals = _looked_up(
            customer_totals(lines, ("customer_id",)),
            customer_lookup(customers),
            "customer_id",
            CUSTOMER_LOOKUP,
            "dim_customers",
        )
    return totals.withColumn("customer_segment", customer_segment()).withColumn(
        "_aggregated_at", as_of_literal(as_of)
    )


def product_totals(lines: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Completed sales per product; ``products`` as for ``customer_metrics``."""
    by = ("product_id", *PRODUCT_LOOKUP) if products is None else ("product_id",)
    totals = (
        completed(lines)
        .groupBy(*by)
        .agg(
            F.count_distinct("order_id").alias("times_ordered"),
            F.sum("quantity").alias("total_units_sold"),
            money_sum("line_total").alias("total_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    if products is None:
        return totals
    return _looked_up(totals, product_lookup(products), "product_id", PRODUCT_LOOKUP, "dim_products")


def product_performance(
    lines: DataFrame,
    as_of: AsOf = None,
    num_ranges: int | None = None,
    products: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Completed sales per product with a dense revenue rank over all
    products (1 = highest revenue, ties share a rank, no gaps).

    Ranking runs jobs when called (see ``global_ranks``); pass stored
    ``totals`` to rank those instead of checkpointing them."""
    ranked = global_rank(
        product_totals(lines, products) if totals is None else totals,
        "total_revenue",
        dense=True,
        output="revenue_rank",
        num_ranges=num_ranges,
        stored=totals is not None,
    )
    return ranked.withColumn("_aggregated_at", as_of_literal(as_of))
