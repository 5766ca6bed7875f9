"""Declared schemas of the four raw feeds.

Fixed values: field names, order, types and nullability are the feed
contract that downstream layers and stored tables depend on.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: feed contracts -------------------------------------------
ACCOUNTS = StructType(
    [
        StructField("AccountId", StringType(), True),
        StructField("AccountName", StringType(), True),
        StructField("AccountIndustry", StringType(), True),
        StructField("AccountType", StringType(), True),
        StructField("AccountHQCountry", StringType(), True),
        StructField("AccountCountry", StringType(), True),
        StructField("NumberOfEmployees", IntegerType(), True),
        StructField("AnnualRevenue", DoubleType(), True),
    ]
)

CUSTOMERS = StructType(
    [
        StructField("customer_id", IntegerType(), False),
        StructField("first_name", StringType(), True),
        StructField("last_name", StringType(), True),
        StructField("email", StringType(), True),
        StructField("phone", StringType(), True),
        StructField("city", StringType(), True),
        StructField("state", StringType(), True),
        StructField("status", StringType(), True),
    ]
)

PRODUCTS = StructType(
    [
        StructField("product_id", IntegerType(), False),
        StructField("product_name", StringType(), True),
        StructField("category", StringType(), True),
        StructField("subcategory", StringType(), True),
        StructField("price", DoubleType(), True),
        StructField("stock_quantity", IntegerType(), True),
        StructField("status", StringType(), True),
    ]
)

ORDERS = StructType(
    [
        StructField("order_id", IntegerType(), False),
        StructField("customer_id", IntegerType(), True),
        StructField("product_id", IntegerType(), True),
        StructField("quantity", IntegerType(), True),
        StructField("unit_price", DoubleType(), True),
        StructField("order_date", StringType(), True),
        StructField("status", StringType(), True),
        StructField("payment_method", StringType(), True),
    ]
)

# Source-system labels stamped on each sales feed.
SOURCE_SYSTEMS = {"customers": "CRM", "products": "INVENTORY", "orders": "ORDERS"}
ACCOUNTS_SOURCE_SYSTEM = "source_crm"
# -----------------------------------------------------------------------------
