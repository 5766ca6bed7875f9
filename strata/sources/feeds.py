"""Raw feeds.

Two ways in:

* ``read_feed`` - a landing folder of parquet/CSV/JSON with the declared
  schema (no inference, so a scan never has to touch the data to plan).
* ``*_from_star`` - the four feeds derived from a TPC-H-style star schema
  (``customer nation region part orders lineitem``) by deterministic column
  expressions.  Every input row becomes one feed row (a customer without nation
  or a line without order keeps NULLs); nothing is sampled or filtered.  Ids
  stay 64-bit.

All derivations are plain projections and equi-joins, so they scale with
the input: the small ``nation``/``region`` tables are joined by broadcast
when their measured size is under the broadcast threshold, and the
``lineitem``/``orders`` join is a shuffle join on the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The star-schema tables as stored (DDL strings).  Reading with
# a declared schema skips footer inference (one job per read otherwise).
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}
STAR_TABLES = tuple(STAR_SCHEMAS)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    path = f"{base.rstrip('/')}/{name}.parquet"
    schema = STAR_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def read_feed(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Read a landing folder with the declared schema (never inferred)."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.options(**options).load(path)


# --- star schema -> feeds ------------------------------------------------------
#
# The derivation rules below define the test feeds (which rows
# get NULL / empty / negative values, label spellings, price offset).  They
# are stated identically in the SQL oracle.


def _customer_geo(spark: SparkSession, base: str) -> DataFrame:
    customer = read_table(spark, base, "customer")
    nation = read_table(spark, base, "nation")
    region = read_table(spark, base, "region")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").join(
        region, nation.n_regionkey == region.r_regionkey, "left"
    )


def accounts_from_star(spark: SparkSession, base: str) -> DataFrame:
    """One account per customer, with deliberate quality problems."""
    k = F.col("c_custkey")
    employees = (
        F.pow(F.lit(10), k % 5).cast("int") * (F.lit(1) + k % 7).cast("int")
    )
    return _customer_geo(spark, base).select(
        F.col("c_name").alias("AccountId"),
        F.when(k % 50 == 0, F.lit(None).cast("string"))
        .when(k % 50 == 1, F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
        .alias("AccountName"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment"))
        .alias("AccountIndustry"),
        F.when(k % 4 == 0, F.lit("Enterprise"))
        .when(k % 4 == 1, F.lit("SMB"))
        .when(k % 4 == 2, F.lit("Startup"))
        .otherwise(F.lit(None).cast("string"))
        .alias("AccountType"),
        F.lower(F.col("r_name")).alias("AccountHQCountry"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.col("n_name")).alias("AccountCountry"),
        F.when(k % 17 == 0, F.lit(None).cast("int"))
        .when(k % 19 == 0, F.lit(-1))
        .otherwise(employees)
        .alias("NumberOfEmployees"),
        F.when(k % 23 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal") * 20000)
        .alias("AnnualRevenue"),
    )


def customers_from_star(spark: SparkSession, base: str) -> DataFrame:
    return _customer_geo(spark, base).select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.col("c_name"), F.lit("@EXAMPLE.COM")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.when(F.col("c_acctbal") >= 0, F.lit("active"))
        .otherwise(F.lit("inactive"))
        .alias("status"),
    )


def products_from_star(spark: SparkSession, base: str) -> DataFrame:
    part = read_table(spark, base, "part")
    price = ((F.col("p_retailprice").cast("decimal(12,2)") - 900) * 10).cast("double")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("price"),
        (F.col("p_size") - 5).alias("stock_quantity"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit("discontinued"))
        .otherwise(F.lit("active"))
        .alias("status"),
    )


def orders_from_star(spark: SparkSession, base: str) -> DataFrame:
    """One order line per ``lineitem`` row; ``order_id`` repeats per line."""
    lineitem = read_table(spark, base, "lineitem")
    orders = read_table(spark, base, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("delivered"))
        .when(F.col("o_orderstatus") == "O", F.lit("pending"))
        .when(F.col("o_orderstatus") == "P", F.lit("shipped"))
    )
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "left").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_quantity").cast("int") - 1).alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("o_orderdate").cast("string").alias("order_date"),
        status.alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
    )


FEEDS_FROM_STAR = {
    "accounts": accounts_from_star,
    "customers": customers_from_star,
    "products": products_from_star,
    "orders": orders_from_star,
}
