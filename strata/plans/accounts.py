"""Accounts: raw feed -> bronze -> quality split -> silver -> gold tables and
reports.

All transforms are pure and, but for the ranks of ``gold_country_analytics``,
lazy.  Everything before the gold aggregates is row-local, so the only
shuffles are the two group-bys (with map-side partial aggregation), the
distinct counts' two-level aggregation, the range ranks, and - for
``quarantine_distinct`` only - one distinct over the failing rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import (
    as_of_literal,
    bucketize,
    count_each,
    guarded_ratio,
    non_empty,
    ordinal,
    share_of_total,
    trimmed_or,
)
from strata.functions.columns import WIDE_MONEY, money_stddev, money_sum
from strata.operators.quality import QualitySplit, Rule, split
from strata.operators.ranking import Ranking, rank_measures

AsOf = dt.datetime | str | None

# --- fixed values: classifications and defaults ---------------------------------
COMPANY_SIZES = [(10000, "Enterprise"), (1000, "Large"), (100, "Medium"), (10, "Small")]
COMPANY_SIZE_FLOOR = "Micro"
SIZE_ORDER = ["Enterprise", "Large", "Medium", "Small", "Micro"]
REVENUE_TIERS = [
    (100000000, "Tier 1 - $100M+"),
    (10000000, "Tier 2 - $10M-$100M"),
    (1000000, "Tier 3 - $1M-$10M"),
]
REVENUE_TIER_FLOOR = "Tier 4 - Under $1M"
TIER_ORDER = [label for _, label in REVENUE_TIERS] + [REVENUE_TIER_FLOOR]
UNKNOWN = "Unknown"
UNKNOWN_COUNTRY = "UNKNOWN"
# ---------------------------------------------------------------------------------

# The silver and gold columns, in order; the output names of the
# aggregates below are fixed as well.
SILVER_COLUMNS = [
    "account_id",
    "account_name",
    "industry",
    "account_type",
    "hq_country",
    "country",
    "employee_count",
    "annual_revenue",
    "ingestion_timestamp",
    "source_system",
    "annual_revenue_abs",
    "company_size",
    "revenue_tier",
    "processed_timestamp",
]

GOLD_COLUMNS = [
    "account_id",
    "account_name",
    "account_type",
    "industry",
    "country",
    "hq_country",
    "employee_count",
    "company_size",
    "annual_revenue_abs",
    "revenue_tier",
    "processed_timestamp",
]


# --- bronze ------------------------------------------------------------------------


def bronze_accounts(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Raw accounts stamped with ingestion time, source system and a rescue
    column: kept when the reader filled it (``sources.intake``), else NULL."""
    rescue = "_rescued_data"
    rescued = F.col(rescue) if rescue in raw.columns else F.lit(None).cast("string")
    return raw.select(
        *[c for c in raw.columns if c != rescue],
        as_of_literal(as_of).alias("ingestion_timestamp"),
        F.lit(schemas.ACCOUNTS_SOURCE_SYSTEM).alias("source_system"),
        rescued.alias(rescue),
    )


# --- quality ------------------------------------------------------------------------


def account_rules() -> list[Rule]:
    """Validity of a bronze account.  The name is checked before trimming,
    so a blank-only name passes."""
    employees = F.col("NumberOfEmployees")
    revenue = F.col("AnnualRevenue")
    return [
        Rule("has_account_id", non_empty("AccountId")),
        Rule("has_account_name", non_empty("AccountName")),
        Rule("employees_not_negative", employees.isNull() | (employees >= 0)),
        Rule("revenue_not_negative", revenue.isNull() | (revenue >= 0)),
    ]


def split_accounts(bronze: DataFrame) -> QualitySplit:
    return split(bronze, account_rules())


def quarantine_reason_counts(bronze: DataFrame) -> DataFrame:
    return split_accounts(bronze).failure_counts()


def run_summary(bronze: DataFrame) -> DataFrame:
    return split_accounts(bronze).summary()


# --- silver ---------------------------------------------------------------------------


def company_size(employees: str = "employee_count"):
    return bucketize(employees, COMPANY_SIZES, COMPANY_SIZE_FLOOR)


def revenue_tier(revenue: str = "annual_revenue_abs"):
    return bucketize(revenue, REVENUE_TIERS, REVENUE_TIER_FLOOR)


def silver_accounts(valid: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Cleansed, snake_case accounts with size and revenue classes."""
    revenue = F.coalesce(F.col("AnnualRevenue"), F.lit(0.0))
    return (
        valid.select(
            F.col("AccountId").alias("account_id"),
            F.trim("AccountName").alias("account_name"),
            trimmed_or("AccountIndustry", UNKNOWN).alias("industry"),
            trimmed_or("AccountType", UNKNOWN).alias("account_type"),
            trimmed_or("AccountHQCountry", UNKNOWN_COUNTRY, upper=True).alias("hq_country"),
            trimmed_or("AccountCountry", UNKNOWN_COUNTRY, upper=True).alias("country"),
            F.coalesce(F.col("NumberOfEmployees"), F.lit(0)).alias("employee_count"),
            revenue.alias("annual_revenue"),
            "ingestion_timestamp",
            "source_system",
            F.abs(revenue).alias("annual_revenue_abs"),
        )
        .withColumns(
            {
                "company_size": company_size(),
                "revenue_tier": revenue_tier(),
                "processed_timestamp": as_of_literal(as_of),
            }
        )
        .select(*SILVER_COLUMNS)
    )


def previous_silver_state(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    """An earlier version of the silver table, for upsert scenarios: built a
    day before ``as_of`` under the older, id-only rule from the accounts that
    had an industry then, with half the revenue they report now."""
    earlier = None
    if as_of is not None:
        when = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        earlier = when - dt.timedelta(days=1)
    older = bronze.filter(
        Rule("has_account_id", non_empty("AccountId")).passed()
        & F.col("AccountIndustry").isNotNull()
    ).withColumn("AnnualRevenue", F.col("AnnualRevenue") / 2)
    return silver_accounts(older, earlier)


# --- gold -------------------------------------------------------------------------------


def gold_accounts(silver: DataFrame) -> DataFrame:
    return silver.select(*GOLD_COLUMNS)


def gold_country_analytics(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Per-country measures, size mix and two whole-table ranks.

    ``country`` is free text, so the number of countries is not bounded: the
    ranks are numbered by ranges (``rank_measures``, both in one pass, which runs
    jobs when called), never in one task.  Revenue is summed to the cent, exactly, so
    that ties do not depend on how rows are partitioned."""
    sizes = [(label, f"{label.lower()}_accounts") for label in SIZE_ORDER]
    revenue = money_sum("annual_revenue_abs", WIDE_MONEY)
    per_country = silver.groupBy("country").agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.count_distinct("industry").alias("unique_industries"),
        F.sum("employee_count").alias("total_employees"),
        F.avg("employee_count").alias("avg_employees_per_account"),
        F.max("employee_count").alias("max_employees"),
        revenue.alias("total_revenue"),
        (revenue / F.count("annual_revenue_abs")).alias("avg_revenue_per_account"),
        F.max("annual_revenue_abs").alias("max_revenue"),
        *count_each("company_size", sizes),
    )
    ranked = rank_measures(
        per_country,
        [Ranking("total_revenue", "revenue_rank"), Ranking("total_accounts", "accounts_rank")],
    )
    return ranked.withColumns(
        {
            "revenue_rank": F.col("revenue_rank").cast("int"),
            "accounts_rank": F.col("accounts_rank").cast("int"),
            "revenue_per_employee": guarded_ratio("total_revenue", "total_employees"),
            "processed_timestamp": as_of_literal(as_of),
        }
    )


def gold_size_analytics(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Per-size measures, tier mix and shares of the whole.

    The totals behind the shares are window sums over the five aggregated
    rows, so the whole table is one plan and one pass over ``silver``
    (no driver round trips); a zero total gives a NULL share."""
    tiers = [(label, f"tier{i}_accounts") for i, label in enumerate(TIER_ORDER, start=1)]
    revenue = money_sum("annual_revenue_abs", WIDE_MONEY)
    per_size = silver.groupBy("company_size").agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.count_distinct("country").alias("unique_countries"),
        F.count_distinct("industry").alias("unique_industries"),
        F.sum("employee_count").alias("total_employees"),
        F.avg("employee_count").alias("avg_employees"),
        F.min("employee_count").alias("min_employees"),
        F.max("employee_count").alias("max_employees"),
        revenue.alias("total_revenue"),
        (revenue / F.count("annual_revenue_abs")).alias("avg_revenue"),
        F.min("annual_revenue_abs").alias("min_revenue"),
        F.max("annual_revenue_abs").alias("max_revenue"),
        money_stddev("annual_revenue_abs").alias("revenue_stddev"),
        *count_each("revenue_tier", tiers),
    )
    return per_size.withColumns(
        {
            "size_order": ordinal("company_size", SIZE_ORDER),
            "pct_of_total_accounts": share_of_total("total_accounts"),
            "pct_of_total_revenue": share_of_total("total_revenue"),
            "revenue_per_employee": guarded_ratio("total_revenue", "total_employees"),
            "processed_timestamp": as_of_literal(as_of),
        }
    )


# --- reports ------------------------------------------------------------------------------


def report_country(country_analytics: DataFrame) -> DataFrame:
    return country_analytics.orderBy("revenue_rank").select(
        "country", "total_accounts", "total_revenue", "revenue_rank"
    )


def report_size(size_analytics: DataFrame) -> DataFrame:
    return size_analytics.orderBy("size_order").select(
        "company_size",
        "total_accounts",
        "pct_of_total_accounts",
        "total_revenue",
        "pct_of_total_revenue",
    )


def report_size_distribution(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("company_size")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.round(
                money_sum("annual_revenue_abs", WIDE_MONEY) / F.count("annual_revenue_abs"), 2
            ).alias("avg_revenue"),
        )
        .orderBy(F.desc("avg_revenue"))
    )


def sample(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by ``key`` (a top-k: each task keeps ``n`` rows)."""
    return df.orderBy(key).limit(n)
