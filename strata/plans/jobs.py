"""Job runners: the layer order of each job as plain driver code.

Each step writes a table and the next step reads it back by name, so a
step can be rerun on its own and a failure never recomputes earlier steps.
Row counts are observed during the writes (no extra passes).  Steps that
do not depend on each other (the feeds, the dimensions, the gold tables) run side
by side (``plans.branches``).  A run may have a name: a rerun under that
name goes on at the steps that had not finished.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import accounts as acc
from strata.plans import sales
from strata.plans.branches import MAX_PARALLEL, Step, StepLog
from strata.operators.quality import rate_pct
from strata.sources.colocated import check_colocated, save_spread_dimension, save_spread_facts
from strata.sources.tables import (
    DEFAULT_KEY_BUCKETS,
    KEY_BUCKET,
    TableDoc,
    buckets_for,
    ensure_schema,
    save_overwrite,
    save_upsert,
)

AsOf = dt.datetime | str | None
# differ from run to run without a change of the row's content
AUDIT_COLUMNS = ("ingestion_timestamp", "processed_timestamp")


def _doc(tier: str, domain: str, job: str, comment: str, columns=None, **extra) -> TableDoc:
    props = {"quality_tier": tier, "data_domain": domain, "pipeline_name": job, **extra}
    return TableDoc(comment=comment, properties=props, columns=columns or {})


# The property keys of the documented tables (``quality_tier``,
# ``data_domain``, ``pipeline_name``, ``refresh_pattern``).  The contract's fifth
# key, ``table_type``, is reserved by this Spark version: ALTER TABLE refuses it
# (UNSUPPORTED_FEATURE.SET_TABLE_PROPERTY) and with
# spark.sql.legacy.notReserveProperties drops it silently.  Its value is stored
# under ``table_role``.
BRONZE_COLUMNS_DOC = {
    "AccountId": "Account key in the source system",
    "AccountName": "Account name as received",
    "AccountIndustry": "Industry as received",
    "AccountType": "Account type as received",
    "AccountHQCountry": "Country of the headquarters as received",
    "AccountCountry": "Country of operation as received",
    "NumberOfEmployees": "Employee count as received",
    "AnnualRevenue": "Annual revenue in USD as received",
    "ingestion_timestamp": "When the row was ingested",
    "source_system": "Source system label",
    "_rescued_data": "Raw text of a record that did not fit the schema",
}
SILVER_COLUMNS_DOC = {
    "account_id": "Account key, unique",
    "account_name": "Account name without surrounding blanks",
    "industry": "Industry, or Unknown",
    "account_type": "Account type, or Unknown",
    "hq_country": "Country of the headquarters in capitals, or UNKNOWN",
    "country": "Country of operation in capitals, or UNKNOWN",
    "employee_count": "Employees, 0 when not given",
    "annual_revenue": "Annual revenue in USD, 0 when not given",
    "ingestion_timestamp": "When the row was ingested",
    "source_system": "Source system label",
    "annual_revenue_abs": "Annual revenue without its sign",
    "company_size": "Size class from the employee count",
    "revenue_tier": "Tier from the absolute annual revenue",
    "processed_timestamp": "When the row was processed",
}
COUNTRY_COLUMNS_DOC = {
    "country": "Primary key: country of operation",
    "total_accounts": "Accounts in the country",
    "unique_industries": "Different industries among them",
    "total_employees": "Employees of all accounts",
    "avg_employees_per_account": "Mean employees of an account",
    "max_employees": "Employees of the largest account",
    "total_revenue": "Revenue of all accounts in USD",
    "avg_revenue_per_account": "Mean revenue of an account in USD",
    "max_revenue": "Revenue of the account that earns most, in USD",
    **{f"{x}_accounts": f"Accounts of size {x}" for x in ("enterprise", "large", "medium", "small", "micro")},
    "revenue_rank": "1 = highest total revenue; ties share a rank",
    "accounts_rank": "1 = most accounts; ties share a rank",
    "revenue_per_employee": "Total revenue over total employees, 0 without employees",
    "processed_timestamp": "When the row was computed",
}
SIZE_COLUMNS_DOC = {
    "company_size": "Primary key: size class",
    "total_accounts": "Accounts of the size",
    "unique_countries": "Different countries among them",
    "unique_industries": "Different industries among them",
    "total_employees": "Employees of all accounts",
    "avg_employees": "Mean employees of an account",
    "min_employees": "Employees of the smallest account",
    "max_employees": "Employees of the largest account",
    "total_revenue": "Revenue of all accounts in USD",
    "avg_revenue": "Mean revenue of an account in USD",
    "min_revenue": "Least revenue of an account in USD",
    "max_revenue": "Most revenue of an account in USD",
    "revenue_stddev": "Sample standard deviation of revenue",
    **{f"tier{i}_accounts": f"Accounts in revenue tier {i}" for i in (1, 2, 3, 4)},
    "size_order": "1 = Enterprise .. 5 = Micro",
    "pct_of_total_accounts": "Share of all accounts in percent",
    "pct_of_total_revenue": "Share of all revenue in percent",
    "revenue_per_employee": "Total revenue over total employees, 0 without employees",
    "processed_timestamp": "When the row was computed",
}

ACCOUNT_DOCS = {
    "bronze_accounts": _doc(
        "bronze",
        "sales",
        "accounts",
        "Raw accounts as received, with ingestion time and source system.",
        BRONZE_COLUMNS_DOC,
    ),
    "accounts_quarantine": _doc(
        "bronze",
        "sales",
        "accounts",
        "Bronze accounts failing a quality rule, with the rules they fail.",
        {**BRONZE_COLUMNS_DOC, "failed_rules": "Names of the failed rules"},
    ),
    "silver_accounts": _doc(
        "silver",
        "sales",
        "accounts",
        "Valid accounts, cleaned and classified by size and revenue tier.",
        SILVER_COLUMNS_DOC,
    ),
    "gold_accounts": _doc(
        "gold",
        "sales",
        "accounts",
        "Business-ready accounts dimension.",
        {c: SILVER_COLUMNS_DOC[c] for c in acc.GOLD_COLUMNS},
        table_role="dimension",
    ),
    "gold_country_analytics": _doc(
        "gold",
        "sales",
        "accounts",
        "Accounts aggregated per operating country.",
        COUNTRY_COLUMNS_DOC,
        table_role="aggregation",
        refresh_pattern="full_overwrite",
    ),
    "gold_size_analytics": _doc(
        "gold",
        "sales",
        "accounts",
        "Accounts aggregated per company size.",
        SIZE_COLUMNS_DOC,
        table_role="aggregation",
        refresh_pattern="full_overwrite",
    ),
}


@dataclass
class RunReport:
    rows: dict[str, int] = field(default_factory=dict)
    summary: dict[str, object] = field(default_factory=dict)


def _report(log: StepLog) -> RunReport:
    report = RunReport()
    for step, (rows, more) in log.done.items():
        report.rows[step] = rows
        report.summary.update(more)
    return report


def run_accounts_job(
    spark: SparkSession,
    raw_accounts: DataFrame,
    schema: str,
    as_of: AsOf = None,
    key_buckets: int | None = DEFAULT_KEY_BUCKETS,
    changes_only: bool = False,
    run: str | None = None,
    parallel: int = MAX_PARALLEL,
) -> RunReport:
    """bronze (upsert) -> quarantine (overwrite), silver (upsert) ->
    gold accounts (upsert), country and size analytics (overwrite).

    New upserted tables are stored by ``key_buckets`` key buckets, so each run
    rewrites only the buckets its accounts fall in (see ``save_upsert``);
    existing ones keep their layout.  ``None`` rewrites whole tables.

    With ``changes_only`` silver and gold accounts rewrite only the buckets of
    accounts that are new or changed in a column other than the audit times; an
    unchanged account keeps the times of its last change.

    ``run`` names the run, for a rerun to go on where it stopped (with the same
    arguments); ``parallel`` bounds the steps at work at once."""
    ensure_schema(spark, schema)
    t = lambda name: f"{schema}.{name}"
    log = StepLog(spark, schema, "accounts", run)

    def upserted(name: str, rows, key: str, **options) -> Step:
        return lambda: (
            save_upsert(
                rows(),
                t(name),
                [key],
                ACCOUNT_DOCS[name],
                key_buckets=buckets_for(spark, t(name), key_buckets),
                **options,
            ),
            {},
        )

    def replaced(name: str, rows) -> Step:
        return lambda: (save_overwrite(rows(), t(name), ACCOUNT_DOCS[name]), {})

    def stored(name: str) -> DataFrame:
        return spark.table(t(name)).drop(KEY_BUCKET)

    def quarantine() -> tuple[int, dict[str, object]]:
        # The quarantine write is the pass that also counts input/valid/bad rows.
        observed, quality = acc.split_accounts(stored("bronze_accounts")).observed("accounts_quality")
        rows = save_overwrite(
            observed.quarantine_with_reasons(), t("accounts_quarantine"), ACCOUNT_DOCS["accounts_quarantine"]
        )
        counts = dict(quality.get)
        rate = rate_pct(counts["valid_records"], counts["bronze_records"])
        return rows, counts | {"processing_rate_pct": rate}

    changes = {"reject_null_keys": True, "changes_only": changes_only}
    changes["ignore"] = AUDIT_COLUMNS if changes_only else ()
    valid = lambda: acc.split_accounts(stored("bronze_accounts")).valid
    silver = lambda: stored("silver_accounts")
    stages: list[dict[str, Step]] = [
        {"bronze_accounts": upserted("bronze_accounts", lambda: acc.bronze_accounts(raw_accounts, as_of), "AccountId")},
        {
            "accounts_quarantine": quarantine,
            "silver_accounts": upserted(
                "silver_accounts", lambda: acc.silver_accounts(valid(), as_of), "account_id", **changes
            ),
        },
        {
            "gold_accounts": upserted("gold_accounts", lambda: acc.gold_accounts(silver()), "account_id", **changes),
            "gold_country_analytics": replaced(
                "gold_country_analytics", lambda: acc.gold_country_analytics(silver(), as_of)
            ),
            "gold_size_analytics": replaced(
                "gold_size_analytics", lambda: acc.gold_size_analytics(silver(), as_of)
            ),
        },
    ]
    for steps in stages:
        log.run_missing(steps, parallel)
    return _report(log)


def run_sales_job(
    spark: SparkSession,
    raw_customers: DataFrame,
    raw_products: DataFrame,
    raw_orders: DataFrame,
    schema: str,
    as_of: AsOf = None,
    partition_facts_by_month: bool = False,
    unique_dims: bool = False,
    spread_null_keys: bool = False,
    run: str | None = None,
    parallel: int = MAX_PARALLEL,
    customer_buckets: int | None = None,
    spread: int = 16,
) -> RunReport:
    """Three bronze feeds -> two dimensions -> facts -> three gold tables,
    every table a full refresh.  Optionally the fact table is stored
    partitioned by order month, so date-bounded reads prune files, and the
    fact build fails on a repeated dimension key (``unique_dims``).  ``run`` and
    ``parallel`` as for the accounts.

    With ``customer_buckets`` the raw orders are stored in that many buckets by
    customer, a hot customer in up to ``spread`` of them, and the customers beside
    them (``dim_customers_spread``), so the fact build does not shuffle orders for
    its customer join (``sources/colocated.py``)."""
    ensure_schema(spark, schema)
    log = StepLog(spark, schema, "sales", run)
    stored = lambda name: spark.table(f"{schema}.{name}")

    def replaced(name: str, rows, partition_by: tuple[str, ...] = ()) -> Step:
        return lambda: (save_overwrite(rows(), f"{schema}.{name}", partition_by=partition_by), {})

    def facts() -> DataFrame:
        if customer_buckets:
            check_colocated(spark, f"{schema}.raw_orders", f"{schema}.dim_customers_spread", "customer_id")
        fact = sales.fact_orders(
            stored("raw_orders"),
            stored("dim_customers_spread" if customer_buckets else "dim_customers"),
            stored("dim_products"),
            as_of,
            unique_dims=unique_dims,
            spread_null_keys=spread_null_keys,
        )
        if partition_facts_by_month:
            fact = fact.withColumn("order_month", F.date_trunc("month", "order_date_only").cast("date"))
        return fact

    def spread_orders() -> tuple[int, dict[str, object]]:
        rows = sales.bronze_sales(raw_orders, "orders", as_of)
        return save_spread_facts(rows, f"{schema}.raw_orders", "customer_id", customer_buckets, spread), {}

    def spread_customers() -> tuple[int, dict[str, object]]:
        dim, name = stored("dim_customers"), f"{schema}.dim_customers_spread"
        return save_spread_dimension(dim, name, "customer_id", customer_buckets, spread), {}

    feeds = {"customers": raw_customers, "products": raw_products, "orders": raw_orders}
    gold = ("daily_sales_summary", "customer_metrics", "product_performance")
    stages: list[dict[str, Step]] = [
        {
            f"raw_{feed}": replaced(f"raw_{feed}", lambda feed=feed, raw=raw: sales.bronze_sales(raw, feed, as_of))
            for feed, raw in feeds.items()
        },
        {
            "dim_customers": replaced("dim_customers", lambda: sales.dim_customers(stored("raw_customers"), as_of)),
            "dim_products": replaced("dim_products", lambda: sales.dim_products(stored("raw_products"), as_of)),
        },
        {"dim_customers_spread": spread_customers} if customer_buckets else {},
        {"fact_orders": replaced("fact_orders", facts, ("order_month",) if partition_facts_by_month else ())},
        {name: replaced(name, lambda name=name: getattr(sales, name)(stored("fact_orders"), as_of)) for name in gold},
    ]
    if customer_buckets:
        stages[0]["raw_orders"] = spread_orders
    for steps in filter(None, stages):
        log.run_missing(steps, parallel)
    return _report(log)
