"""Accounts layers on the sample feed: expected values worked out by hand
(and with independent SQL) from the sample rows."""

import datetime as dt

import pytest

from strata.plans import accounts as acc
from tests.fixtures import AS_OF, accounts_df, by_key


@pytest.fixture(scope="module")
def silver(spark):
    bronze = acc.bronze_accounts(accounts_df(spark), AS_OF)
    return acc.silver_accounts(acc.split_accounts(bronze).valid, AS_OF).cache()


def test_bronze_stamps(spark):
    bronze = acc.bronze_accounts(accounts_df(spark), AS_OF)
    assert bronze.columns[-3:] == ["ingestion_timestamp", "source_system", "_rescued_data"]
    rows = bronze.collect()
    assert len(rows) == 12
    assert {r.source_system for r in rows} == {"source_crm"}
    assert {r.ingestion_timestamp for r in rows} == {dt.datetime(2024, 2, 1, 6, 0)}
    assert all(r._rescued_data is None for r in rows)


def test_split_and_summary(spark):
    bronze = acc.bronze_accounts(accounts_df(spark), AS_OF)
    split = acc.split_accounts(bronze)
    assert split.valid.count() == 11
    bad = split.quarantine_with_reasons().collect()
    assert [r.AccountId for r in bad] == ["ACC011"]
    assert bad[0].failed_rules == [
        "has_account_name",
        "employees_not_negative",
        "revenue_not_negative",
    ]
    s = split.summary().first().asDict()
    assert s == {
        "bronze_records": 12,
        "valid_records": 11,
        "quarantined_records": 1,
        "processing_rate_pct": 91.7,
    }
    counts = {r.rule: r.failed_records for r in split.failure_counts().collect()}
    assert counts == {
        "has_account_id": 0,
        "has_account_name": 1,
        "employees_not_negative": 1,
        "revenue_not_negative": 1,
    }


EXPECTED_SILVER = {
    # id: industry, hq, country, employees, revenue_abs, size, tier
    "ACC001": ("Technology", "USA", "USA", 5000, 50000000.0, "Large", 2),
    "ACC002": ("Technology", "UK", "UK", 3000, 35000000.0, "Large", 2),
    "ACC003": ("Software", "GERMANY", "GERMANY", 500, 8000000.0, "Medium", 3),
    "ACC004": ("Cloud Services", "USA", "CANADA", 150, 2500000.0, "Medium", 3),
    "ACC005": ("Analytics", "JAPAN", "JAPAN", 2000, 25000000.0, "Large", 2),
    "ACC006": ("Technology", "GERMANY", "GERMANY", 25, 500000.0, "Small", 4),
    "ACC007": ("Conglomerate", "USA", "USA", 50000, 500000000.0, "Enterprise", 1),
    "ACC008": ("Consulting", "FRANCE", "FRANCE", 75, 1200000.0, "Small", 3),
    "ACC009": ("Technology", "UK", "UK", 800, 12000000.0, "Medium", 2),
    "ACC010": ("Analytics", "USA", "USA", 1500, 18000000.0, "Large", 2),
    "ACC012": ("Unknown", "", "", 0, 0.0, "Micro", 4),
}


def test_silver_values(silver):
    assert silver.columns == acc.SILVER_COLUMNS
    rows = by_key(silver, "account_id")
    assert set(rows) == set(EXPECTED_SILVER)
    for key, (ind, hq, country, emp, rev, size, tier) in EXPECTED_SILVER.items():
        r = rows[key]
        got = (
            r["industry"],
            r["hq_country"],
            r["country"],
            r["employee_count"],
            r["annual_revenue_abs"],
            r["company_size"],
            acc.TIER_ORDER.index(r["revenue_tier"]) + 1,
        )
        assert got == (ind, hq, country, emp, rev, size, tier), key
    assert rows["ACC012"]["account_type"] == "Enterprise"
    assert rows["ACC001"]["account_name"] == "Acme Corporation"


def test_gold_accounts_columns(silver):
    gold = acc.gold_accounts(silver)
    assert gold.columns == acc.GOLD_COLUMNS
    assert gold.count() == 11


def test_country_analytics(silver):
    out = by_key(acc.gold_country_analytics(silver, AS_OF), "country")
    usa = out["USA"]
    assert usa["total_accounts"] == 3
    assert usa["unique_industries"] == 3
    assert usa["total_employees"] == 56500
    assert usa["avg_employees_per_account"] == pytest.approx(18833.333333)
    assert usa["max_employees"] == 50000
    assert usa["total_revenue"] == 568000000.0
    assert (usa["enterprise_accounts"], usa["large_accounts"]) == (1, 2)
    assert (usa["revenue_rank"], usa["accounts_rank"]) == (1, 1)
    assert usa["revenue_per_employee"] == 10053.1
    ranks = {k: (v["revenue_rank"], v["accounts_rank"]) for k, v in out.items()}
    assert ranks == {
        "USA": (1, 1),
        "UK": (2, 2),
        "JAPAN": (3, 4),
        "GERMANY": (4, 2),
        "CANADA": (5, 4),
        "FRANCE": (6, 4),
        "": (7, 4),
    }
    assert out["UK"]["revenue_per_employee"] == 12368.42
    assert out["GERMANY"]["revenue_per_employee"] == 16190.48
    assert out[""]["revenue_per_employee"] == 0.0
    assert out[""]["micro_accounts"] == 1


def test_size_analytics(silver):
    out = by_key(acc.gold_size_analytics(silver, AS_OF), "company_size")
    assert {k: v["size_order"] for k, v in out.items()} == {
        "Enterprise": 1,
        "Large": 2,
        "Medium": 3,
        "Small": 4,
        "Micro": 5,
    }
    large = out["Large"]
    assert (large["total_accounts"], large["unique_countries"], large["unique_industries"]) == (4, 3, 2)
    assert (large["total_employees"], large["min_employees"], large["max_employees"]) == (11500, 1500, 5000)
    assert large["avg_employees"] == 2875.0
    assert large["total_revenue"] == 128000000.0
    assert round(large["revenue_stddev"], 2) == 13880441.88 and large["revenue_stddev"] != 13880441.88
    assert large["tier2_accounts"] == 4
    assert large["pct_of_total_accounts"] == 36.36
    assert large["pct_of_total_revenue"] == 19.63
    assert large["revenue_per_employee"] == 11130.43
    assert out["Enterprise"]["revenue_stddev"] is None
    assert out["Enterprise"]["pct_of_total_revenue"] == 76.66
    assert round(out["Medium"]["revenue_stddev"], 2) == 4769696.01
    assert round(out["Small"]["revenue_stddev"], 2) == 494974.75
    assert out["Micro"]["revenue_per_employee"] == 0.0
    assert out["Micro"]["pct_of_total_revenue"] == 0.0
    assert sum(v["pct_of_total_accounts"] for v in out.values()) == pytest.approx(100, abs=0.05)


def test_reports(silver):
    country = acc.report_country(acc.gold_country_analytics(silver, AS_OF)).collect()
    assert [r.country for r in country][:2] == ["USA", "UK"]
    assert country[0].asDict().keys() == {"country", "total_accounts", "total_revenue", "revenue_rank"}
    size = acc.report_size(acc.gold_size_analytics(silver, AS_OF)).collect()
    assert [r.company_size for r in size] == ["Enterprise", "Large", "Medium", "Small", "Micro"]
    dist = acc.report_size_distribution(acc.gold_accounts(silver)).collect()
    assert [(r.company_size, r["count"], r.avg_revenue) for r in dist] == [
        ("Enterprise", 1, 500000000.0),
        ("Large", 4, 32000000.0),
        ("Medium", 3, 7500000.0),
        ("Small", 2, 850000.0),
        ("Micro", 1, 0.0),
    ]


def test_sample_is_first_five_by_key(silver):
    assert [r.account_id for r in acc.sample(silver, "account_id").collect()] == [
        "ACC001",
        "ACC002",
        "ACC003",
        "ACC004",
        "ACC005",
    ]
