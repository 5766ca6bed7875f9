import json

from strata.__main__ import main


def test_star_jobs(spark, fresh_schema, capsys):
    main(["--as-of", "2024-01-01 00:00:00", "star", "--schema", fresh_schema,
          "--star-dir", "/root/testdata/sf0.001"])
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    by_job = {x["job"]: x for x in lines}
    acc = by_job["accounts"]
    assert acc["rows"]["bronze_accounts"] == spark.table(f"{fresh_schema}.bronze_accounts").count()
    assert acc["summary"]["valid_records"] + acc["summary"]["quarantined_records"] == acc["summary"]["bronze_records"]
    sales = by_job["sales"]
    assert sales["rows"]["fact_orders"] > 0
    assert spark.table(f"{fresh_schema}.product_performance").filter("revenue_rank = 1").count() >= 1
