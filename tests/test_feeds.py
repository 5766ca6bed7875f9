"""No input row is lost on the way into bronze."""

from strata.plans import queries, sales
from strata.sources import feeds


def _write(spark, base, name, rows):
    spark.createDataFrame(rows, feeds.STAR_SCHEMAS[name]).write.parquet(f"{base}/{name}.parquet")


def test_orphans_are_kept(spark, tmp_path):
    base = str(tmp_path)
    _write(spark, base, "region", [(0, "EUROPE")])
    _write(spark, base, "nation", [(1, "FRANCE", 0), (2, "NOWHERE", 9)])
    _write(spark, base, "customer", [(k, f"C#{k}", n, 5.0, "AUTO") for k, n in ((1, 1), (2, 2), (3, 77), (4, None))])
    _write(spark, base, "orders", [(10, 1, "F", 9.0, None, "1-URGENT")])
    line = lambda o, q: (o, 5, 6, 1, q, 10.0, 0.0, 0.0, "N", "O", None)
    _write(spark, base, "lineitem", [line(10, 3.0), line(99, 4.0), line(None, 1.0)])
    assert queries.bronze_accounts(spark, base).count() == 4
    got = {r.customer_id: (r.city, r.state) for r in queries.bronze_customers(spark, base).collect()}
    assert got == {1: ("FRANCE", "EUROPE"), 2: ("NOWHERE", None), 3: (None, None), 4: (None, None)}
    orders = queries.bronze_orders(spark, base)
    assert sorted(((r.order_id or 0, r.customer_id, r.status) for r in orders.collect()), key=lambda x: x[0]) == [
        (0, None, None), (10, 1, "delivered"), (99, None, None),
    ]
    split = sales.split_orders(orders)
    assert split.valid.count() + split.quarantine.count() == 3
