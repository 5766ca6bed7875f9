"""Property tests of the money helpers and the quality split."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import money_avg, money_sum
from strata.operators.quality import Rule, split

cents = st.integers(-10**9, 10**9)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(cents, min_size=0, max_size=12), min_size=1, max_size=5))
def test_money_avg_and_sum_are_exact(spark, groups):
    rows = [(g, c / 100) for g, amounts in enumerate(groups) for c in amounts]
    rows += [(g, None) for g in range(len(groups))]  # NULL amounts are ignored
    df = spark.createDataFrame(rows, "g int, amount double")
    got = {
        r.g: (r.avg, r.total)
        for r in df.groupBy("g").agg(money_avg("amount").alias("avg"), money_sum("amount").alias("total")).collect()
    }
    for g, amounts in enumerate(groups):
        if not amounts:
            assert got[g] == (None, None)
            continue
        exact = Decimal(sum(amounts)) / Decimal(len(amounts)) / 100
        want_avg = float(exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        assert got[g] == (want_avg, sum(amounts) / 100)


names = st.one_of(st.none(), st.sampled_from(["", "  ", "x", "Acme"]))
numbers = st.one_of(st.none(), st.integers(-3, 3))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(names, numbers), max_size=30))
def test_split_partitions_the_input(spark, rows):
    df = spark.createDataFrame(rows, "name string, n int")
    rules = [
        Rule("has_name", F.col("name").isNotNull() & (F.length("name") > 0)),
        Rule("n_not_negative", F.col("n").isNull() | (F.col("n") >= 0)),
    ]
    parts = split(df, rules)
    valid = sorted(map(tuple, parts.valid.collect()), key=repr)
    bad = sorted(map(tuple, parts.quarantine.collect()), key=repr)
    assert sorted(valid + bad, key=repr) == sorted(rows, key=repr)
    for name, n in valid:
        assert name and (n is None or n >= 0)
    reasons = {tuple(r)[:2]: r.failed_rules for r in parts.quarantine_with_reasons().collect()}
    for (name, n), failed in reasons.items():
        assert ("has_name" in failed) == (not name)
        assert ("n_not_negative" in failed) == (n is not None and n < 0)
    counts = {r.rule: r.failed_records for r in parts.failure_counts().collect()}
    assert counts["has_name"] == sum(1 for name, _ in rows if not name)
