"""global_rank equals the unpartitioned window on arbitrary data."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import ranking
from strata.operators.ranking import global_rank, global_ranks


def _compare(spark, values, dense, ascending, ranges, dtype="double"):
    df = spark.createDataFrame(list(enumerate(values)), f"id long, v {dtype}")
    got = global_rank(df, "v", dense=dense, ascending=ascending, output="r", num_ranges=ranges)
    order = F.col("v").asc_nulls_first() if ascending else F.col("v").desc_nulls_last()
    fn = F.dense_rank() if dense else F.rank()
    want = df.withColumn("w", fn.over(Window.orderBy(order)))
    joined = got.join(want, "id")
    assert got.count() == df.count()
    assert joined.filter(F.col("r") != F.col("w")).count() == 0


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("ascending", [False, True])
@pytest.mark.parametrize("ranges", [1, 4, 32])
def test_matches_window_with_hot_value_and_nulls(spark, dense, ascending, ranges):
    rnd = random.Random(7)
    values = [rnd.choice([None, 3.0, 3.0, 3.0, float(rnd.randint(-50, 50))]) for _ in range(3000)]
    _compare(spark, values, dense, ascending, ranges)


def test_number_of_ranges_follows_the_values(spark, monkeypatch):
    """No switch and no cap: the default splits whatever number of values."""
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 10)
    _compare(spark, [float(i % 500) for i in range(1500)], True, False, None)


def test_many_ranges_plan_quickly(spark):
    import time

    df = spark.range(20_000).select((F.col("id") * 1.0).alias("v")).checkpoint()
    began = time.perf_counter()
    global_rank(df, "v", output="r", num_ranges=4_000, stored=True).explain()
    assert time.perf_counter() - began < 30


def test_strings_rank_too(spark):
    _compare(spark, [None, "b", "a", "b", "é"], False, True, 3, "string")


def test_integer_values(spark):
    rnd = random.Random(3)
    _compare(spark, [rnd.randint(0, 20) for _ in range(500)], True, False, 6, "long")


def test_empty_and_single(spark):
    _compare(spark, [], False, False, 8)
    _compare(spark, [None], True, False, 8)
    _compare(spark, [1.5], False, True, 8)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), max_size=60),
    st.booleans(),
    st.integers(1, 9),
)
def test_property(spark, values, dense, ranges):
    _compare(spark, values, dense, False, ranges)


def test_values_are_ranked_per_range(spark):
    import contextlib
    import io

    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"), "id")
    ranked = global_rank(df, "v", dense=True, output="r")
    ranked.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        ranked.explain()
    from checks.plans import drop_initial_plans

    plan = drop_initial_plans(buf.getvalue())
    # values are windowed per range id, never all in one partition; the one
    # single-partition step is the prefix sum over one row per range
    assert "hashpartitioning(_range" in plan
    assert plan.count("SinglePartition") <= 1


def test_both_ranks_in_one_pass(spark):
    rnd = random.Random(11)
    rows = [(i, rnd.choice([None, 2.0, 2.0, float(rnd.randint(0, 30))])) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, v double")
    got = global_ranks(df, "v", rank_col="r", dense_rank_col="d", num_ranges=5)
    w = Window.orderBy(F.col("v").desc_nulls_last())
    want = df.withColumn("r2", F.rank().over(w)).withColumn("d2", F.dense_rank().over(w))
    j = got.join(want, "id")
    assert j.count() == 1500
    assert j.filter((F.col("r") != F.col("r2")) | (F.col("d") != F.col("d2"))).count() == 0


def test_measures_of_different_types_in_one_pass(spark):
    from strata.operators.ranking import Ranking, rank_measures

    rnd = random.Random(12)
    rows = [
        (i, rnd.choice([None, 2.0, float(rnd.randint(0, 30))]), rnd.choice([None, "a", "b", str(i % 50)]), 2**60 + i % 7)
        for i in range(1200)
    ]
    df = spark.createDataFrame(rows, "id long, v double, s string, n long")
    got = rank_measures(
        df,
        [Ranking("v", "rv"), Ranking("s", None, "ds", ascending=True), Ranking("n", "rn", "dn")],
        num_ranges=6,
    )
    v, s, n = F.col("v").desc_nulls_last(), F.col("s").asc_nulls_first(), F.col("n").desc_nulls_last()
    want = df.select(
        "*",
        F.rank().over(Window.orderBy(v)).alias("rv"),
        F.dense_rank().over(Window.orderBy(s)).alias("ds"),
        F.rank().over(Window.orderBy(n)).alias("rn"),
        F.dense_rank().over(Window.orderBy(n)).alias("dn"),
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    assert rank_measures(df.limit(0), [Ranking("v"), Ranking("n", "q")]).count() == 0


def test_hot_value_is_one_row_a_range(spark):
    from strata.operators.ranking import Ranking, rank_measures

    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"))
    got = rank_measures(df, [Ranking("v", "r", "d")], num_ranges=8)
    w = Window.orderBy(F.col("v").desc_nulls_last())
    want = df.select("id", F.rank().over(w).alias("r2"), F.dense_rank().over(w).alias("d2"))
    assert got.join(want, "id").where("r <> r2 or d <> d2").count() == 0
