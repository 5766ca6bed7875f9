"""The exact sample deviation does not depend on how rows are partitioned."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strata.functions import money_stddev


def exact(cents):
    n = len(cents)
    mean = Fraction(sum(cents), n)
    return math.sqrt(sum((c - mean) ** 2 for c in cents) / (n - 1)) / 100


@pytest.mark.parametrize("base, width", [(0, 100), (10**13, 100), (-(10**12), 10**12), (5, 0)])
def test_value_and_partitions(spark, base, width):
    rng = random.Random(base)
    cents = [base + rng.randint(0, width) for _ in range(3000)]
    df = spark.createDataFrame([(c / 100,) for c in cents] + [(None,)], "v double")
    got = {
        df.repartition(k).agg(money_stddev("v").alias("s")).first().s for k in (1, 8, 200)
    }
    assert len(got) == 1
    assert got.pop() == pytest.approx(exact(cents), rel=1e-12, abs=1e-12)


def test_few_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 1.0), ("c", 2.0)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(money_stddev("v").alias("s")).collect()}
    assert got["a"] is None and got["b"] is None and got["c"] == pytest.approx(math.sqrt(0.5))
    assert df.where(F.lit(False)).agg(money_stddev("v").alias("s")).first().s is None
