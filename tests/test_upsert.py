import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from strata.operators.upsert import keep_last, upsert

SCHEMA = "k string, v int"


def _rows(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=repr)


def test_cases(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], SCHEMA)
    source = spark.createDataFrame([("b", 2), ("c", 2), (None, 2)], SCHEMA)
    out = upsert(target, source, ["k"])
    # a only in target: kept; b in both: source wins; c new; NULL keys never match
    assert _rows(out) == sorted([("a", 1), ("b", 2), ("c", 2), (None, 1), (None, 2)], key=repr)


def test_idempotent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA)
    source = spark.createDataFrame([("b", 2), ("c", 2)], SCHEMA)
    once = upsert(target, source, ["k"])
    twice = upsert(once, source, ["k"])
    assert _rows(once) == _rows(twice)


def test_duplicate_source_key_fails(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    source = spark.createDataFrame([("b", 2), ("b", 3)], SCHEMA)
    with pytest.raises((PySparkException, Py4JJavaError), match="duplicate source key"):
        upsert(target, source, ["k"]).collect()


def test_null_source_key_rejected_on_request(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    source = spark.createDataFrame([(None, 2)], SCHEMA)
    assert len(upsert(target, source, ["k"]).collect()) == 2
    with pytest.raises((PySparkException, Py4JJavaError), match="NULL source key"):
        upsert(target, source, ["k"], reject_null_keys=True).collect()


def test_schema_mismatch(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    with pytest.raises(ValueError):
        upsert(target, spark.createDataFrame([("a",)], "k string"), ["k"])


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 30), ("a", 3, 20), ("b", 4, 1)], "k string, v int, ts int")
    assert sorted(tuple(r) for r in keep_last(df, ["k"], "ts").collect()) == [("a", 2, 30), ("b", 4, 1)]



def _model(target, source):
    """MERGE semantics in plain Python: source rows replace matching target
    rows, unmatched target rows stay, NULL keys never match."""
    source_keys = {k for k, _ in source if k is not None}
    kept = [(k, v) for k, v in target if k is None or k not in source_keys]
    return sorted(kept + list(source), key=repr)


keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(keys, st.integers(0, 9)), max_size=8),
    st.lists(st.tuples(keys, st.integers(10, 19)), max_size=6),
)
def test_upsert_matches_model(spark, target, source):
    # a non-NULL key may appear only once in the source (MERGE refuses more)
    seen, unique_source = set(), []
    for k, v in source:
        if k is None or k not in seen:
            unique_source.append((k, v))
            seen.add(k)
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(unique_source, SCHEMA)
    assert _rows(upsert(t, s, ["k"])) == _model(target, unique_source)


def test_duplicate_first_load_fails(spark):
    """The guard does not depend on what the target holds."""
    source = spark.createDataFrame([("b", 2), ("b", 3), (None, 1), (None, 2)], SCHEMA)
    with pytest.raises((PySparkException, Py4JJavaError), match="duplicate source key"):
        upsert(source.limit(0), source, ["k"]).collect()
    nulls = source.filter("k is null")
    assert len(upsert(source.limit(0), nulls, ["k"]).collect()) == 2
