import pytest

from strata.sources.tables import TableDoc, document_table, save_overwrite, save_upsert

DOC = TableDoc(
    comment="Test table: it's documented",
    properties={"quality_tier": "gold", "data_domain": "sales"},
    columns={"k": "the key", "v": "a value"},
)


def _meta(spark, table):
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    cols = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {table}").collect()}
    ext = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return props, cols, ext.get("Comment")


def test_overwrite_replaces_data_schema_and_reapplies_doc(spark, fresh_schema):
    t = f"{fresh_schema}.tbl"
    assert save_overwrite(spark.createDataFrame([("a", 1)], "k string, v int"), t, DOC) == 1
    n = save_overwrite(spark.createDataFrame([("b", 2, 3.0), ("c", 3, 4.0)], "k string, v int, w double"), t, DOC)
    assert n == 2
    assert spark.table(t).columns == ["k", "v", "w"]
    props, cols, comment = _meta(spark, t)
    assert props["quality_tier"] == "gold"
    assert cols["k"] == "the key" and cols["v"] == "a value"
    assert comment == "Test table: it's documented"


def test_upsert_creates_then_merges(spark, fresh_schema):
    t = f"{fresh_schema}.acc"
    assert save_upsert(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), t, ["k"], DOC) == 2
    assert save_upsert(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), t, ["k"], DOC) == 3
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [("a", 1), ("b", 2), ("c", 2)]
    # rerunning the same batch changes nothing
    save_upsert(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), t, ["k"], DOC)
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [("a", 1), ("b", 2), ("c", 2)]
    props, cols, _ = _meta(spark, t)
    assert props["data_domain"] == "sales" and cols["k"] == "the key"
    assert not spark.catalog.tableExists(f"{t}__upsert_next")


def test_document_unknown_column_raises(spark, fresh_schema):
    t = f"{fresh_schema}.x"
    save_overwrite(spark.createDataFrame([("a",)], "k string"), t)
    with pytest.raises(Exception):
        document_table(spark, t, TableDoc(columns={"nope": "missing"}))


def test_partitioned_overwrite(spark, fresh_schema):
    t = f"{fresh_schema}.p"
    df = spark.createDataFrame([("a", "2024-01"), ("b", "2024-02")], "k string, month string")
    save_overwrite(df, t, partition_by=["month"])
    assert spark.table(t).filter("month = '2024-02'").count() == 1
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()]
    assert sorted(parts) == ["month=2024-01", "month=2024-02"]


def test_upsert_finishes_interrupted_swap(spark, fresh_schema):
    t = f"{fresh_schema}.acc"
    save_upsert(spark.createDataFrame([("a", 1)], "k string, v int"), t, ["k"])
    save_upsert(spark.createDataFrame([("b", 1)], "k string, v int"), t, ["k"])
    # simulate a stop right after the drop: only the complete staging copy exists
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__upsert_next")
    assert not spark.catalog.tableExists(t)
    save_upsert(spark.createDataFrame([("c", 3)], "k string, v int"), t, ["k"])
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [("a", 1), ("b", 1), ("c", 3)]


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, fresh_schema):
    from pyspark.sql import functions as F

    from strata.sources.tables import KEY_BUCKET

    t = f"{fresh_schema}.big"
    first = spark.createDataFrame([(f"k{i}", 1) for i in range(200)], "k string, v int").repartition(8)
    assert save_upsert(first, t, ["k"], DOC, key_buckets=16) == 200

    def files():
        df = spark.table(t).select(KEY_BUCKET, F.input_file_name().alias("f")).distinct()
        return {(r[0], r[1]) for r in df.collect()}

    before = files()
    per_bucket = {}
    for b, _ in before:
        per_bucket[b] = per_bucket.get(b, 0) + 1
    assert max(per_bucket.values()) == 1  # rebalanced: one file per bucket, not per task
    batch = spark.createDataFrame([("k3", 2), ("new", 2)], "k string, v int")
    written = save_upsert(batch, t, ["k"], DOC, key_buckets=16)
    rows = {r.k: r.v for r in spark.table(t).collect()}
    assert len(rows) == 201 and rows["k3"] == 2 and rows["new"] == 2 and rows["k4"] == 1
    after = files()
    touched = {r[0] for r in spark.table(t).filter("k in ('k3', 'new')").select(KEY_BUCKET).collect()}
    untouched_before = {x for x in before if x[0] not in touched}
    assert untouched_before and untouched_before <= after  # untouched files kept as they were
    assert written < 200  # only the touched buckets were rewritten
    props, cols, _ = _meta(spark, t)
    assert props["quality_tier"] == "gold"


def test_bucket_layout_is_kept_and_checked(spark, fresh_schema):
    t = f"{fresh_schema}.b"
    rows = spark.range(1000).selectExpr("id as k", "1 as v")
    save_upsert(rows, t, ["k"], key_buckets=8)
    batch = rows.limit(10).selectExpr("k", "2 as v")
    with pytest.raises(ValueError, match="8 key buckets"):
        save_upsert(batch, t, ["k"], key_buckets=16)
    with pytest.raises(ValueError, match="bucketed by"):
        save_upsert(batch, t, ["v"], key_buckets=8)
    # another key type is cast to the table's before hashing
    save_upsert(batch.selectExpr("cast(k as int) as k", "v"), t, ["k"])
    assert spark.table(t).count() == 1000 == spark.table(t).select("k").distinct().count()
    assert spark.table(t).filter("v = 2").count() == 10


def test_first_load_with_duplicates_fails(spark, fresh_schema):
    two = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    for buckets in (None, 4):
        with pytest.raises(Exception, match="duplicate source key"):
            save_upsert(two, f"{fresh_schema}.d{buckets}", ["k"], key_buckets=buckets)


def _files(spark, t):
    from pyspark.sql import functions as F

    spark.catalog.refreshTable(t)
    return {r[0] for r in spark.table(t).select(F.input_file_name()).distinct().collect()}


def test_only_changes_are_written(spark, fresh_schema):
    from strata.sources.tables import KEY_BUCKET

    t = f"{fresh_schema}.c"
    schema = "k long, v double, s string, stamp int"
    rows = [(i, i / 2, None if i % 3 else "x", 1) for i in range(200)]
    save_upsert(spark.createDataFrame(rows, schema), t, ["k"], key_buckets=16)
    before = _files(spark, t)
    again = spark.createDataFrame([(k, v, s, 2) for k, v, s, _ in rows], schema)
    assert save_upsert(again, t, ["k"], changes_only=True, ignore=["stamp"]) == 0
    assert _files(spark, t) == before  # no file written
    # NULL to text, text to NULL and a swap of values are changes; a new key is one
    edits = [(4, 2.0, "y", 2), (3, 1.5, None, 2), (5, 2.5, None, 2), (999, 1.0, None, 2)]
    assert save_upsert(spark.createDataFrame(edits, schema), t, ["k"], changes_only=True, ignore=["stamp"]) > 0
    touched = {r[0] for r in spark.table(t).where("k in (4, 3, 999)").select(KEY_BUCKET).collect()}
    kept = {f for f in before if int(f.split(f"{KEY_BUCKET}=")[1].split("/")[0]) not in touched}
    assert kept and kept <= _files(spark, t) and len(_files(spark, t) - before) == len(touched)
    got = {r.k: (r.v, r.s, r.stamp) for r in spark.table(t).collect()}
    assert len(got) == 201 and got[4] == (2.0, "y", 2) and got[3] == (1.5, None, 2)
    assert got[5] == (2.5, None, 1) and got[6] == (3.0, "x", 1) and got[999] == (1.0, None, 2)


def test_changes_equal_a_plain_upsert(spark, fresh_schema):
    schema = "k int, a int, b int"
    old = [(i, i % 5, None) for i in range(60)] + [(None, 1, 1)]
    new = [(i, i % 4, i % 3 or None) for i in range(30, 90)] + [(None, 2, 2)]
    for buckets in (None, 8):
        want, got = f"{fresh_schema}.w{buckets}", f"{fresh_schema}.g{buckets}"
        for t, only in ((want, False), (got, True)):
            save_upsert(spark.createDataFrame(old, schema), t, ["k"], key_buckets=buckets)
            save_upsert(spark.createDataFrame(new, schema), t, ["k"], changes_only=only)
        assert spark.table(want).exceptAll(spark.table(got)).isEmpty()
        assert spark.table(want).count() == spark.table(got).count() == 92
        # repeated keys fail although one of their rows is stored already
        two = spark.createDataFrame([(31, 3, 1), (31, 3, 1)], schema)
        with pytest.raises(Exception, match="duplicate source key"):
            save_upsert(two, got, ["k"], changes_only=True)


def test_upsert_finishes_an_interrupted_replacement(spark, fresh_schema):
    from strata.sources.tables import KEY_BUCKET

    t = f"{fresh_schema}.acc"
    save_upsert(spark.range(100).selectExpr("id as k", "1 as v"), t, ["k"], key_buckets=4)
    # a run stopped after it had staged buckets 0 and 1 with new values
    staged = spark.table(t).where(f"{KEY_BUCKET} < 2").selectExpr("k", "2 as v", KEY_BUCKET)
    n = save_overwrite(staged, f"{t}__upsert_buckets", partition_by=[KEY_BUCKET])
    save_upsert(spark.createDataFrame([(1000, 3)], "k long, v int"), t, ["k"])
    assert spark.table(t).where("v = 2").count() == n and spark.table(t).count() == 101
    assert not spark.catalog.tableExists(f"{t}__upsert_buckets")


def test_other_partitions_stay(spark, fresh_schema):
    from strata.sources.tables import replace_partitions

    t = f"{fresh_schema}.p"
    save_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), t, partition_by=["p"])
    replace_partitions(spark.createDataFrame([("a", 9)], "p string, v int"), t)
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [(2, "b"), (9, "a")]
