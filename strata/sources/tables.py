"""Catalog tables: full-refresh overwrite, keyed upsert, documentation.

Stored tables are the hand-over between layers (each layer re-reads the
previous layer's table), which also cuts lineage: a lost executor never
forces a recomputation further back than the last written table.

Tables are parquet by default.  Without a transactional table format there
is no ``MERGE``; ``save_upsert`` writes what is to be stored into a sibling table
first and then replaces the table's contents in place with that copy:

* with ``key_buckets`` the table is partitioned by key bucket and only the
  buckets that the source touches are read, merged and replaced (dynamic
  partition overwrite); bucket count and key columns are kept as table
  properties and checked, and source columns are cast to the table's types
  before hashing;
* without, the whole contents are replaced.

A reader may meet a table whose contents are being replaced.  A sibling table is
registered only when it is complete, so after a crash during the replacement
the next upsert first finishes it.  One writer a table is assumed.

With a format that supports ``MERGE``, use ``DataFrame.mergeInto`` instead.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.upsert import changed_rows, source_rows, upsert


@dataclass(frozen=True)
class TableDoc:
    comment: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    columns: Mapping[str, str] = field(default_factory=dict)


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_ident(schema)}")


def use_schema(spark: SparkSession, schema: str, catalog: str | None = None) -> None:
    """Make ``[catalog.]schema`` current for unqualified names."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.catalog.setCurrentDatabase(schema)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read_fresh(spark: SparkSession, table: str) -> DataFrame:
    """Read a table after dropping this session's cached file listing - needed
    when another session (e.g. a streaming ``foreachBatch``) replaced it."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def document_table(spark: SparkSession, table: str, doc: TableDoc | None) -> None:
    """Apply properties, table comment and column comments.

    An overwrite replaces a table's metadata, so call this after every
    write.  Failures raise (a missing column is a bug, not a warning)."""
    if doc is None:
        return
    if doc.properties:
        props = ", ".join(f"{_quote(k)} = {_quote(v)}" for k, v in doc.properties.items())
        spark.sql(f"ALTER TABLE {_ident(table)} SET TBLPROPERTIES ({props})")
    if doc.comment is not None:
        spark.sql(f"COMMENT ON TABLE {_ident(table)} IS {_quote(doc.comment)}")
    for column, comment in doc.columns.items():
        spark.sql(
            f"ALTER TABLE {_ident(table)} ALTER COLUMN `{column}` COMMENT {_quote(comment)}"
        )


def save_overwrite(
    df: DataFrame,
    table: str,
    doc: TableDoc | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    path: str | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> int:
    """Full refresh: replace the table (schema included) with ``df``; with
    ``path`` the table is external and stored there; with ``bucket_by`` (number,
    columns) it is bucketed, one file a bucket.

    The row count is observed during the write itself (no second pass) and
    returned.  A partitioned write is rebalanced on the partition columns
    first, so each table partition is written by a few tasks of a sensible
    size (AQE splits large ones) instead of one small file per task per
    partition."""
    spark = df.sparkSession
    obs = Observation(f"rows:{table}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        observed = observed.hint("rebalance", *partition_by)
    if bucket_by:
        observed = observed.repartition(bucket_by[0], *bucket_by[1])
    writer = observed.write.mode("overwrite").format(fmt)
    if bucket_by:
        writer = writer.bucketBy(bucket_by[0], *bucket_by[1])
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    document_table(spark, table, doc)
    try:
        return int(obs.get["rows"])
    except (Py4JJavaError, KeyError):
        # Re-planning at run time removes the observed node when its input turns
        # out to be empty; the stored table tells the count from its footers.
        return read_fresh(spark, table).count()


_OVERWRITE = threading.Lock()  # the overwrite mode is a setting of the whole session


def replace_partitions(rows: DataFrame, table: str) -> None:
    """Replace those partitions of ``table`` that ``rows`` has rows for.  (The
    writer's option of that name does not reach ``insertInto``, so the session's
    setting is used.)"""
    spark = rows.sparkSession
    key = "spark.sql.sources.partitionOverwriteMode"
    rows = rows.select(*spark.table(table).columns)
    with _OVERWRITE:
        previous = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            rows.write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(key, previous)


def save_upsert(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    doc: TableDoc | None = None,
    fmt: str = "parquet",
    reject_null_keys: bool = False,
    key_buckets: int | None = None,
    changes_only: bool = False,
    ignore: Sequence[str] = (),
) -> int:
    """Upsert ``source`` into ``table`` on ``keys`` (created when absent).

    With ``key_buckets`` the table is stored partitioned by ``KEY_BUCKET =
    pmod(xxhash64(keys), key_buckets)`` and only the buckets the source touches
    are read, merged and replaced, so a small batch into a huge table rewrites
    a small part of it; the source is evaluated once.  Without, the whole table is
    replaced.

    With ``changes_only`` only rows that are new or differ from the stored row in
    a column outside ``ignore`` are applied (``changed_rows``): an unchanged source
    writes no file of the table, and an unchanged row keeps its stored values
    of the ignored columns.  Returns the number of rows written."""
    spark = source.sparkSession
    stored = stored_buckets(spark, table)
    if stored is not None and key_buckets not in (None, stored[0]):
        raise ValueError(f"save_upsert: {table} has {stored[0]} key buckets, not {key_buckets}")
    if stored is not None and list(stored[1]) != list(keys):
        raise ValueError(f"save_upsert: {table} is bucketed by {stored[1]}, not {list(keys)}")
    key_buckets = stored[0] if stored else key_buckets
    if key_buckets:
        return _upsert_buckets(
            source, table, keys, doc, fmt, reject_null_keys, key_buckets, changes_only, ignore
        )
    staging = f"{table}__upsert_next"
    if table_exists(spark, staging):  # complete: an earlier run stopped before it was put in
        if table_exists(spark, table):
            _put_in(spark, staging, table)
        else:
            spark.sql(f"ALTER TABLE {_ident(staging)} RENAME TO {_ident(table)}")
    if not table_exists(spark, table):
        return save_overwrite(upsert(source.limit(0), source, keys, reject_null_keys), table, doc, fmt)
    target = read_fresh(spark, table)
    if changes_only:
        source = changed_rows(target, source, keys, ignore)
        if source.isEmpty():
            return 0
    rows = save_overwrite(upsert(target, source, keys, reject_null_keys), staging, None, fmt)
    _put_in(spark, staging, table)
    document_table(spark, table, doc)
    return rows


def _put_in(spark: SparkSession, staging: str, table: str) -> None:
    """Replace what the staged rows stand for (touched buckets, or all) and drop them."""
    replace_partitions(read_fresh(spark, staging), table)
    spark.sql(f"DROP TABLE {_ident(staging)}")
    spark.catalog.refreshTable(table)


KEY_BUCKET = "_key_bucket"
BUCKETS_PROPERTY, KEYS_PROPERTY = "strata.key_buckets", "strata.key_columns"
DEFAULT_KEY_BUCKETS = 32


def stored_buckets(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Bucket count and key columns of a table stored by key bucket."""
    if not table_exists(spark, table):
        return None
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(table)}").collect()}
    if BUCKETS_PROPERTY not in props:
        return None
    return int(props[BUCKETS_PROPERTY]), props[KEYS_PROPERTY].split(",")


def buckets_for(spark: SparkSession, table: str, new: int | None = DEFAULT_KEY_BUCKETS) -> int | None:
    """Bucket count to upsert with: the table's own if it exists (``None`` for a
    table not stored by bucket), else ``new``."""
    if not table_exists(spark, table):
        return new
    stored = stored_buckets(spark, table)
    return stored[0] if stored else None


def key_bucket(keys: Sequence[str], buckets: int):
    """Stable bucket of a key in ``[0, buckets)`` (NULL keys share one)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _upsert_buckets(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    doc: TableDoc | None,
    fmt: str,
    reject_null_keys: bool,
    buckets: int,
    changes_only: bool,
    ignore: Sequence[str],
) -> int:
    spark = source.sparkSession
    src = source.drop(KEY_BUCKET)
    if not table_exists(spark, table):
        src = src.withColumn(KEY_BUCKET, key_bucket(keys, buckets))
        checked = upsert(src.limit(0), src, keys, reject_null_keys)
        rows = save_overwrite(checked, table, doc, fmt, partition_by=[KEY_BUCKET])
        document_table(
            spark,
            table,
            TableDoc(properties={BUCKETS_PROPERTY: str(buckets), KEYS_PROPERTY: ",".join(keys)}),
        )
        return rows
    staging, delta = f"{table}__upsert_buckets", f"{table}__upsert_rows"
    if table_exists(spark, staging):  # complete: an earlier run stopped before it was put in
        _put_in(spark, staging, table)
    target = read_fresh(spark, table)
    if KEY_BUCKET not in target.columns:
        raise ValueError(f"save_upsert: {table} is not stored by key bucket")
    types = dict(target.dtypes)
    src = src.select(*(F.col(c).cast(types[c]) if c in types else F.col(c) for c in src.columns))
    src = src.withColumn(KEY_BUCKET, key_bucket(keys, buckets))
    # The only pass over the source; everything after reads the stored rows.
    new = changed_rows(target, src, keys, ignore) if changes_only else source_rows(src, keys)
    save_overwrite(new, delta, None, fmt, partition_by=[KEY_BUCKET])
    new = spark.table(delta)
    # At most ``buckets`` small ints reach the driver: a proven bound.
    touched = sorted(r[0] for r in new.select(KEY_BUCKET).distinct().collect())
    rows = 0
    if touched:
        affected = target.filter(F.col(KEY_BUCKET).isin(touched))  # partition pruning
        merged = upsert(affected, new, keys, reject_null_keys)
        rows = save_overwrite(merged, staging, None, fmt, partition_by=[KEY_BUCKET])
        _put_in(spark, staging, table)
        document_table(spark, table, doc)
    spark.sql(f"DROP TABLE {_ident(delta)}")
    return rows
