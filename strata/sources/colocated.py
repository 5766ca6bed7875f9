"""Facts and a dimension stored in the same buckets, so that their join moves neither.

Plain bucketing by the join key would put a hot key, and all NULL keys, into one
bucket, which a join without a shuffle cannot split at run time.  So buckets are
by (key, ``SPREAD``): a fact row's ``SPREAD`` is a hash of its own other columns
in ``[0, spread)``, and the dimension, which is small beside the facts, is stored
once for each value.  A hot key then lies in up to ``spread`` buckets.

The dimension's rows with a NULL key match nothing and are not stored.  Both tables
must have the same bucket count and key type; the counts are table properties, and
``check_colocated`` compares them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import TableDoc, _ident, document_table, save_overwrite

SPREAD = "_spread"
LAYOUT = ("strata.spread_key", "strata.spread_buckets", "strata.spread")


def save_spread_facts(
    facts: DataFrame, table: str, key: str, buckets: int, spread: int, by: Sequence[str] = ()
) -> int:
    """Store ``facts`` by (``key``, ``SPREAD``); ``by``: the columns whose hash spreads
    a key's rows (all others, unless given).  Rows equal in them stay together."""
    names = list(by) or [c for c in facts.columns if c != key]
    value = F.pmod(F.xxhash64(*names), F.lit(spread)).cast("int")
    return _save(facts.withColumn(SPREAD, value), table, key, buckets, spread)


def save_spread_dimension(dim: DataFrame, table: str, key: str, buckets: int, spread: int) -> int:
    """Store ``dim`` once for every value of ``SPREAD``; returns the rows stored."""
    values = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    return _save(dim.filter(F.col(key).isNotNull()).withColumn(SPREAD, values), table, key, buckets, spread)


def _save(rows: DataFrame, table: str, key: str, buckets: int, spread: int) -> int:
    written = save_overwrite(rows, table, bucket_by=(buckets, [key, SPREAD]))
    layout = dict(zip(LAYOUT, (key, str(buckets), str(spread)), strict=True))
    document_table(rows.sparkSession, table, TableDoc(properties=layout))
    return written


def check_colocated(spark: SparkSession, facts: str, dim: str, key: str) -> None:
    """Raise unless the two tables are stored alike; a different ``SPREAD`` range
    would lose matches."""

    def layout(table: str) -> list[str | None]:
        props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(table)}").collect()}
        return [*map(props.get, LAYOUT), dict(spark.table(table).dtypes).get(key)]

    one, two = layout(facts), layout(dim)
    if one != two or one[0] != key:
        raise ValueError(f"{facts} {one} and {dim} {two} are not stored alike by {key}")
