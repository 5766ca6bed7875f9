"""Keyed upsert (``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *``)
as a DataFrame plan: ``target LEFT ANTI JOIN source-keys UNION ALL source``.

* Matched keys take the source row; target rows whose key the source lacks
  are kept (an upsert never deletes); new keys are inserted.
* Keys compare with ``=``: a NULL key never matches, so NULL-key source rows
  are always inserted and NULL-key target rows always kept, as in MERGE.
* A non-NULL key occurring twice in the source fails the job, whatever the
  target holds.  The check rides inside the plan: the inserted rows
  themselves come out of the guarded aggregate by key, so nothing can prune
  it (an empty target included) and no extra action is needed.
* Scale: the source is aggregated by key with map-side partial aggregation
  (a repeated key costs one row per task), then target and keys are shuffled
  on the key for the anti join (AQE splits skewed target partitions, e.g.
  many NULL keys).  The result has the target's column order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_present(keys: Sequence[str]):
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def _per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with a key, one row a key: the keys, ``_n`` rows and ``_row``."""
    rest = [c for c in source.columns if c not in keys]
    return (
        source.filter(_all_present(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(0).alias("_any"), *rest)).alias("_row"))
    )


def _unfolded(counted: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``_per_key`` as source rows; evaluating them raises if a key repeats."""
    guard = F.when(
        F.col("_n") > 1,
        F.raise_error(
            F.concat(
                F.lit(f"upsert: duplicate source key ({', '.join(keys)}) = "),
                F.to_json(F.struct(*keys)),
            )
        ),
    ).otherwise(F.lit(True))
    return counted.filter(guard).select(
        *(F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in source.columns)
    )


def source_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source's rows; evaluating them raises if a non-NULL key repeats."""
    keys = list(keys)
    rows = _unfolded(_per_key(source, keys), source, keys)
    return rows.unionByName(source.filter(~_all_present(keys)))


def row_hash(values: Sequence[Column]) -> list[Column]:
    """Two 64-bit hashes of the values.  Hash functions skip NULLs, so which values
    are NULL is hashed, too: (NULL, 1) and (1, NULL) differ."""
    parts = [*values, *(v.isNull() for v in values)]
    return [F.xxhash64(F.lit(seed), *parts) for seed in (1, 2)]


def changed_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """The source's rows that are new to ``target`` or differ from its row of the same
    key in a column outside ``ignore``; evaluating them raises if a non-NULL key
    repeats, whether its rows changed or not.

    Only the target's keys and two hashes a row are shuffled.  A change passes
    unseen if both 64-bit hashes collide; -0.0 and 0.0 count as equal.  Rows
    with a NULL key match nothing, so all of them are new."""
    keys = list(keys)
    seen = [c for c in target.columns if c not in keys and c not in ignore]
    counted = _per_key(source, keys)
    types = dict(target.dtypes)
    now = row_hash([F.col(f"_row.`{c}`").cast(types[c]) for c in seen])
    old = target.filter(_all_present(keys)).select(
        *(F.col(k).alias(f"_old_{i}") for i, k in enumerate(keys)),
        *(h.alias(f"_was_{i}") for i, h in enumerate(row_hash([F.col(c) for c in seen]))),
    )
    same = F.col("_n") == 1  # repeated keys stay, for the guard to see
    for i, k in enumerate(keys):
        same = same & (F.col(k) == F.col(f"_old_{i}"))
    for i in range(len(now)):
        same = same & (F.col(f"_now_{i}") == F.col(f"_was_{i}"))
    hashed = counted.withColumns({f"_now_{i}": h for i, h in enumerate(now)})
    rows = _unfolded(hashed.join(old, same, "left_anti"), source, keys)
    return rows.unionByName(source.filter(~_all_present(keys)))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    reject_null_keys: bool = False,
) -> DataFrame:
    """The target after upserting ``source`` on ``keys``.

    With ``reject_null_keys`` a source row with a NULL key fails the job
    (checked on the rows being inserted, where no join constraint can
    remove it first)."""
    keys = list(keys)
    missing = [c for c in target.columns if c not in source.columns]
    extra = [c for c in source.columns if c not in target.columns]
    if missing or extra:
        raise ValueError(
            f"upsert: source columns differ from target (missing {missing}, extra {extra})"
        )
    rows = source.select(*target.columns)
    if reject_null_keys:
        rows = rows.filter(
            F.when(
                ~_all_present(keys),
                F.raise_error(F.lit(f"upsert: NULL source key ({', '.join(keys)})")),
            ).otherwise(F.lit(True))
        )
    kept = target.join(rows.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(source_rows(rows, keys))


def keep_last(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (use before
    ``upsert`` when a batch may carry several versions of a key).

    ``max_by`` is an ordinary aggregate, so a hot key is reduced map-side
    instead of being gathered into one task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*rest), F.col(order_by)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "_latest.*").select(*df.columns)
