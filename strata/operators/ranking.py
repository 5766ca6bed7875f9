"""Global ``rank`` / ``dense_rank`` over a whole table without gathering it
into one task.

``F.rank().over(Window.orderBy(...))`` with no partition key moves every row
to a single partition and sorts it there.  ``global_rank`` computes the same
numbers with bounded per-task work, the same way at every size:

1. Values: distinct ranking values with their row counts.  Partial aggregation
   collapses a hot value (one value holding a third of the rows) map-side, so
   it costs one row downstream.  Several measures are ranked in the same pass:
   each row gives one (measure, value) pair per measure.
2. The values are range-partitioned by measure in rank order, about
   ``ROWS_PER_RANGE`` values to a range, however many ranges that takes.  The number of the
   partition is stored with them in a checkpoint, so a task that runs again
   reads the same ranges.
3. Per range and measure: a window numbers the values locally.
4. Totals (one row per range and measure) become prefix offsets of each measure
   and are broadcast back to their range.
5. The ranked values are equi-joined back to the rows (null-safe), once per
   measure.  The planner broadcasts the ranked values when they are measured
   small, and AQE splits the partition of a hot value otherwise.

Building the result runs two jobs whatever the number of measures: the input is
checkpointed (it is read twice; its rows are counted while it is written), and
the ranges are stored.  Checkpoints go to the session's shared
``spark.checkpoint.dir`` and cut the lineage.  Pass ``stored=True`` when the input
already is a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

ROWS_PER_RANGE = 200_000
RANGES_PER_FILE = 32  # ranges that one task stores


@dataclass(frozen=True)
class Ranking:
    """A measure to rank by, and the columns to write (either may be left out)."""

    value: str
    rank_col: str | None = "rank"
    dense_rank_col: str | None = None
    ascending: bool = False

    def order(self, column: Column) -> Column:
        return column.asc_nulls_first() if self.ascending else column.desc_nulls_last()


def global_rank(
    df: DataFrame,
    value: str,
    *,
    dense: bool = False,
    ascending: bool = False,
    output: str = "rank",
    num_ranges: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Append ``output`` = ``rank()`` (or ``dense_rank()``) of ``value`` over
    all rows, ordered descending (NULLs last) or ascending (NULLs first),
    exactly as the unpartitioned window would, as a ``bigint``.

    ``value`` may have any orderable type.  ``num_ranges`` defaults to about
    one range per ``ROWS_PER_RANGE`` distinct values; the result does not
    depend on it.
    """
    return global_ranks(
        df,
        value,
        rank_col=None if dense else output,
        dense_rank_col=output if dense else None,
        ascending=ascending,
        num_ranges=num_ranges,
        stored=stored,
    )


def global_ranks(
    df: DataFrame,
    value: str,
    *,
    rank_col: str | None = "rank",
    dense_rank_col: str | None = None,
    ascending: bool = False,
    num_ranges: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """``global_rank`` producing ``rank`` and/or ``dense_rank`` columns in
    one pass (both come from the same per-range numbering and offsets)."""
    ranking = Ranking(value, rank_col, dense_rank_col, ascending)
    return rank_measures(df, [ranking], num_ranges=num_ranges, stored=stored)


def rank_measures(
    df: DataFrame,
    rankings: Sequence[Ranking],
    *,
    num_ranges: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Append the ranks of several measures over all rows in one range pass."""
    if not rankings or any(not (r.rank_col or r.dense_rank_col) for r in rankings):
        raise ValueError("rank_measures: ask for rank_col and/or dense_rank_col")
    ensure_checkpoint_dir(df.sparkSession)
    if not stored:
        rows = Observation()
        df = df.observe(rows, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
        count = rows.get["rows"] if num_ranges is None else 0
    else:
        count = df.count() if num_ranges is None else 0
    if num_ranges is None:  # distinct values are at most as many as rows
        num_ranges = -(-count * len(rankings) // ROWS_PER_RANGE)
    num_ranges = max(1, num_ranges)

    # One value column a measure (they may differ in type); the others are NULL.
    names = [f"_v{k}" for k in range(len(rankings))]
    if len(rankings) == 1:
        pairs = df.select(F.lit(0).alias("_measure"), F.col(rankings[0].value).alias("_v0"))
    else:
        types = dict(zip(names, (df.schema[r.value].dataType for r in rankings), strict=True))
        entries = [
            F.struct(
                F.lit(k).alias("_measure"),
                *(
                    (F.col(r.value) if n == names[k] else F.lit(None).cast(types[n])).alias(n)
                    for n in names
                ),
            )
            for k, r in enumerate(rankings)
        ]
        pairs = df.select(F.inline(F.array(*entries)))
    order = [r.order(F.col(n)) for n, r in zip(names, rankings, strict=True)]
    values = (
        pairs.groupBy("_measure", *names)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .repartitionByRange(num_ranges, F.col("_measure"), *order)
        .withColumn("_range", F.spark_partition_id())
        .coalesce(-(-num_ranges // RANGES_PER_FILE))
        .checkpoint(eager=True)
    )

    local = Window.partitionBy("_range", "_measure").orderBy(*order)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    ranked_locally = values.select(
        "_measure",
        *names,
        "_range",
        F.row_number().over(local).alias("_local_dense"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_local_before"),
    )

    totals = values.groupBy("_range", "_measure").agg(
        F.count(F.lit(1)).alias("_values"), F.sum("_rows").alias("_rows")
    )
    # One row per range and measure, each standing for about ROWS_PER_RANGE values.
    prior = Window.partitionBy("_measure").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_measure",
        "_range",
        F.coalesce(F.sum("_values").over(prior), F.lit(0)).alias("_values_before"),
        F.coalesce(F.sum("_rows").over(prior), F.lit(0)).alias("_rows_before"),
    )
    ranked = ranked_locally.join(F.broadcast(offsets), ["_measure", "_range"])
    rank = (F.col("_rows_before") + F.col("_local_before") + 1).cast("bigint")
    dense = (F.col("_values_before") + F.col("_local_dense")).cast("bigint")
    for k, r in enumerate(rankings):
        wanted = [(rank, r.rank_col), (dense, r.dense_rank_col)]
        mine = ranked.where(F.col("_measure") == k).select(
            F.col(names[k]).alias("_ranked_value"), *(c.alias(n) for c, n in wanted if n)
        )
        df = df.join(mine, df[r.value].eqNullSafe(mine["_ranked_value"]), "inner").drop("_ranked_value")
    return df
