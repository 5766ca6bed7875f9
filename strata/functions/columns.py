"""Column-level building blocks shared by every layer.

All helpers return ``Column`` expressions built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time ---------------------------------------------------------------------


def as_of_literal(as_of: dt.datetime | str | None) -> Column:
    """The processing instant as a timestamp literal.

    Transforms take the instant as an argument so a rerun reproduces its
    output; ``None`` means "now" (``current_timestamp``)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.to_timestamp(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")))


def stamp(df: DataFrame, columns: Mapping[str, Column | str | None]) -> DataFrame:
    """Append metadata columns; plain strings and ``None`` become literals."""
    return df.withColumns(
        {
            name: value if isinstance(value, Column) else F.lit(value)
            for name, value in columns.items()
        }
    )


# --- text -----------------------------------------------------------------------


def trimmed_or(c: ColumnOrName, default: str, upper: bool = False) -> Column:
    """Trim spaces (optionally upper-case); only NULL falls back to ``default``
    - an empty string stays empty."""
    cleaned = F.trim(col(c))
    if upper:
        cleaned = F.upper(cleaned)
    return F.coalesce(cleaned, F.lit(default))


def non_empty(c: ColumnOrName) -> Column:
    """Not NULL and at least one character (spaces count)."""
    return col(c).isNotNull() & (F.length(col(c)) > 0)


# --- classification --------------------------------------------------------------


def bucketize(
    value: ColumnOrName,
    thresholds: Sequence[tuple[float, str]],
    otherwise: str,
    op: str = ">=",
) -> Column:
    """First matching ``value <op> threshold`` wins, else ``otherwise``.

    ``thresholds`` are tried in the given order, so ``>=`` lists go from high
    to low and ``<`` lists from low to high.  A NULL value matches nothing and
    falls through to ``otherwise``.
    """
    compare = {
        ">=": lambda c, t: c >= t,
        ">": lambda c, t: c > t,
        "<": lambda c, t: c < t,
        "<=": lambda c, t: c <= t,
    }[op]
    v = col(value)
    expr = None
    for threshold, label in thresholds:
        cond = compare(v, F.lit(threshold))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def ordinal(value: ColumnOrName, labels: Sequence[str]) -> Column:
    """1-based position of ``value`` in ``labels``; anything else gets the
    last position."""
    v = col(value)
    expr = None
    for i, label in enumerate(labels[:-1], start=1):
        expr = F.when(v == label, F.lit(i)) if expr is None else expr.when(v == label, F.lit(i))
    last = F.lit(len(labels))
    return last if expr is None else expr.otherwise(last)


def count_each(value: ColumnOrName, labels: Iterable[tuple[str, str]]) -> list[Column]:
    """Conditional counts ``count_if(value = label) AS alias`` (never NULL)."""
    v = col(value)
    return [F.count_if(v == label).alias(alias) for label, alias in labels]


# --- arithmetic -------------------------------------------------------------------


def guarded_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """``round(num / den, scale)`` when ``den > 0``, else ``0.0``."""
    return F.when(col(den) > 0, F.round(col(num) / col(den), scale)).otherwise(F.lit(0.0))


def share_of_total(c: ColumnOrName, scale: int = 2) -> Column:
    """Percentage of the column total, computed over the (already aggregated,
    hence small) rows of the frame; NULL when the total is 0.

    Use only on frames whose row count is bounded (one row per category):
    the unpartitioned window gathers all rows into one task."""
    total = F.sum(col(c)).over(Window.partitionBy())
    return F.round(F.try_divide(col(c), total) * 100, scale)


# --- money: exact decimal cents --------------------------------------------------

MONEY = "decimal(18,2)"
WIDE_MONEY = "decimal(28,2)"  # company revenues


def cents(c: ColumnOrName) -> Column:
    """A 2-dp amount as integer cents (exact; the input is already rounded)."""
    return F.round(col(c) * 100).cast("bigint")


def money_sum(c: ColumnOrName, kind: str = MONEY) -> Column:
    """Exact, order-independent sum of amounts to the cent, returned as double;
    ``kind`` is the decimal type of one amount."""
    return F.sum(col(c).cast(kind)).cast("double")


def floor_div(a: Column, b: Column) -> Column:
    """Exact integer quotient of non-negative ``a`` by positive ``b`` (bigint
    arithmetic, no floating point)."""
    exact_multiple = (a - a % b).cast("decimal(38,0)")
    return (exact_multiple / b.cast("decimal(38,0)")).cast("bigint")


def money_avg(c: ColumnOrName) -> Column:
    """Average of 2-dp amounts rounded half-up to the cent, exactly.

    Sum and count are integers, so ``(2|s| + n) div 2n`` is the half-up
    quotient with no intermediate rounding; NULL when there are no amounts.
    """
    s = F.sum(cents(c))
    n = F.count(col(c))
    q = floor_div(F.abs(s) * 2 + n, n * 2)
    return F.when(n > 0, F.when(s < 0, -q).otherwise(q) / 100)


def money_stddev(c: ColumnOrName, kind: str = WIDE_MONEY) -> Column:
    """Sample standard deviation of amounts to the cent, as double; NULL for
    fewer than two amounts.

    Count, sum and sum of squares of integer cents are exact, so the result does
    not depend on how rows are partitioned or merged.  The squares are taken
    about the integer part of the mean, exactly as well; only the last division
    and the root are floating point.  Amounts and counts may be as large as
    ``n * amount ** 2 < 10 ** 34``."""
    x = (col(c).cast(kind) * 100).cast("decimal(19,0)")
    n = F.count(x).cast("decimal(20,0)")
    total, squares = F.sum(x).cast("decimal(38,0)"), F.sum(x * x)
    rest = (total % n).cast("decimal(38,0)")
    mean = ((total - rest) / n).cast("decimal(38,0)")
    about = (squares - (mean * (total + rest)).cast("decimal(38,0)")).cast("double")
    r = rest.cast("double")
    spread = about - r * r / n.cast("double")
    return F.when(n > 1, F.sqrt(spread / (n - 1).cast("double")) / 100)
