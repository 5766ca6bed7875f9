"""Column-expression helpers (JVM-side built-ins only)."""

from strata.functions.columns import (
    as_of_literal,
    bucketize,
    cents,
    count_each,
    floor_div,
    guarded_ratio,
    money_avg,
    money_stddev,
    money_sum,
    non_empty,
    ordinal,
    share_of_total,
    stamp,
    trimmed_or,
)

__all__ = [
    "as_of_literal",
    "bucketize",
    "cents",
    "count_each",
    "floor_div",
    "guarded_ratio",
    "money_avg",
    "money_stddev",
    "money_sum",
    "non_empty",
    "ordinal",
    "share_of_total",
    "stamp",
    "trimmed_or",
]
