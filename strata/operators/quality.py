"""Named data-quality rules: split a frame into valid and quarantined rows,
name the rules each bad row fails, and count failures.

A rule is a name and a boolean ``Column`` that must hold.  A rule that
evaluates to NULL counts as failed, so every input row lands on exactly one
side (valid + quarantined = input, as a multiset).

Everything is row-local (a filter or projection) except the counts, which
are one global aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column

    def passed(self) -> Column:
        return F.coalesce(self.holds, F.lit(False))


def all_pass(rules: Sequence[Rule]) -> Column:
    cond = F.lit(True)
    for rule in rules:
        cond = cond & rule.passed()
    return cond


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Array of the names of the rules a row fails (empty when valid)."""
    names = F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules])
    return F.filter(names, lambda x: x.isNotNull())


@dataclass(frozen=True)
class QualitySplit:
    source: DataFrame
    rules: tuple[Rule, ...]

    @property
    def valid(self) -> DataFrame:
        return self.source.filter(all_pass(self.rules))

    @property
    def quarantine(self) -> DataFrame:
        """Every failing row, duplicates kept."""
        return self.source.filter(~all_pass(self.rules))

    def quarantine_distinct(self) -> DataFrame:
        """Failing rows with exact duplicates collapsed - the result of
        ``source EXCEPT DISTINCT valid``, computed as one filtered distinct
        (partial aggregation collapses repeated rows map-side)."""
        return self.quarantine.distinct()

    def quarantine_with_reasons(self, column: str = "failed_rules") -> DataFrame:
        """Failing rows plus the names of the rules they fail."""
        return self.quarantine.withColumn(column, failed_rules(self.rules))

    def failure_counts(self) -> DataFrame:
        """One row per rule: ``(rule, failed_records)``, zero counts
        included; a row failing two rules counts for both."""
        counts = self.source.agg(
            *[F.count_if(~r.passed()).alias(r.name) for r in self.rules]
        )
        return counts.unpivot([], [r.name for r in self.rules], "rule", "failed_records")

    def summary(self) -> DataFrame:
        """One row: input, valid and quarantined counts and the valid share
        in percent (half-up to 0.1; NULL for an empty input)."""
        from strata.functions import floor_div

        ok = all_pass(self.rules)
        totals = self.source.agg(
            F.count(F.lit(1)).alias("bronze_records"),
            F.count_if(ok).alias("valid_records"),
            F.count_if(~ok).alias("quarantined_records"),
        )
        n = F.col("bronze_records")
        tenths = floor_div(F.col("valid_records") * 2000 + n, n * 2)
        return totals.withColumn(
            "processing_rate_pct", F.when(n > 0, tenths / 10)
        )

    def observed(self, name: str = "quality") -> tuple[QualitySplit, Observation]:
        """The same split over a source that records input / valid /
        quarantined counts as a side effect of whatever action reads it
        next (e.g. the quarantine write), instead of a separate pass."""
        ok = all_pass(self.rules)
        obs = Observation(name)
        source = self.source.observe(
            obs,
            F.count(F.lit(1)).alias("bronze_records"),
            F.count_if(ok).alias("valid_records"),
            F.count_if(~ok).alias("quarantined_records"),
        )
        return QualitySplit(source, self.rules), obs


def rate_pct(part: int, whole: int) -> float | None:
    """``part / whole`` in percent, half-up to 0.1 (exact integer maths)."""
    if not whole:
        return None
    return ((part * 2000 + whole) // (2 * whole)) / 10


def split(df: DataFrame, rules: Sequence[Rule]) -> QualitySplit:
    return QualitySplit(df, tuple(rules))


def guard_unique(df: DataFrame, keys: Sequence[str], label: str = "") -> DataFrame:
    """The rows of a lookup table ``df`` with non-NULL keys, but evaluating it
    fails if a key repeats.

    Rows are grouped by key with map-side aggregation, so a key that repeats
    very often still costs one row per task; when the result is joined on the
    same keys the join reuses that partitioning.  Rows with a NULL key match
    nothing in a lookup and are left out."""
    keys = list(keys)
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    rest = [c for c in df.columns if c not in keys]
    one = df.filter(present).groupBy(*keys).agg(
        *(F.first(c).alias(c) for c in rest), F.count(F.lit(1)).alias("_key_rows")
    )
    message = F.concat(
        F.lit(f"{label or 'table'}: duplicate key ({', '.join(keys)}) = "),
        F.to_json(F.struct(*keys)),
    )
    guard = F.when(F.col("_key_rows") > 1, F.raise_error(message)).otherwise(F.lit(True))
    return one.filter(guard).select(*df.columns)
