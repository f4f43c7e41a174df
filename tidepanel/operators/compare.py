"""Comparisons across periods and against expected sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def period_compare(df: DataFrame, label: str, value: str, a, b, period: str = "year",
                   suffixes: tuple[str, str] | None = None, zero_if_all_null: bool = True) -> DataFrame:
    """Per label, the sum of ``value`` in period ``a`` and in period ``b``.

    One conditional aggregation instead of a self-join: labels must occur in
    both periods (inner-join semantics). ``a``/``b`` may be ints or Columns
    (e.g. scalar subqueries choosing a fallback period; then pass suffixes). A present slice whose values are all
    NULL sums to 0 (groupby-sum behaviour) unless ``zero_if_all_null=False``.
    """
    if suffixes is None and not (isinstance(a, int) and isinstance(b, int)):
        raise ValueError("suffixes are required when periods are Columns")
    sa, sb = suffixes or (f"_{a}", f"_{b}")
    ca, cb = f"{value}{sa}", f"{value}{sb}"
    in_a, in_b = F.col(period) == a, F.col(period) == b

    def slice_sum(cond):
        s = F.sum(F.when(cond, F.col(value)))
        return F.coalesce(s, F.lit(0.0)) if zero_if_all_null else s

    agg = (
        df.where(((F.col(period) == a) | (F.col(period) == b)) & F.col(label).isNotNull())
        .groupBy(label)
        .agg(slice_sum(in_a).alias(ca), slice_sum(in_b).alias(cb),
             F.count(F.when(in_a, 1)).alias("__na"), F.count(F.when(in_b, 1)).alias("__nb"))
    )
    return agg.where((F.col("__na") > 0) & (F.col("__nb") > 0)).drop("__na", "__nb")


def missing_members(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected keys that are absent (left anti join).

    The present keys are de-duplicated first: partial aggregation collapses
    a hot key per map task, so the anti join shuffles distinct keys only.
    """
    on = [on] if isinstance(on, str) else list(on)
    return expected.select(*on).distinct().join(present.select(*on).distinct(), on=on, how="left_anti")


def missing_periods_by_entity(df: DataFrame, entity: str, start: int, end: int, period: str = "year",
                              min_rows: int | None = None) -> DataFrame:
    """Per entity: row count and the periods of [start, end] it lacks.

    No grid cross-join: each entity's distinct periods inside the range (a set
    bounded by the range length) are subtracted from ``sequence(start, end)``. Entities with
    fewer than ``min_rows`` rows (default: the full range) are reported.
    """
    need = (end - start + 1) if min_rows is None else min_rows
    in_range = F.col(period).between(start, end)
    agg = df.groupBy(entity).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.collect_set(F.when(in_range, F.col(period).cast("bigint"))).alias("__have"))
    full = F.sequence(F.lit(start).cast("bigint"), F.lit(end).cast("bigint"))
    return (agg.where(F.col("n_rows") < need)
            .select(entity, "n_rows", F.array_sort(F.array_except(full, F.col("__have"))).alias("missing_periods")))
