"""Panel statistics: totals, correlation, OLS trend, endpoint growth, arg-extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.numeric import exact_sum, np_round


def period_totals(df: DataFrame, values: dict[str, str], period: str = "year", exact: bool = True) -> DataFrame:
    """Sum of each value column per period (``values`` maps output -> input)."""
    aggs = [(exact_sum(src) if exact else F.sum(src)).alias(out) for out, src in values.items()]
    return df.groupBy(period).agg(*aggs)


def corr_ols(df: DataFrame, x: str, y: str, digits: int | None = 9) -> DataFrame:
    """Pearson correlation and the OLS line of y on x (pairwise non-NULL), one pass."""
    return df.agg(
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n_pairs"),
        np_round(F.corr(x, y), digits).alias("corr"),
        np_round(F.regr_slope(y, x), digits).alias("slope"),
        np_round(F.regr_intercept(y, x), digits).alias("intercept"),
        np_round(F.regr_r2(y, x), digits).alias("r2"),
    )


def endpoint_growth(df: DataFrame, value: str, period: str = "year", out: str = "growth_pct",
                    digits: int | None = None) -> DataFrame:
    """last / first - 1 (in %) over the period order: ``max_by`` / ``min_by``, one pass."""
    first = F.min_by(value, period)
    last = F.max_by(value, period)
    return df.agg(first.alias(f"{value}_first"), last.alias(f"{value}_last"),
                  np_round((F.try_divide(last, first) - F.lit(1.0)) * F.lit(100.0), digits).alias(out))


def arg_extreme(df: DataFrame, label: str, by: str, largest: bool = True, tie_break: Sequence = ()) -> DataFrame:
    """The row with the largest (or smallest) ``by``.

    Ties follow ``tie_break`` (column names sort ascending; pass Columns such
    as ``F.col(x).desc()`` for other directions), then ``label``.
    """
    o = [F.col(by).desc_nulls_last() if largest else F.col(by).asc_nulls_last()]
    o += [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tie_break] + [F.col(label).asc()]
    return df.where(F.col(by).isNotNull()).orderBy(*o).limit(1)
