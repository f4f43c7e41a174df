"""Scalar numeric helpers — all built-in Column expressions (codegen, no UDF)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepanel.functions._col import as_col


def np_round(c, digits: int | None) -> Column:
    """NumPy-style rounding: half-to-even on the *scaled double*.

    ``F.round`` rounds half-up on the decimal text (0.125 -> 0.13), which is
    not what a float pipeline produces; ``rint(x * 10^n) / 10^n`` is.
    """
    c = as_col(c)
    if digits is None:
        return c
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def to_numeric(c, dtype: str = "double") -> Column:
    """Coerce to a number; unparsable values become NULL (ANSI-safe).

    NaN means "missing" in the sources, so a NaN double becomes NULL too.
    Integers are also read from their decimal form, as sheets write years
    ("2020.0" -> 2020); a value with a fraction is not an integer -> NULL.
    """
    c = as_col(c)
    if dtype in ("double", "float"):
        return F.nanvl(c.try_cast(dtype), F.lit(None).cast(dtype))
    v = c.cast("string").try_cast("double")
    # the direct cast keeps integers that a double cannot hold
    return F.coalesce(c.cast("string").try_cast(dtype), F.when(v == F.floor(v), v.try_cast(dtype)))


def safe_ratio(num, den, scale: float = 1.0, digits: int | None = None, scale_after: bool = False,
               extra_mask: Column | None = None) -> Column:
    """NULL unless ``den > 0``; otherwise ``round(num * scale / den, digits)``.

    ``scale_after=True`` evaluates ``num / den * scale`` instead (percent
    shares are computed that way and the operation order changes low bits).
    """
    num, den = as_col(num), as_col(den)
    if scale_after:
        value = num / den * F.lit(float(scale))
    elif scale == 1.0:
        value = num / den
    else:
        value = num * F.lit(float(scale)) / den
    mask = den > 0
    if extra_mask is not None:
        mask = mask & extra_mask
    return F.when(mask, np_round(value, digits))


def row_sum_min_count(cols: Iterable) -> Column:
    """Row-wise sum that is NULL only when every input is NULL (min_count=1)."""
    cs = [as_col(c) for c in cols]
    any_present = F.lit(False)
    total = F.lit(0.0)
    for c in cs:
        any_present = any_present | c.isNotNull()
        total = total + F.coalesce(c, F.lit(0.0))
    return F.when(any_present, total)


def reduction_pct(first, last) -> Column:
    """(first - last) / first * 100, only where first > 0."""
    first, last = as_col(first), as_col(last)
    return F.when(first > 0, (first - last) / first * F.lit(100.0))


def exact_sum(c, scale: int = 10) -> Column:
    """Sum through DECIMAL(38, scale): order-independent, so every engine and
    every partitioning returns the same double.

    Opt-in, for results that are compared bit by bit: digits beyond ``scale``
    decimal places are cut and sums of 10^(38 - scale) or more fail. A plain
    ``sum`` / ``avg`` has neither limit."""
    return F.sum(as_col(c).cast(f"decimal(38,{scale})")).cast("double")


def exact_avg(c, digits: int | None = None) -> Column:
    """Mean from an exact (decimal) sum divided by the count (optionally rounded).

    The sum does not depend on row order, so the mean is bit-identical for any
    partitioning (and for the SQL oracle) without any rounding."""
    c = as_col(c)
    return np_round(exact_sum(c) / F.count(c), digits)
