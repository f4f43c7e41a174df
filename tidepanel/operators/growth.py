"""Period-over-period growth per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.numeric import np_round
from tidepanel.operators.scan import carried, lagged
from tidepanel.spec import PanelKey

DEFAULT_KEY = PanelKey(("country_code",), "year")


def pct_change(df: DataFrame, col: str, out: str, key: PanelKey = DEFAULT_KEY, fill: str = "pad",
               digits: int | None = 2, periods: int = 1, zero_base: str = "null") -> DataFrame:
    """``(x / previous row - 1) * 100`` per entity in period order, rounded.

    fill="pad" first carries the last non-NULL value forward (a NULL row then
    shows 0 % and the next row compares with the last known value); "none"
    compares raw neighbours. "Previous" is the previous *row*, not period - 1.
    A zero base gives NULL by default; ``zero_base="inf"`` reproduces the
    float result instead (+-inf, and NULL for 0 / 0).
    """
    w = Window.partitionBy(*key.entity).orderBy(key.period)
    if fill == "pad":
        base = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    elif fill == "none":
        base = F.col(col)
    else:
        raise ValueError("fill must be 'pad' or 'none'")
    return _grown(df.withColumn(_CUR, base).withColumn(_PREV, F.lag(_CUR, periods).over(w)), out, digits, zero_base)


def pct_change_long(df: DataFrame, col: str, out: str, span: int, key: PanelKey = DEFAULT_KEY, fill: str = "pad",
                    digits: int | None = 2, periods: int = 1, zero_base: str = "null") -> DataFrame:
    """``pct_change`` for entities of any length, span by span (see ``operators.scan``)."""
    if fill not in ("pad", "none"):
        raise ValueError("fill must be 'pad' or 'none'")
    if fill == "none":
        df = lagged(df, col, _PREV, periods, span, key).withColumn(_CUR, F.col(col))
    elif periods == 1:
        # the padded value of the row before is what is known before this row
        df = carried(df, [col], span, key).select(*df.columns, F.col(f"__p_{col}")["v"].alias(_CUR), F.col(f"__b_{col}")["v"].alias(_PREV))
    else:
        padded = carried(df, [col], span, key).select(*df.columns, F.col(f"__p_{col}")["v"].alias(_CUR))
        df = lagged(padded, _CUR, _PREV, periods, span, key)
    return _grown(df, out, digits, zero_base)


_CUR, _PREV = "__pc_base", "__pc_prev"


def _grown(df: DataFrame, out: str, digits: int | None, zero_base: str) -> DataFrame:
    cur, prev = F.col(_CUR), F.col(_PREV)
    value = np_round((F.try_divide(cur, prev) - F.lit(1.0)) * F.lit(100.0), digits)
    if zero_base == "inf":
        value = F.when((prev == 0) & (cur > 0), F.lit(float("inf"))) \
            .when((prev == 0) & (cur < 0), F.lit(float("-inf"))).otherwise(value)
    elif zero_base != "null":
        raise ValueError("zero_base must be 'null' or 'inf'")
    return df.withColumn(out, value).drop(_CUR, _PREV)
