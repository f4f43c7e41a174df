"""Per-entity gap filling over the period order.

All columns filled in one call share one exchange (by entity) and one sort per
direction. After de-duplication the key (entity, period) is unique, so one
window partition holds at most one row per period; entities with very many
periods are filled span by span (``forward_fill_long``, ``interpolate_long``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.scan import POS, carried
from tidepanel.spec import PanelKey

DEFAULT_KEY = PanelKey(("country_code",), "year")


def _w(key: PanelKey):
    return Window.partitionBy(*key.entity).orderBy(key.period)


def forward_fill(df: DataFrame, cols: Iterable[str], key: PanelKey = DEFAULT_KEY) -> DataFrame:
    """Last non-NULL value so far within each entity."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    back = _w(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(back) for c in cols})


def interpolate_linear(df: DataFrame, cols: Iterable[str], key: PanelKey = DEFAULT_KEY,
                       mode: str = "position", extrapolate: bool = True) -> DataFrame:
    """Linear interpolation between the neighbouring non-NULL values.

    mode="position": rows are equally spaced (pandas ``method="linear"``);
    mode="time": spacing follows the period value.
    Leading NULLs stay NULL. Trailing NULLs take the last value when
    ``extrapolate`` (pandas ``limit_direction="forward"``), else stay NULL.
    The slope form ``(n - p) / (nr - pr) * (x - pr) + p`` matches ``np.interp``.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if mode not in ("position", "time"):
        raise ValueError("mode must be 'position' or 'time'")
    w = _w(key)
    df = df.withColumn(_ROW, F.row_number().over(w))
    x = F.col(_ROW if mode == "position" else key.period)
    # both frames only grow, one along each direction, so a partition takes time linear in its rows
    until = (Window.unboundedPreceding, Window.currentRow)
    back = w.rowsBetween(*until)
    ahead = Window.partitionBy(*key.entity).orderBy(F.desc(_ROW)).rowsBetween(*until)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), x.alias("x"))) for c in cols}
    df = df.withColumns({f"__p_{c}": F.last(k, ignorenulls=True).over(back) for c, k in known.items()})
    df = df.withColumns({f"__n_{c}": F.last(k, ignorenulls=True).over(ahead) for c, k in known.items()})
    filled = {c: _between(F.col(c), F.col(f"__p_{c}"), F.col(f"__n_{c}"), x, extrapolate) for c in cols}
    return df.withColumns(filled).drop(_ROW, *[f"__{s}_{c}" for c in cols for s in "pn"])


_ROW = "__row"


def _between(v: Column, p: Column, n: Column, x: Column, extrapolate: bool) -> Column:
    """``v``, or the line between the known (v, x) before and after it."""
    inner = (n["v"] - p["v"]) / (n["x"] - p["x"]) * (x - p["x"]) + p["v"]
    return F.coalesce(v.cast("double"), F.when(p.isNull(), F.lit(None)).when(n.isNull(), p["v"] if extrapolate else F.lit(None)).otherwise(inner))


def forward_fill_long(df: DataFrame, cols: Iterable[str], span: int, key: PanelKey = DEFAULT_KEY) -> DataFrame:
    """``forward_fill`` for entities of any length, span by span (see ``operators.scan``)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    filled = carried(df, cols, span, key).withColumns({c: F.col(f"__p_{c}")["v"] for c in cols})
    return filled.select(*df.columns)


def interpolate_long(df: DataFrame, cols: Iterable[str], span: int, key: PanelKey = DEFAULT_KEY, extrapolate: bool = True, mode: str = "time") -> DataFrame:
    """``interpolate_linear`` for entities of any length, span by span (see ``operators.scan``).

    Known values are carried into a span with their period and their place in
    the entity, so both modes give what a window over the entity gives.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    if mode not in ("position", "time"):
        raise ValueError("mode must be 'position' or 'time'")
    x, at = (F.col(POS), "r") if mode == "position" else (F.col(key.period), "x")
    point = lambda s: F.when(F.col(s).isNotNull(), F.struct(F.col(s)["v"].cast("double").alias("v"), F.col(s)[at].alias("x")))
    filled = {c: _between(F.col(c), point(f"__p_{c}"), point(f"__n_{c}"), x, extrapolate) for c in cols}
    return carried(df, cols, span, key).withColumns(filled).select(*df.columns)


def fill_gaps(df: DataFrame, fill_forward: Iterable[str] = (), interpolate: Iterable[str] = (),
              key: PanelKey = DEFAULT_KEY) -> DataFrame:
    """Forward-fill some columns and interpolate others (one window family)."""
    return interpolate_linear(forward_fill(df, fill_forward, key), interpolate, key)
