"""Rule-based labelling expressions (when-chains; no Python per row)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepanel.functions._col import as_col

# Keyword -> transport mode, checked in this priority order.
TRANSPORT_KEYWORDS = (("air", "air"), ("land", "land"), ("water", "sea"), ("total", "total"))

# Sustainability quadrant labels.
QUADRANT_LABELS = {
    "no_data": "sin_datos",
    "green": "verde",
    "yellow": "amarillo",
    "red": "rojo",
    "grey": "gris",
}


def classify_keyword(c, rules: Sequence[tuple[str, str]] = TRANSPORT_KEYWORDS) -> Column:
    """Case-insensitive substring rules, first match wins, else NULL."""
    low = F.lower(as_col(c))
    out = None
    for needle, label in rules:
        cond = low.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def dominant_category(cols: Mapping[str, object]) -> Column:
    """Label of the largest value; NULLs skipped; ties go to the first label.

    ``cols`` maps label -> column in priority order.
    """
    items = [(label, as_col(c)) for label, c in cols.items()]
    top = F.greatest(*[c for _, c in items]) if len(items) > 1 else items[0][1]
    out = None
    for label, c in items:
        cond = c.isNotNull() & (c == top)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def quadrant_label(x, y, labels: Mapping[str, str] = QUADRANT_LABELS) -> Column:
    """Two-signal quadrant classifier (x = economic growth, y = emissions growth).

    either NULL -> no_data; x>0 & y<=0 -> green; x>0 & y>0 -> yellow;
    x<=0 & y>0 -> red; otherwise grey.
    """
    x, y = as_col(x), as_col(y)
    return (
        F.when(x.isNull() | y.isNull(), F.lit(labels["no_data"]))
        .when((x > 0) & (y <= 0), F.lit(labels["green"]))
        .when((x > 0) & (y > 0), F.lit(labels["yellow"]))
        .when((x <= 0) & (y > 0), F.lit(labels["red"]))
        .otherwise(F.lit(labels["grey"]))
    )


def sign_flag(c, positive: str = "up", negative: str = "down") -> Column:
    """``positive`` when value >= 0, ``negative`` when < 0, NULL when NULL."""
    c = as_col(c)
    return F.when(c >= 0, F.lit(positive)).when(c < 0, F.lit(negative))
