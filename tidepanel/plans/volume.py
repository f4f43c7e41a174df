"""The silver operators on large panels (part × month, user × day).

Same operator code as the nation panels, with entity and period passed as
parameters. These panels grow with the fact tables, so they are the
volume benchmark of the toolkit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidepanel.functions.numeric import safe_ratio
from tidepanel.operators.clean import dedup_first, drop_empty_rows
from tidepanel.operators.fill import fill_gaps
from tidepanel.operators.growth import pct_change
from tidepanel.spec import PanelKey

VKEY = PanelKey(("entity",), "period")


def volume_silver(panel: DataFrame, key: PanelKey = VKEY) -> DataFrame:
    """dedup -> drop empty -> interpolate arrivals -> growth -> receipts per unit."""
    df = dedup_first(panel, key.cols, key.period)  # the panels are unique on the key
    df = drop_empty_rows(df, ["arrivals", "departures"])
    df = fill_gaps(df, interpolate=["arrivals"], key=key)
    df = pct_change(df, "arrivals", "arrivals_growth_pct", key)
    if "receipts" in df.columns:
        df = df.withColumn("receipts_per_unit", safe_ratio("receipts", "arrivals", 1.0, 2))
    return df
