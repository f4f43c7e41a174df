"""Silver layer: typed, de-duplicated, gap-filled panels with derived metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.categorize import dominant_category
from tidepanel.functions.numeric import safe_ratio
from tidepanel.operators.assemble import pivot_modes, total_if_missing
from tidepanel.operators.clean import apply_schema, dedup_first, drop_empty_rows, reorder_columns
from tidepanel.operators.fill import fill_gaps
from tidepanel.operators.growth import pct_change
from tidepanel.spec import CO2_SPEC, TOURISM_SPEC, TRANSPORT_SPEC, PanelKey

KEY = PanelKey(("country_code",), "year")
KEY_COLS = ["country", "country_code", "year"]
MODES = ("air", "sea", "land")


def co2_derived(df: DataFrame, key: PanelKey = KEY) -> DataFrame:
    """Per-capita, intensity, per-capita GDP (guarded ratios) and GDP growth."""
    df = df.withColumns({
        "co2_per_capita_calc": safe_ratio("co2", "population", 1e6, 4),
        "co2_intensity_gdp": safe_ratio("co2", "gdp", 1e9, 6),
        "gdp_per_capita": safe_ratio("gdp", "population", 1.0, 2, extra_mask=F.col("gdp") > 0),
    })
    return pct_change(df, "gdp", "gdp_growth_pct", key)


def _first_rows(df: DataFrame, key: PanelKey, order_by) -> DataFrame:
    """The first row per key; a column that only numbers the rows goes."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return dedup_first(df, key.cols, order).drop(*[c for c in order if c not in key.cols])


def silver_co2(bronze: DataFrame, order_by, key: PanelKey = KEY) -> DataFrame:
    """Schema -> first row per key in ``order_by`` order -> drop empty -> ffill population / interpolate gdp -> derived."""
    df = apply_schema(bronze, CO2_SPEC, key)
    df = _first_rows(df, key, order_by)
    df = drop_empty_rows(df, CO2_SPEC.drop_null_if_all)
    df = fill_gaps(df, CO2_SPEC.fill_forward, CO2_SPEC.interpolate, key)
    df = co2_derived(df, key)
    return reorder_columns(df, KEY_COLS, CO2_SPEC.numeric,
                           ["co2_per_capita_calc", "co2_intensity_gdp", "gdp_per_capita", "gdp_growth_pct"])


def silver_tourism(bronze: DataFrame, order_by, key: PanelKey = KEY) -> DataFrame:
    """Schema -> first row per key -> drop rows without arrivals -> growth, receipts per tourist."""
    df = apply_schema(bronze, TOURISM_SPEC, key)
    df = _first_rows(df, key, order_by)
    df = drop_empty_rows(df, TOURISM_SPEC.drop_null_if_all)
    df = pct_change(df, "tourist_arrivals", "arrivals_growth_pct", key)
    df = df.withColumn("receipts_per_tourist", safe_ratio("tourism_receipts_usd", "tourist_arrivals", 1.0, 2))
    return reorder_columns(df, KEY_COLS, TOURISM_SPEC.numeric, ["arrivals_growth_pct", "receipts_per_tourist"])


def mode_shares(df: DataFrame, total: str = "tourists_total", modes=MODES) -> DataFrame:
    """pct_<mode> = mode / total * 100 (r2) where total > 0; dominant mode."""
    df = df.withColumns({f"pct_{m}": safe_ratio(f"tourists_{m}", total, 100.0, 2, scale_after=True)
                         for m in modes if f"tourists_{m}" in df.columns})
    pcts = {m: f"pct_{m}" for m in modes if f"pct_{m}" in df.columns}
    return df.withColumn("dominant_transport", dominant_category(pcts)) if pcts else df


def bronze_transport_wide(long_df: DataFrame) -> DataFrame:
    """Long (entity, year, mode, value) -> wide tourists_<mode>, total, pct_<mode>."""
    wide = pivot_modes(long_df, ["country", "country_code", "year"], "transport_mode", "value",
                       ["air", "sea", "land", "total"], prefix="tourists_")
    wide = total_if_missing(wide, "tourists_total", [f"tourists_{m}" for m in MODES])
    wide = wide.withColumns({f"pct_{m}": safe_ratio(f"tourists_{m}", "tourists_total", 100.0, 2, scale_after=True)
                             for m in MODES})
    return wide


def silver_transport(bronze: DataFrame, order_by, key: PanelKey = KEY) -> DataFrame:
    """Schema -> first row per key -> drop empty -> total if missing -> shares -> dominant mode."""
    df = apply_schema(bronze, TRANSPORT_SPEC, key)
    df = _first_rows(df, key, order_by)
    df = drop_empty_rows(df, TRANSPORT_SPEC.drop_null_if_all)
    df = total_if_missing(df, "tourists_total", [f"tourists_{m}" for m in MODES])
    df = mode_shares(df)
    return reorder_columns(df, KEY_COLS, TRANSPORT_SPEC.numeric, ["dominant_transport"])
