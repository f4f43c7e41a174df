"""Gold layer: the fact table and the country dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.categorize import quadrant_label
from tidepanel.functions.numeric import safe_ratio
from tidepanel.operators.assemble import backfill_dim_attr, build_fact
from tidepanel.operators.growth import pct_change
from tidepanel.spec import PanelKey

KEY = PanelKey(("country_code",), "year")

# Columns each silver table contributes to the fact (when present).
FACT_CO2_COLS = ("country", "country_code", "year", "co2", "co2_per_capita", "co2_per_capita_calc",
                 "co2_intensity_gdp", "gdp", "gdp_per_capita", "gdp_growth_pct", "population", "share_global_co2")
FACT_TOURISM_COLS = ("country_code", "year", "tourist_arrivals", "tourism_receipts_usd", "tourist_departures",
                     "arrivals_growth_pct", "receipts_per_tourist")
FACT_TRANSPORT_COLS = ("country_code", "year", "tourists_air", "tourists_sea", "tourists_land", "tourists_total",
                       "pct_air", "pct_sea", "pct_land", "dominant_transport")


def gold_fact(co2: DataFrame, tourism: DataFrame, transport: DataFrame, method: str = "union") -> DataFrame:
    """C4: outer-assemble -> backfill country -> co2 per tourist -> co2 growth -> label.

    The three silver slices meet in one shuffle on (country_code, year); the
    backfill and growth windows then share one exchange on country_code.
    """
    fact = build_fact(co2, tourism, transport, ["country_code", "year"], method)
    fact = backfill_dim_attr(fact, "country", "country_code")
    fact = fact.withColumn("co2_per_tourist", safe_ratio("co2", "tourist_arrivals", 1e6, 4))
    fact = pct_change(fact, "co2", "co2_growth_pct", KEY)
    return fact.withColumn("sustainability_label", quadrant_label("gdp_growth_pct", "co2_growth_pct"))


def sort_fact(fact: DataFrame) -> DataFrame:
    """Output order only (use sortWithinPartitions before writes)."""
    return fact.orderBy("country_code", "year")
