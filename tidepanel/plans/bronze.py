"""Bronze layer: landed sources -> typed, filtered, keyed panels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.categorize import classify_keyword
from tidepanel.functions.numeric import safe_ratio, to_numeric
from tidepanel.functions.text import alias_lookup
from tidepanel.operators.assemble import pivot_modes, total_if_missing
from tidepanel.operators.clean import filter_members, filter_period, flag_duplicates, map_code
from tidepanel.plans.silver import MODES
from tidepanel.sources.sinks import Landed, write_gated


# The share of missing values at which a landed source is refused, per dataset.
GATES = {"co2_emissions": {"co2": 30.0}, "tourism_arrivals": {"tourist_arrivals": 60.0}, "transport_mode": {"tourists_total": 95.0}}


def land(df: DataFrame, dataset: str, path: str) -> Landed:
    """Write a bronze panel, if it passes the gate of its dataset; the source runs once."""
    return write_gated(df.drop("is_duplicate"), path, GATES[dataset])


def _in_window(df: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Rows with a year, of [start, end] as far as given."""
    if start is not None and end is not None:
        return filter_period(df, start, end)
    df = df.where(F.col("year").isNotNull())
    df = df if start is None else df.where(F.col("year") >= start)
    return df if end is None else df.where(F.col("year") <= end)


def transport_from_sheet(sheet: DataFrame, aliases: Mapping[str, str], members, codes: DataFrame | Mapping,
                         start: int | None = None, end: int | None = None) -> DataFrame:
    """Long indicator sheet -> wide transport panel.

    inbound rows only -> keyword mode (air > land > water->sea > total) ->
    canonical names -> member filter -> numeric coercion and period filter ->
    pivot (one shuffle) -> total if missing -> code lookup -> mode shares ->
    duplicates flagged. Without ``start`` / ``end`` all years stay.
    """
    df = sheet.where(F.lower(F.col("indicator_label")).contains("inbound"))
    df = df.withColumn("transport_mode", classify_keyword("indicator_label")).where(F.col("transport_mode").isNotNull())
    df = df.withColumn("country", alias_lookup("reporter_area_label", aliases))
    df = filter_members(df, "country", members)
    df = df.withColumns({"year": to_numeric("year", "bigint"), "value": to_numeric("value")})
    df = _in_window(df, start, end)
    wide = pivot_modes(df, ["country", "year"], "transport_mode", "value", ["air", "sea", "land", "total"],
                       prefix="tourists_")
    wide = total_if_missing(wide, "tourists_total", [f"tourists_{m}" for m in MODES])
    wide = map_code(wide, "country", "country_code", codes)
    wide = wide.withColumns({f"pct_{m}": safe_ratio(f"tourists_{m}", "tourists_total", 100.0, 2, scale_after=True)
                             for m in MODES})
    wide = wide.select("country", "country_code", "year", *[f"tourists_{m}" for m in (*MODES, "total")],
                       *[f"pct_{m}" for m in MODES])
    return flag_duplicates(wide, ["country_code", "year"])


# Columns the emissions source may carry (the available ones are kept).
CO2_SOURCE_COLS = ("country", "year", "co2", "co2_per_capita", "co2_per_gdp", "cumulative_co2", "methane",
                   "nitrous_oxide", "gdp", "population", "energy_per_capita", "share_global_co2")


def co2_from_wide(raw: DataFrame, aliases: Mapping[str, str], members, codes: DataFrame | Mapping,
                  start: int | None = None, end: int | None = None) -> DataFrame:
    """Wide landed table (text columns) -> typed bronze emissions panel.

    canonical names -> member filter -> period filter -> available source
    columns -> code lookup -> numeric coercion -> sorted, duplicates flagged.
    """
    from tidepanel.operators.clean import select_available

    df = raw.withColumn("country", alias_lookup("country", aliases))
    df = filter_members(df, "country", members)
    df = df.withColumn("year", to_numeric("year", "bigint"))
    df = _in_window(df, start, end)
    df, _missing = select_available(df, CO2_SOURCE_COLS)
    df = map_code(df, "country", "country_code", codes)
    nums = [c for c in df.columns if c not in ("country", "country_code", "year")]
    df = df.withColumns({c: to_numeric(c) for c in nums})
    df = df.select("country", "country_code", "year", *nums)
    return flag_duplicates(df, ["country_code", "year"])


def tourism_from_indicators(frames) -> DataFrame:
    """Single-indicator frames (country, country_code, year, value) -> one table (full outer), duplicates flagged.

    Joined rather than grouped: landed frames may have a key twice, and all its rows are kept and marked.
    """
    from tidepanel.operators.assemble import assemble_indicators

    wide = assemble_indicators(list(frames), ["country", "country_code", "year"], method="join")
    return flag_duplicates(wide, ["country_code", "year"])
