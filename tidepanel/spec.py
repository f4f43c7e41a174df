"""Declarative panel key and per-layer schema specs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelKey:
    """Grain of a panel: one row per (entity..., period)."""

    entity: tuple[str, ...] = ("country_code",)
    period: str = "year"

    @property
    def cols(self) -> list[str]:
        return [*self.entity, self.period]


@dataclass(frozen=True)
class SchemaSpec:
    """What a layer expects of a dataset.

    required          columns that must exist (missing -> ValueError)
    numeric           columns coerced to double (unparsable -> NULL)
    drop_null_if_all  drop a row when all of these are NULL
    fill_forward      carried forward per entity
    interpolate       linearly interpolated per entity (positional)
    null_thresholds   % of NULLs above which the quality report warns
    """

    required: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    drop_null_if_all: tuple[str, ...] = ()
    fill_forward: tuple[str, ...] = ()
    interpolate: tuple[str, ...] = ()
    null_thresholds: dict = field(default_factory=dict)


# Per-dataset rules of the silver layer (columns, fills, thresholds).
CO2_SPEC = SchemaSpec(
    required=("country", "country_code", "year", "co2"),
    numeric=(
        "co2", "co2_per_capita", "co2_per_gdp", "cumulative_co2", "methane",
        "nitrous_oxide", "gdp", "population", "energy_per_capita", "share_global_co2",
    ),
    drop_null_if_all=("co2", "gdp", "population"),
    fill_forward=("population",),
    interpolate=("gdp",),
    null_thresholds={"co2": 30.0, "gdp": 40.0, "population": 10.0},
)

TOURISM_SPEC = SchemaSpec(
    required=("country", "country_code", "year", "tourist_arrivals"),
    numeric=("tourist_arrivals", "tourism_receipts_usd", "tourist_departures"),
    drop_null_if_all=("tourist_arrivals",),
    null_thresholds={"tourist_arrivals": 40.0, "tourism_receipts_usd": 60.0},
)

TRANSPORT_SPEC = SchemaSpec(
    required=("country", "country_code", "year"),
    numeric=(
        "tourists_air", "tourists_sea", "tourists_land", "tourists_total",
        "pct_air", "pct_sea", "pct_land",
    ),
    drop_null_if_all=("tourists_air", "tourists_sea", "tourists_land"),
    null_thresholds={"tourists_total": 60.0},
)
