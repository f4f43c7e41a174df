"""Plain-SQL (DuckDB dialect) statements of the same computations.

These are the independent oracles the driver runs next to the Spark plans.
Each CTE restates one layer in SQL windows/aggregates; ``with_ctes`` chains
the needed ones in front of a final SELECT. Rounding is NumPy's
(``round_even(x * 10^n, 0) / 10^n``) and every division is guarded.
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    s = f"{float(10 ** n)}::DOUBLE"
    return f"(round_even(({expr}) * {s}, 0) / {s})"


def _dec_to_double(e: str) -> str:
    # correctly rounded DECIMAL -> DOUBLE: through the exact decimal text (a direct cast
    # divides a 128-bit integer by 10^scale in floating point and may round twice)
    return f"cast(cast({e} as varchar) as double)"


def _to_dec(col: str) -> str:
    # DOUBLE -> DECIMAL from the shortest decimal text of the double (how Spark converts),
    # not from value * 10^scale in floating point
    return f"cast(cast({col} as varchar) as decimal(38,10))"


def xavg(col: str, n: int | None = None) -> str:
    """Exact-sum mean (same steps as ``exact_avg``), optionally rounded half-even."""
    e = f"{_dec_to_double(f'sum({_to_dec(col)})')} / count({col})"
    return rnd(e, n) if n is not None else f"({e})"


def xsum(col: str) -> str:
    return _dec_to_double(f"sum({_to_dec(col)})")


NATION_CODE = "replace(n.n_name, 'NATION_', 'N')"

CTES: dict[str, str] = {}

CTES["panel_co2"] = f"""
select n.n_name as country, {NATION_CODE} as country_code,
       cast(year(o.o_orderdate) as bigint) as year,
       cast(sum(cast(o.o_totalprice as decimal(18,2))) as double) / 1000000 as co2,
       case when (n.n_nationkey * 7 + year(o.o_orderdate)) % 6 = 0 then null
            else cast(sum(cast(o.o_totalprice as decimal(18,2))) as double) * 10 end as gdp,
       case when (n.n_nationkey + year(o.o_orderdate)) % 9 = 0 then null
            else cast(count(distinct o.o_custkey) as double) end as population
from orders o join customer c on o.o_custkey = c.c_custkey
     join nation n on c.c_nationkey = n.n_nationkey
group by n.n_name, n.n_nationkey, year(o.o_orderdate)"""

CTES["panel_tourism"] = f"""
select n.n_name as country, {NATION_CODE} as country_code,
       cast(year(l.l_shipdate) as bigint) as year,
       case when (n.n_nationkey + year(l.l_shipdate)) % 7 = 0 then null
            else sum(l.l_quantity) end as tourist_arrivals,
       cast(sum(cast(l.l_extendedprice as decimal(18,2))) as double) as tourism_receipts_usd,
       cast(count(*) as double) as tourist_departures
from lineitem l join supplier s on l.l_suppkey = s.s_suppkey
     join nation n on s.s_nationkey = n.n_nationkey
group by n.n_name, n.n_nationkey, year(l.l_shipdate)"""

CTES["panel_transport_long"] = f"""
select n.n_name as country, {NATION_CODE} as country_code,
       cast(year(l.l_shipdate) as bigint) as year,
       case l.l_returnflag when 'A' then 'air' when 'N' then 'sea' else 'land' end as transport_mode,
       sum(l.l_quantity) as value
from lineitem l join supplier s on l.l_suppkey = s.s_suppkey
     join nation n on s.s_nationkey = n.n_nationkey
where not (l.l_returnflag = 'N' and (n.n_nationkey + year(l.l_shipdate)) % 3 = 0)
group by n.n_name, n.n_nationkey, year(l.l_shipdate), l.l_returnflag"""

CTES["dim_country"] = f"""
select {NATION_CODE} as country_code, lpad(cast(n.n_nationkey as varchar), 2, '0') as country_code_iso2,
       n.n_name as country_name, r.r_name as region
from nation n join region r on n.n_regionkey = r.r_regionkey"""

CTES["long_sheet"] = """
select case when cast(substr(country_code, 2) as int) % 4 = 0 then country || ' (Rep.)' else country end
         as reporter_area_label,
       year,
       case transport_mode when 'air' then 'Inbound arrivals by air' when 'sea' then 'Inbound arrivals by water'
            else 'Inbound arrivals by land' end as indicator_label,
       value
from panel_transport_long
union all
select case when cast(substr(country_code, 2) as int) % 4 = 0 then country || ' (Rep.)' else country end,
       year, 'Outbound departures by land', value
from panel_transport_long where transport_mode = 'land'"""

_WB = "partition by country_code order by year rows between unbounded preceding and current row"
_WF = "partition by country_code order by year rows between current row and unbounded following"
_WO = "partition by country_code order by year"


def _pct(col: str, src: str) -> tuple[str, str]:
    """Two CTE bodies: pad, then lag -> growth % (r2)."""
    pad = f"select *, last_value({col} ignore nulls) over ({_WB}) as __pad from {src}"
    growth = rnd(f"(__pad / nullif(lag(__pad) over ({_WO}), 0) - 1.0) * 100.0", 2)
    return pad, growth


# silver co2: dedup (keys are unique per panel; keep the smallest row), drop empty, fill, derive
CTES["s_co2_a"] = """
select country, upper(trim(country_code)) as country_code, cast(year as bigint) as year, co2, gdp, population
from panel_co2
where not (co2 is null and gdp is null and population is null)
qualify row_number() over (partition by upper(trim(country_code)), cast(year as bigint)
                           order by country, co2, gdp, population) = 1"""
CTES["s_co2_b"] = f"""
select *, row_number() over ({_WO}) as __rn from s_co2_a"""
CTES["s_co2_c"] = f"""
select country, country_code, year, co2, __rn,
       last_value(population ignore nulls) over ({_WB}) as population, gdp as __g,
       last_value(gdp ignore nulls) over ({_WB}) as __p,
       last_value(case when gdp is not null then __rn end ignore nulls) over ({_WB}) as __pr,
       first_value(gdp ignore nulls) over ({_WF}) as __n,
       first_value(case when gdp is not null then __rn end ignore nulls) over ({_WF}) as __nr
from s_co2_b"""
CTES["s_co2_d"] = """
select country, country_code, year, co2,
       cast(coalesce(__g, case when __p is null then null when __n is null then __p
                       else (__n - __p) / (__nr - __pr) * (__rn - __pr) + __p end) as double) as gdp,
       population
from s_co2_c"""
_pad, _growth = _pct("gdp", "s_co2_d")
CTES["s_co2_e"] = _pad
CTES["silver_co2"] = f"""
select country, country_code, year, co2, gdp, population,
       case when population > 0 then {rnd('co2 * 1000000.0::DOUBLE / population', 4)} end as co2_per_capita_calc,
       case when gdp > 0 then {rnd('co2 * 1000000000.0::DOUBLE / gdp', 6)} end as co2_intensity_gdp,
       case when population > 0 and gdp > 0 then {rnd('gdp / population', 2)} end as gdp_per_capita,
       {_growth} as gdp_growth_pct
from s_co2_e"""

CTES["s_tour_a"] = """
select country, upper(trim(country_code)) as country_code, cast(year as bigint) as year,
       tourist_arrivals, tourism_receipts_usd, tourist_departures
from panel_tourism
where tourist_arrivals is not null
qualify row_number() over (partition by upper(trim(country_code)), cast(year as bigint)
                           order by country, tourist_arrivals, tourism_receipts_usd, tourist_departures) = 1"""
_pad, _growth = _pct("tourist_arrivals", "s_tour_a")
CTES["s_tour_b"] = _pad
CTES["silver_tourism"] = f"""
select country, country_code, year, tourist_arrivals, tourism_receipts_usd, tourist_departures,
       {_growth} as arrivals_growth_pct,
       case when tourist_arrivals > 0 then {rnd('tourism_receipts_usd / tourist_arrivals', 2)} end
         as receipts_per_tourist
from s_tour_b"""


def _pcts(total: str) -> str:
    return ",\n       ".join(
        f"case when {total} > 0 then {rnd(f'tourists_{m} / {total} * 100.0::DOUBLE', 2)} end as pct_{m}"
        for m in ("air", "sea", "land"))


def _dominant() -> str:
    g = "greatest(pct_air, pct_sea, pct_land)"
    return (f"case when pct_air is not null and pct_air = {g} then 'air' "
            f"when pct_sea is not null and pct_sea = {g} then 'sea' "
            f"when pct_land is not null and pct_land = {g} then 'land' end")


_MODE_SUM = ("case when tourists_air is null and tourists_sea is null and tourists_land is null then null "
             "else coalesce(tourists_air, 0) + coalesce(tourists_sea, 0) + coalesce(tourists_land, 0) end")

CTES["bronze_transport_a"] = """
select country, country_code, year,
       cast(sum(case when transport_mode = 'air' then coalesce(value, 0) end) as double) as tourists_air,
       cast(sum(case when transport_mode = 'sea' then coalesce(value, 0) end) as double) as tourists_sea,
       cast(sum(case when transport_mode = 'land' then coalesce(value, 0) end) as double) as tourists_land,
       cast(sum(case when transport_mode = 'total' then coalesce(value, 0) end) as double) as tourists_total
from panel_transport_long
group by country, country_code, year"""
CTES["bronze_transport"] = f"""
select country, country_code, year, tourists_air, tourists_sea, tourists_land,
       coalesce(tourists_total, {_MODE_SUM}) as tourists_total
from bronze_transport_a"""
CTES["bronze_transport_wide"] = f"""
select country, country_code, year, tourists_air, tourists_sea, tourists_land, tourists_total,
       {_pcts('tourists_total')}
from bronze_transport"""
CTES["s_tr_a"] = f"""
select country, upper(trim(country_code)) as country_code, cast(year as bigint) as year,
       tourists_air, tourists_sea, tourists_land, coalesce(tourists_total, {_MODE_SUM}) as tourists_total
from bronze_transport_wide
where not (tourists_air is null and tourists_sea is null and tourists_land is null)"""
CTES["s_tr_b"] = f"""
select *, {_pcts('tourists_total')} from s_tr_a"""
CTES["silver_transport"] = f"""
select country, country_code, year, tourists_air, tourists_sea, tourists_land, tourists_total,
       pct_air, pct_sea, pct_land, {_dominant()} as dominant_transport
from s_tr_b"""

# gold fact: full outer assembly on (country_code, year)
CTES["g_a"] = """
select coalesce(c.country_code, t.country_code, r.country_code) as country_code,
       coalesce(c.year, t.year, r.year) as year,
       c.country, c.co2, c.co2_per_capita_calc, c.co2_intensity_gdp, c.gdp, c.gdp_per_capita,
       c.gdp_growth_pct, c.population,
       t.tourist_arrivals, t.tourism_receipts_usd, t.tourist_departures, t.arrivals_growth_pct,
       t.receipts_per_tourist,
       r.tourists_air, r.tourists_sea, r.tourists_land, r.tourists_total, r.pct_air, r.pct_sea, r.pct_land,
       r.dominant_transport
from silver_co2 c
full outer join silver_tourism t on c.country_code = t.country_code and c.year = t.year
full outer join silver_transport r
  on coalesce(c.country_code, t.country_code) = r.country_code and coalesce(c.year, t.year) = r.year"""
CTES["g_b"] = """
select * replace (coalesce(country, max(country) over (partition by country_code)) as country),
       case when tourist_arrivals > 0 then """ + rnd("co2 * 1000000.0::DOUBLE / tourist_arrivals", 4) + """ end
         as co2_per_tourist
from g_a"""
_pad, _growth = _pct("co2", "g_b")
CTES["g_c"] = _pad
CTES["fact"] = f"""
select country, country_code, year, co2, co2_per_capita_calc, co2_intensity_gdp, gdp, gdp_per_capita,
       gdp_growth_pct, population, tourist_arrivals, tourism_receipts_usd, tourist_departures,
       arrivals_growth_pct, receipts_per_tourist, tourists_air, tourists_sea, tourists_land, tourists_total,
       pct_air, pct_sea, pct_land, dominant_transport, co2_per_tourist, co2_growth_pct,
       case when gdp_growth_pct is null or co2_growth_pct is null then 'sin_datos'
            when gdp_growth_pct > 0 and co2_growth_pct <= 0 then 'verde'
            when gdp_growth_pct > 0 and co2_growth_pct > 0 then 'amarillo'
            when gdp_growth_pct <= 0 and co2_growth_pct > 0 then 'rojo'
            else 'gris' end as sustainability_label
from (select *, {_growth} as co2_growth_pct from g_c)"""
CTES["merged"] = """
select f.*, d.country_code_iso2, d.country_name, d.region
from fact f left join dim_country d on f.country_code = d.country_code"""

# dependencies of each CTE (the rest read only the base tables)
_DEPS = {
    "s_co2_a": ["panel_co2"], "s_co2_b": ["s_co2_a"], "s_co2_c": ["s_co2_b"], "s_co2_d": ["s_co2_c"],
    "s_co2_e": ["s_co2_d"], "silver_co2": ["s_co2_e"],
    "s_tour_a": ["panel_tourism"], "s_tour_b": ["s_tour_a"], "silver_tourism": ["s_tour_b"],
    "bronze_transport_a": ["panel_transport_long"], "bronze_transport": ["bronze_transport_a"],
    "bronze_transport_wide": ["bronze_transport"], "s_tr_a": ["bronze_transport_wide"], "s_tr_b": ["s_tr_a"],
    "silver_transport": ["s_tr_b"],
    "g_a": ["silver_co2", "silver_tourism", "silver_transport"], "g_b": ["g_a"], "g_c": ["g_b"], "fact": ["g_c"],
    "merged": ["fact", "dim_country"], "long_sheet": ["panel_transport_long"],
}


def _closure(names: list[str]) -> list[str]:
    need: set[str] = set()

    def add(n):
        if n not in need:
            need.add(n)
            for d in _DEPS.get(n, []):
                add(d)

    for n in names:
        add(n)
    return [n for n in CTES if n in need]


def with_ctes(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs it needs (and their dependencies)."""
    parts = [f"{n} as ({CTES[n]})" for n in _closure(list(names))]
    for k, v in (extra or {}).items():
        parts.append(f"{k} as ({v})")
    return ("with " + ",\n".join(parts) + "\n" + sql) if parts else sql


# ── large panels (entity × period) ──────────────────────────────────────────
CTES["panel_part_month"] = """
select entity, period,
       case when (entity + period) % 7 = 0 then null else sum(l_quantity) end as arrivals,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as receipts,
       cast(count(*) as double) as departures
from (select l_partkey as entity, cast(year(l_shipdate) * 100 + month(l_shipdate) as bigint) as period,
             l_quantity, l_extendedprice from lineitem)
group by entity, period"""

CTES["panel_user_day"] = """
select user_id as entity, cast(strftime(ts, '%Y%m%d') as bigint) as period,
       case when (user_id + cast(strftime(ts, '%Y%m%d') as bigint)) % 5 = 0 then null
            else cast(sum(cast(value as decimal(18,2))) as double) end as arrivals,
       cast(count(*) as double) as departures
from events group by user_id, cast(strftime(ts, '%Y%m%d') as bigint)"""


def volume_silver_sql(src: str, receipts: bool) -> str:
    """Oracle of ``volume_silver`` over a panel CTE with (entity, period, arrivals, ...)."""
    wb = "partition by entity order by period rows between unbounded preceding and current row"
    wf = "partition by entity order by period rows between current row and unbounded following"
    wo = "partition by entity order by period"
    cols = "entity, period, arrivals, receipts, departures" if receipts else "entity, period, arrivals, departures"
    rpu = (f", case when arrivals > 0 then {rnd('receipts / arrivals', 2)} end as receipts_per_unit"
           if receipts else "")
    keep = "entity, period, receipts, departures" if receipts else "entity, period, departures"
    return f"""
select {keep}, arrivals, {rnd(f"(pad / nullif(lag(pad) over ({wo}), 0) - 1.0) * 100.0", 2)} as arrivals_growth_pct
       {rpu}
from (select *, last_value(arrivals ignore nulls) over ({wb}) as pad from (
  select {keep},
         cast(coalesce(arrivals, case when __p is null then null when __n is null then __p
                       else (__n - __p) / (__nr - __pr) * (__rn - __pr) + __p end) as double) as arrivals
  from (select *, last_value(arrivals ignore nulls) over ({wb}) as __p,
               last_value(case when arrivals is not null then __rn end ignore nulls) over ({wb}) as __pr,
               first_value(arrivals ignore nulls) over ({wf}) as __n,
               first_value(case when arrivals is not null then __rn end ignore nulls) over ({wf}) as __nr
        from (select *, row_number() over ({wo}) as __rn
              from (select {cols} from {src} where not (arrivals is null and departures is null))))))"""
