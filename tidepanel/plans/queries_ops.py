"""Registered queries for the single operators (PF*, J*, A*, W*, SL*, SO*, F*) and the API questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.functions.categorize import classify_keyword, dominant_category, quadrant_label, sign_flag
from tidepanel.functions.numeric import exact_avg, exact_sum, np_round, safe_ratio, to_numeric
from tidepanel.functions.text import alias_lookup, normalize_column_names
from tidepanel.operators import assemble, clean, compare, fill, growth, rank, stats
from tidepanel.operators.quality import row_count_by_entity
from tidepanel.plans import bronze, panels, silver
from tidepanel.plans.oracle import rnd, with_ctes, xavg, xsum
from tidepanel.plans.queries import MIN_YEAR, fact, merged, s_co2, s_tourism
from tidepanel.plans.registry import register
from tidepanel.session import checkpointed
from tidepanel.spec import CO2_SPEC, PanelKey

# Fixed parameters of the registered questions on the 1995–2001 panels.
PRE_YEAR, POST_YEAR = 1996, 2000   # pre/post comparison (falls back to min/max year when absent)
YOY_YEAR = 1999                    # year of the growth ranking
SLICE_YEARS = (1996, 2000)
SLICE_MEMBERS = ("N1", "N2", "N3", "N10")

_ALIASES = panels.reporter_aliases()
_ALIAS_SQL = ", ".join(f"'{k}'" for k in _ALIASES)
_NORM_SQL = (f"case when reporter_area_label in ({_ALIAS_SQL}) "
             f"then replace(reporter_area_label, ' (Rep.)', '') else reporter_area_label end")
_MODE_SQL = ("case when lower(indicator_label) like '%air%' then 'air' "
             "when lower(indicator_label) like '%land%' then 'land' "
             "when lower(indicator_label) like '%water%' then 'sea' "
             "when lower(indicator_label) like '%total%' then 'total' end")
_WB = "partition by country_code order by year rows between unbounded preceding and current row"
_WF = "partition by country_code order by year rows between current row and unbounded following"
_WO = "partition by country_code order by year"


# Pre/post periods of J5 / API Q7: the requested years, falling back to the first/last year.
_YRS = f"""select case when count(*) filter (where year = {PRE_YEAR}) > 0 then {PRE_YEAR} else min(year) end as pre,
               case when count(*) filter (where year = {POST_YEAR}) > 0 then {POST_YEAR} else max(year) end as post
        from merged"""


def _periods(spark, d):
    """First/last period and the pre/post periods (with fallback) of the gold fact, as scalar subqueries.

    Nothing runs until the question does; Spark evaluates each once and pushes it to the scan as a filter.
    """
    y = fact(spark, d).select("year")
    y0, y1 = y.select(F.min("year")).scalar(), y.select(F.max("year")).scalar()
    pre = F.coalesce(y.where(F.col("year") == PRE_YEAR).select(F.min("year")).scalar(), y0)
    post = F.coalesce(y.where(F.col("year") == POST_YEAR).select(F.min("year")).scalar(), y1)
    return {"first": y0, "last": y1, "pre": pre, "post": post}


def _pre_post(spark, d):
    p = _periods(spark, d)
    return p["pre"], p["post"]


_CMP_SQL = """
select country_name, coalesce(sum(case when year = (select pre from yrs) then tourist_arrivals end), 0) as arrivals_pre,
       coalesce(sum(case when year = (select post from yrs) then tourist_arrivals end), 0) as arrivals_post
from merged where country_name is not null and (year = (select pre from yrs) or year = (select post from yrs))
group by country_name
having count(case when year = (select pre from yrs) then 1 end) > 0
   and count(case when year = (select post from yrs) then 1 end) > 0"""


_PC_SQL = with_ctes(_CMP_SQL, "merged", extra={"yrs": _YRS})
_Q7_SQL = with_ctes("select * from pc order by arrivals_post desc, country_name limit 15", "merged",
                    extra={"yrs": _YRS, "pc": _CMP_SQL})


# ── 2.2 projections / filters ───────────────────────────────────────────────
@register("normalize_names", with_ctes(f"""
select reporter_area_label, {_NORM_SQL} as country, year, indicator_label, value from long_sheet""", "long_sheet"))
def q_normalize_names(spark, d):
    """PF1: alias map lookup, default = input."""
    s = panels.long_indicator_sheet(spark, d)
    return s.select("reporter_area_label", alias_lookup("reporter_area_label", _ALIASES).alias("country"),
                    "year", "indicator_label", "value")


@register("filter_members", with_ctes("""
select p.* from panel_co2 p
where p.country_code in (select country_code from dim_country where region = 'AMERICA')""",
                                      "panel_co2", "dim_country"))
def q_filter_members(spark, d):
    """PF2: keep rows whose entity is in an allow-list (a DataFrame -> left-semi join)."""
    allow = panels.dim_country(spark, d).where(F.col("region") == "AMERICA").select("country_code")
    return clean.filter_members(panels.panel_co2(spark, d), "country_code", allow)


@register("filter_period", with_ctes("select * from panel_co2 where year between 1996 and 1999", "panel_co2"))
def q_filter_period(spark, d):
    """PF3: inclusive period range."""
    return clean.filter_period(panels.panel_co2(spark, d), 1996, 1999)


@register("select_available", with_ctes("select country_code, year, co2, gdp from panel_co2", "panel_co2"))
def q_select_available(spark, d):
    """PF4: project the wanted columns that exist (co2_per_capita, share_global_co2 are absent)."""
    out, _missing = clean.select_available(panels.panel_co2(spark, d),
                                           ["country_code", "year", "co2", "co2_per_capita", "gdp", "share_global_co2"])
    return out


@register("map_code", with_ctes("""
select distinct s.reporter_area_label, n.country_code
from long_sheet s left join (select n_name, replace(n_name, 'NATION_', 'N') as country_code from nation) n
  on s.reporter_area_label = n.n_name""", "long_sheet"))
def q_map_code(spark, d):
    """PF5: name -> code lookup; unmatched (raw spellings) -> NULL."""
    s = panels.long_indicator_sheet(spark, d).select("reporter_area_label").distinct()
    codes = panels.nation_codes(spark, d)
    return clean.map_code(s, "reporter_area_label", "country_code", codes)


@register("classify_keyword", with_ctes(f"""
select reporter_area_label, year, indicator_label, value, {_MODE_SQL} as transport_mode
from long_sheet where lower(indicator_label) like '%inbound%' and {_MODE_SQL} is not null""", "long_sheet"))
def q_classify_keyword(spark, d):
    """PF6: inbound rows, case-insensitive keyword priority air > land > water->sea > total."""
    s = panels.long_indicator_sheet(spark, d).where(F.lower("indicator_label").contains("inbound"))
    return s.withColumn("transport_mode", classify_keyword("indicator_label")).where(F.col("transport_mode").isNotNull())


def _messy_co2(spark, d):
    p = panels.panel_co2(spark, d)
    return p.select(F.concat(F.lit("  "), F.col("country"), F.lit(" ")).alias("country"),
                    F.concat(F.lit(" "), F.lower("country_code"), F.lit(" ")).alias("country_code"),
                    F.col("year").cast("string").alias("year"), F.col("co2").cast("string").alias("co2"),
                    F.col("gdp").cast("string").alias("gdp"), "population")


@register("apply_schema", with_ctes("""
select country, country_code, cast(year as bigint) as year, co2, gdp, population from panel_co2""", "panel_co2"))
def q_apply_schema(spark, d):
    """PF7: required check, numeric coercion, typed period, cleaned code/name."""
    return clean.apply_schema(_messy_co2(spark, d), CO2_SPEC)


@register("drop_empty_rows", with_ctes("""
select * from panel_co2 where not (gdp is null and population is null)""", "panel_co2"))
def q_drop_empty_rows(spark, d):
    """PF8: drop rows where all listed columns are NULL (missing listed columns ignored)."""
    return clean.drop_empty_rows(panels.panel_co2(spark, d), ["gdp", "population", "methane"])


@register("drop_any_null", with_ctes("""
select * from panel_co2 where gdp is not null and population is not null""", "panel_co2"))
def q_drop_any_null(spark, d):
    """PF9: drop rows with any NULL among the named columns."""
    return clean.drop_any_null(panels.panel_co2(spark, d), ["gdp", "population"])


@register("positive_filter", with_ctes("""
select country_code, year, co2, tourist_arrivals from fact where co2 > 0 and tourist_arrivals > 0""", "fact"))
def q_positive_filter(spark, d):
    """PF10: co2 > 0 and arrivals > 0."""
    return clean.positive_filter(fact(spark, d), ["co2", "tourist_arrivals"]) \
        .select("country_code", "year", "co2", "tourist_arrivals")


@register("reorder_columns", with_ctes("select * from panel_co2", "panel_co2"))
def q_reorder_columns(spark, d):
    """PF11: keys, original metrics, derived, others."""
    return clean.reorder_columns(panels.panel_co2(spark, d), ["country", "country_code", "year"],
                                 ["gdp", "population"], ["co2"])


@register("normalize_column_names", with_ctes("""
select country as country_name, country_code as country_code, year as year, co2 as co2_mt from panel_co2""",
                                              "panel_co2"))
def q_normalize_column_names(spark, d):
    """PF12: lower-case names, whitespace -> _."""
    p = panels.panel_co2(spark, d).select(F.col("country").alias("Country Name"),
                                          F.col("country_code").alias(" Country  Code"),
                                          F.col("year").alias("YEAR"), F.col("co2").alias("CO2 Mt"))
    return normalize_column_names(p)


_VALID = "co2 is not null and tourist_arrivals is not null and country_name is not null and co2 > 0 " \
         "and tourist_arrivals > 0"


@register("latest_period", with_ctes(f"""
select country_name, country_code, year, tourist_arrivals, co2 from merged
where {_VALID} and year = (select max(year) from merged where {_VALID})""", "merged"))
def q_latest_period(spark, d):
    """PF14 / API Q5: rows of the latest period that has valid data."""
    m = merged(spark, d)
    valid = (F.col("co2").isNotNull() & F.col("tourist_arrivals").isNotNull() & F.col("country_name").isNotNull()
             & (F.col("co2") > 0) & (F.col("tourist_arrivals") > 0))
    return clean.latest_period(m, "year", valid).select("country_name", "country_code", "year", "tourist_arrivals",
                                                        "co2")


@register("custom_slice", with_ctes(f"""
select country, country_code, year, tourist_arrivals as value from fact
where country_code in ({", ".join(f"'{m}'" for m in SLICE_MEMBERS)}) and year between {SLICE_YEARS[0]} and {SLICE_YEARS[1]}""",
                                    "fact"))
def q_custom_slice(spark, d):
    """PF15: members × metric × year range."""
    return clean.custom_slice(fact(spark, d), SLICE_MEMBERS, "arrivals", *SLICE_YEARS)


# ── 2.3 joins ───────────────────────────────────────────────────────────────
_IND = {
    "ind_arrivals": "select country, country_code, year, tourist_arrivals from panel_tourism where tourist_arrivals is not null",
    "ind_receipts": "select country, country_code, year, tourism_receipts_usd from panel_tourism where year <> 1998",
    "ind_departures": "select country, country_code, year, tourist_departures from panel_tourism "
                      "where cast(substr(country_code, 2) as int) % 5 <> 0",
}


@register("assemble_indicators", with_ctes("""
select coalesce(a.country, r.country, p.country) as country, coalesce(a.country_code, r.country_code, p.country_code)
         as country_code, coalesce(a.year, r.year, p.year) as year,
       a.tourist_arrivals, r.tourism_receipts_usd, p.tourist_departures
from ind_arrivals a
full outer join ind_receipts r on a.country = r.country and a.country_code = r.country_code and a.year = r.year
full outer join ind_departures p on coalesce(a.country, r.country) = p.country
  and coalesce(a.country_code, r.country_code) = p.country_code and coalesce(a.year, r.year) = p.year""",
                                           "panel_tourism", extra=_IND))
def q_assemble_indicators(spark, d):
    """Single-indicator tables -> one table (full outer, one shuffle)."""
    p = panels.panel_tourism(spark, d)
    a = p.where(F.col("tourist_arrivals").isNotNull()).select("country", "country_code", "year", "tourist_arrivals")
    r = p.where(F.col("year") != 1998).select("country", "country_code", "year", "tourism_receipts_usd")
    dp = p.where(F.substring("country_code", 2, 10).cast("int") % 5 != 0) \
        .select("country", "country_code", "year", "tourist_departures")
    return assemble.assemble_indicators([a, r, dp])


_TWICE = {
    "left2": "select country_code, year, co2 as v, 10.0::double as w from panel_co2 union all "
             "select country_code, year, co2 + 1.0 as v, 9.0::double as w from panel_co2 where year = 1998",
    "right2": "select country_code, year, tourist_departures as z from panel_tourism where year >= 1998 union all "
              "select country_code, year, tourist_departures + 1.0 as z from panel_tourism where year = 1999"}


@register("assemble_repeated_keys", with_ctes("""
select coalesce(l.country_code, r.country_code) as country_code, coalesce(l.year, r.year) as year, l.v, l.w, r.z
from left2 l full outer join right2 r on l.country_code = r.country_code and l.year = r.year""", "panel_co2", "panel_tourism", extra=_TWICE))
def q_assemble_repeated_keys(spark, d):
    """J1 on keys that come several times: every combination, as chained full outer joins have it."""
    co2, tour = panels.panel_co2(spark, d), panels.panel_tourism(spark, d)
    key = ["country_code", "year"]
    left = co2.select(*key, F.col("co2").alias("v"), F.lit(10.0).alias("w")).unionByName(
        co2.where(F.col("year") == 1998).select(*key, (F.col("co2") + 1.0).alias("v"), F.lit(9.0).alias("w")))
    right = tour.where(F.col("year") >= 1998).select(*key, F.col("tourist_departures").alias("z")).unionByName(
        tour.where(F.col("year") == 1999).select(*key, (F.col("tourist_departures") + 1.0).alias("z")))
    return assemble.outer_assemble([left, right], key, method="join")


@register("build_fact", with_ctes("select * from g_a", "g_a"))
def q_build_fact(spark, d):
    """Full outer of the three silver slices on (country_code, year)."""
    from tidepanel.plans import layers
    lines = checkpointed(panels.line_supplier_agg(spark, d))
    return assemble.build_fact(layers.build_silver_co2(spark, d), layers.build_silver_tourism(spark, d, lines),
                               layers.build_silver_transport(spark, d, lines))


@register("backfill_dim_attr", with_ctes("""
select country_code, year, coalesce(country, max(country) over (partition by country_code)) as country from g_a""",
                                         "g_a"))
def q_backfill_dim_attr(spark, d):
    """NULL names filled from the code -> name map."""
    from tidepanel.plans import layers
    lines = checkpointed(panels.line_supplier_agg(spark, d))
    f = assemble.build_fact(layers.build_silver_co2(spark, d), layers.build_silver_tourism(spark, d, lines),
                            layers.build_silver_transport(spark, d, lines))
    return assemble.backfill_dim_attr(f, "country", "country_code").select("country_code", "year", "country")


@register("fact_with_dim", with_ctes("select * from merged", "merged"))
def q_fact_with_dim(spark, d):
    """LEFT join fact -> dim (Spark picks the join by size)."""
    return merged(spark, d)


@register("period_compare", _PC_SQL)
def q_period_compare(spark, d):
    """Per label, arrivals in the pre and the post period (both must exist)."""
    m = merged(spark, d)
    pre, post = _pre_post(spark, d)
    return compare.period_compare(m.withColumnRenamed("tourist_arrivals", "arrivals"), "country_name", "arrivals",
                                  pre, post, suffixes=("_pre", "_post"))


@register("missing_members", with_ctes("""
select country_code from dim_country
where country_code not in (select country_code from silver_tourism where year = 1997)""",
                                       "dim_country", "silver_tourism"))
def q_missing_members(spark, d):
    """Expected entities absent from a slice (anti join)."""
    present = s_tourism(spark, d).where(F.col("year") == 1997)
    return compare.missing_members(panels.dim_country(spark, d), present, ["country_code"])


@register("missing_periods_by_entity", with_ctes("""
select country_code, n_rows,
       array_to_string(list_sort(list_filter(range(1995, 2002), lambda y: not list_contains(years, y))), ',')
         as missing_periods
from (select country_code, count(*) as n_rows, list(year) as years from silver_tourism group by country_code)
where n_rows < 7""", "silver_tourism"))
def q_missing_periods_by_entity(spark, d):
    """Per entity, the periods of the range it lacks (no grid cross join)."""
    r = compare.missing_periods_by_entity(s_tourism(spark, d), "country_code", 1995, 2001)
    return r.withColumn("missing_periods", F.array_join(F.col("missing_periods").cast("array<string>"), ","))


# ── 2.4 aggregations ────────────────────────────────────────────────────────
@register("pivot_modes", with_ctes("select * from bronze_transport_a", "bronze_transport_a"))
def q_pivot_modes(spark, d):
    """A1: long -> wide sum per mode (absent combination -> NULL)."""
    return assemble.pivot_modes(panels.panel_transport_long(spark, d), ["country", "country_code", "year"],
                                "transport_mode", "value", ["air", "sea", "land", "total"], prefix="tourists_")


@register("total_if_missing", with_ctes("select * from bronze_transport", "bronze_transport"))
def q_total_if_missing(spark, d):
    """A2: NULL total -> sum of present modes (NULL if none)."""
    w = assemble.pivot_modes(panels.panel_transport_long(spark, d), ["country", "country_code", "year"],
                             "transport_mode", "value", ["air", "sea", "land", "total"], prefix="tourists_")
    return assemble.total_if_missing(w, "tourists_total", ["tourists_air", "tourists_sea", "tourists_land"])


@register("kpi_overview_sql", with_ctes(f"""
select count(distinct country) as n_countries, count(distinct year) as n_years,
       cast(sum(tourist_arrivals) as double) as total_arrivals, {xsum('co2')} as total_co2
from fact where year >= {MIN_YEAR}""", "fact"))
def q_kpi_overview_sql(spark, d):
    """Distinct countries/years and totals."""
    f = fact(spark, d).where(F.col("year") >= MIN_YEAR)
    return f.agg(F.countDistinct("country").alias("n_countries"), F.countDistinct("year").alias("n_years"),
                 F.sum("tourist_arrivals").alias("total_arrivals"), exact_sum("co2").alias("total_co2"))


@register("kpi_overview_api", with_ctes(f"""
select n_countries, n_years,
       {rnd('case when total_co2 > 1000 then total_co2 / 1000 else total_co2 end', 1)} as total_co2_scaled,
       {rnd('case when total_arrivals > 100000 then total_arrivals / 1000 else total_arrivals end', 1)}
         as total_arrivals_scaled
from (select count(distinct country_code) as n_countries, count(distinct year) as n_years,
             coalesce({xsum('co2')}, 0) as total_co2, coalesce({xsum('tourist_arrivals')}, 0) as total_arrivals
      from fact)""",
                                        "fact"))
def q_kpi_overview_api(spark, d):
    """Counts and magnitude-scaled totals (co2 /1000 above 1000; arrivals /1000 above 100 000), r1."""
    f = fact(spark, d)
    a = f.agg(F.countDistinct("country_code").alias("n_countries"), F.countDistinct("year").alias("n_years"),
              F.coalesce(exact_sum("co2"), F.lit(0.0)).alias("co2"),
              F.coalesce(exact_sum("tourist_arrivals"), F.lit(0.0)).alias("arr"))
    return a.select("n_countries", "n_years",
                    np_round(F.when(F.col("co2") > 1000, F.col("co2") / 1000).otherwise(F.col("co2")), 1)
                    .alias("total_co2_scaled"),
                    np_round(F.when(F.col("arr") > 100000, F.col("arr") / 1000).otherwise(F.col("arr")), 1)
                    .alias("total_arrivals_scaled"))


@register("label_country_counts", with_ctes("""
select sustainability_label, count(distinct country) as n_countries from fact
where sustainability_label is not null group by sustainability_label order by n_countries desc""", "fact"))
def q_label_country_counts(spark, d):
    """Distinct countries per label."""
    return (fact(spark, d).where(F.col("sustainability_label").isNotNull()).groupBy("sustainability_label")
            .agg(F.countDistinct("country").alias("n_countries")).orderBy(F.col("n_countries").desc()))


@register("label_row_counts", with_ctes(f"""
select sustainability_label, count(country) as n_rows from fact
where year between {SLICE_YEARS[0]} and {SLICE_YEARS[1]} group by sustainability_label""", "fact"))
def q_label_row_counts(spark, d):
    """Non-NULL country rows per label within a year slice."""
    f = clean.filter_period(fact(spark, d), *SLICE_YEARS)
    return f.groupBy("sustainability_label").agg(F.count("country").alias("n_rows"))


@register("avg_per_country_label", with_ctes(f"""
select country, sustainability_label, {xavg('co2_per_tourist')} as avg_co2_per_tourist from fact
where country is not null and sustainability_label is not null
group by country, sustainability_label order by avg_co2_per_tourist""", "fact"))
def q_avg_per_country_label(spark, d):
    """A10: mean co2 per tourist by (country, label)."""
    f = fact(spark, d).where(F.col("country").isNotNull() & F.col("sustainability_label").isNotNull())
    return (f.groupBy("country", "sustainability_label")
            .agg(exact_avg("co2_per_tourist").alias("avg_co2_per_tourist"))
            .orderBy(F.col("avg_co2_per_tourist").asc_nulls_last()))


@register("api_q2_arrivals_evolution", with_ctes("""
select year, cast(sum(tourist_arrivals) as double) as tourist_arrivals from fact
where tourist_arrivals is not null group by year order by year""", "fact"))
def q_api_q2(spark, d):
    """A11 / API Q2: yearly arrivals."""
    f = clean.drop_any_null(fact(spark, d), ["tourist_arrivals"])
    return f.groupBy("year").agg(F.sum("tourist_arrivals").alias("tourist_arrivals")).orderBy("year")


_YEARLY = {"yearly": f"""select year, cast(sum(tourist_arrivals) as double) as total_arrivals, {xsum('co2')} as total_co2
              from fact where year >= {MIN_YEAR} group by year"""}


def _yearly(spark, d):
    f = fact(spark, d).where(F.col("year") >= MIN_YEAR)
    return stats.period_totals(f, {"total_arrivals": "tourist_arrivals", "total_co2": "co2"})


@register("corr_yearly", with_ctes(f"""
select count(case when total_arrivals is not null and total_co2 is not null then 1 end) as n_pairs,
       {rnd('corr(total_arrivals, total_co2)', 9)} as corr from yearly""", "fact", extra=_YEARLY))
def q_corr_yearly(spark, d):
    """Pearson correlation of yearly totals."""
    return stats.corr_ols(_yearly(spark, d), "total_arrivals", "total_co2").select("n_pairs", "corr")


@register("ols_trend", with_ctes(f"""
select {rnd('regr_slope(total_co2, total_arrivals)', 9)} as slope,
       {rnd('regr_intercept(total_co2, total_arrivals)', 9)} as intercept,
       {rnd('regr_r2(total_co2, total_arrivals)', 9)} as r2 from yearly""", "fact", extra=_YEARLY))
def q_ols_trend(spark, d):
    """OLS line of co2 on arrivals over yearly totals."""
    return stats.corr_ols(_yearly(spark, d), "total_arrivals", "total_co2").select("slope", "intercept", "r2")


@register("endpoint_growth", with_ctes(f"""
select arg_min(total_arrivals, year) as total_arrivals_first, arg_max(total_arrivals, year) as total_arrivals_last,
       (arg_max(total_arrivals, year) / nullif(arg_min(total_arrivals, year), 0) - 1.0) * 100.0 as growth_pct
from yearly""", "fact", extra=_YEARLY))
def q_endpoint_growth(spark, d):
    """Last / first - 1 over the ordered yearly totals."""
    return stats.endpoint_growth(_yearly(spark, d), "total_arrivals")


_Q3 = {"q3": f"""select country, country_code, {xavg('gdp_growth_pct')} as avg_gdp_growth,
                    {xavg('co2_intensity_gdp')} as avg_co2_intensity
             from fact where gdp_growth_pct is not null and co2_intensity_gdp is not null and year >= {MIN_YEAR}
             group by country, country_code"""}


@register("argmax_argmin", with_ctes("""
select * from (select 'max_avg_gdp_growth' as metric, country, avg_gdp_growth as value from q3
               order by avg_gdp_growth desc, avg_co2_intensity asc, country limit 1)
union all
select * from (select 'min_avg_co2_intensity', country, avg_co2_intensity from q3
               order by avg_co2_intensity asc, avg_gdp_growth desc, country limit 1)""", "fact", extra=_Q3))
def q_argmax_argmin(spark, d):
    """Country with the highest mean growth and with the lowest mean intensity."""
    f = fact(spark, d)
    q3 = (f.where(F.col("gdp_growth_pct").isNotNull() & F.col("co2_intensity_gdp").isNotNull()
                  & (F.col("year") >= MIN_YEAR))
          .groupBy("country", "country_code")
          .agg(exact_avg("gdp_growth_pct").alias("avg_gdp_growth"),
               exact_avg("co2_intensity_gdp").alias("avg_co2_intensity")))
    hi = stats.arg_extreme(q3, "country", "avg_gdp_growth", True, ["avg_co2_intensity"]) \
        .select(F.lit("max_avg_gdp_growth").alias("metric"), "country", F.col("avg_gdp_growth").alias("value"))
    lo = stats.arg_extreme(q3, "country", "avg_co2_intensity", False, [F.col("avg_gdp_growth").desc_nulls_last()]) \
        .select(F.lit("min_avg_co2_intensity").alias("metric"), "country", F.col("avg_co2_intensity").alias("value"))
    return hi.unionByName(lo)


@register("row_count_by_entity", with_ctes("""
select country_code, count(*) as n_rows from silver_tourism group by country_code""", "silver_tourism"))
def q_row_count_by_entity(spark, d):
    """Rows per entity."""
    return row_count_by_entity(s_tourism(spark, d))


_LATEST = "year = (select max(year) from merged)"


@register("api_q6_share", with_ctes(f"""
select country_name, co2, co2 / (select {xsum('co2')} from u) * 100.0 as share_pct from u""",
                                    "merged", extra={
    "agg": f"""select country_name, {xsum('co2')} as co2 from merged
               where {_LATEST} and co2 is not null and country_name is not null group by country_name""",
    "top": "select * from agg order by co2 desc, country_name limit 10",
    "rest": f"""select 'Otros' as country_name, {xsum('co2')} as co2, count(*) as n from agg
                where country_name not in (select country_name from top)""",
    "u": "select country_name, co2 from top union all select country_name, co2 from rest where n > 0"}))
def q_api_q6(spark, d):
    """A18 + W7 / API Q6: top-10 emitters of the latest year + 'Otros', with % share."""
    latest = merged(spark, d).where(F.col("year") == _periods(spark, d)["last"])
    t = rank.top_k_with_others(latest, "country_name", "co2", 10, exact_sum=True)
    return rank.share_of_total(t, "co2", "share_pct", exact=True)


# ── 2.5 windows ─────────────────────────────────────────────────────────────
def _dups(spark, d):
    p = panels.panel_co2(spark, d)
    return p.withColumn("ord", F.lit(0)).unionByName(
        p.withColumn("co2", F.col("co2") * 2).withColumn("ord", F.lit(1)))


@register("dedup_first", with_ctes("""
select * from dups qualify row_number() over (partition by country_code, year order by ord) = 1""", "panel_co2",
                                   extra={"dups": """select *, 0 as ord from panel_co2 union all
          select country, country_code, year, co2 * 2, gdp, population, 1 from panel_co2"""}))
def q_dedup_first(spark, d):
    """One row per key, the first by an explicit order column."""
    return clean.dedup_first(_dups(spark, d), ["country_code", "year"], order_by="ord")


@register("silver_co2_first_row", with_ctes("""
select country_code, year, co2, gdp, population from silver_co2""", "silver_co2"))
def q_silver_co2_first_row(spark, d):
    """W1 in C1: each key comes three times, the later rows empty or doubled; the first landed row counts."""
    p = panels.panel_co2(spark, d)
    empty = p.withColumns({c: F.lit(None).cast("double") for c in ("co2", "gdp", "population")})
    landed = (p.withColumn("landed", F.lit(1)).unionByName(empty.withColumn("landed", F.lit(2)))
              .unionByName(p.withColumn("co2", F.col("co2") * 2).withColumn("landed", F.lit(3))))
    return silver.silver_co2(landed, "landed").select("country_code", "year", "co2", "gdp", "population")


@register("flag_duplicates", with_ctes("""
select *, count(*) over (partition by country_code, year) > 1 as is_duplicate from dups""", "panel_co2",
                                       extra={"dups": """select country_code, year, co2 from panel_co2 union all
          select country_code, year, co2 * 2 from panel_co2 where year = 1997"""}))
def q_flag_duplicates(spark, d):
    """Mark every member of a duplicated key."""
    p = panels.panel_co2(spark, d).select("country_code", "year", "co2")
    dup = p.unionByName(p.where(F.col("year") == 1997).withColumn("co2", F.col("co2") * 2))
    return clean.flag_duplicates(dup, ["country_code", "year"])


@register("forward_fill", with_ctes(f"""
select country, country_code, year, co2, last_value(gdp ignore nulls) over ({_WB}) as gdp,
       last_value(population ignore nulls) over ({_WB}) as population from panel_co2""", "panel_co2"))
def q_forward_fill(spark, d):
    """Last non-NULL per entity by period."""
    return fill.forward_fill(panels.panel_co2(spark, d), ["gdp", "population"])


def _interp_sql(src: str, cols: list[str], keep: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""last_value({c} ignore nulls) over ({_WB}) as __p_{c},
       last_value(case when {c} is not null then __rn end ignore nulls) over ({_WB}) as __pr_{c},
       first_value({c} ignore nulls) over ({_WF}) as __n_{c},
       first_value(case when {c} is not null then __rn end ignore nulls) over ({_WF}) as __nr_{c}""")
    outs = [f"""cast(coalesce({c}, case when __p_{c} is null then null when __n_{c} is null then __p_{c}
            else (__n_{c} - __p_{c}) / (__nr_{c} - __pr_{c}) * (__rn - __pr_{c}) + __p_{c} end) as double) as {c}"""
            for c in cols]
    return f"""select {", ".join(keep)}, {", ".join(outs)} from (
  select *, {", ".join(parts)} from (select *, row_number() over ({_WO}) as __rn from {src}))"""


@register("interpolate_linear", with_ctes(_interp_sql("panel_co2", ["gdp", "population"],
                                                      ["country", "country_code", "year", "co2"]), "panel_co2"))
def q_interpolate_linear(spark, d):
    """Positional linear interpolation; leading NULLs kept, trailing take the last value."""
    return fill.interpolate_linear(panels.panel_co2(spark, d), ["gdp", "population"])


_MINUTE = "date_diff('day', date '1970-01-01', cast(ts as date)) * 1440 + hour(ts) * 60 + minute(ts)"
_TB = "order by minute rows between unbounded preceding and current row"
_TF = "order by minute rows between current row and unbounded following"


_TIMELINE = f"""
with panel as (
  select cast({_MINUTE} as bigint) as minute, case when ({_MINUTE}) % 5 <> 0 then cast(sum(cast(value as decimal(18,2))) as double) end as value
  from events group by 1, ({_MINUTE})), """
_ALL = PanelKey(("entity",), "minute")


def timeline(spark, d):
    """One long entity: all events by minute, every fifth minute unknown."""
    ts = F.col("ts")
    minute = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return (panels.table(spark, d, "events").groupBy(minute.alias("minute")).agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value"))
            .select(F.lit("all").alias("entity"), "minute", F.when(F.col("minute") % 5 != 0, F.col("value")).alias("value")))


@register("interpolate_timeline", f"""{_TIMELINE}
near as (
  select *, last_value(value ignore nulls) over ({_TB}) as p, last_value(case when value is not null then minute end ignore nulls) over ({_TB}) as pm,
         first_value(value ignore nulls) over ({_TF}) as n, first_value(case when value is not null then minute end ignore nulls) over ({_TF}) as nm from panel)
select minute, cast(coalesce(value, case when p is null then null when n is null then p else (n - p) / (nm - pm) * (minute - pm) + p end) as double) as value from near""")
def q_interpolate_timeline(spark, d):
    """W4 on one long entity: by period, filled day by day."""
    return fill.interpolate_long(timeline(spark, d), ["value"], 1440, _ALL).drop("entity")


@register("interpolate_timeline_position", f"""{_TIMELINE}
numbered as (select *, row_number() over (order by minute) as r from panel),
near as (
  select *, last_value(value ignore nulls) over ({_TB}) as p, last_value(case when value is not null then r end ignore nulls) over ({_TB}) as pm,
         first_value(value ignore nulls) over ({_TF}) as n, first_value(case when value is not null then r end ignore nulls) over ({_TF}) as nm from numbered)
select minute, cast(coalesce(value, case when p is null then null when n is null then p else (n - p) / (nm - pm) * (r - pm) + p end) as double) as value from near""")
def q_interpolate_timeline_position(spark, d):
    """W4 on one long entity: rows equally spaced, filled day by day with places carried between the days."""
    return fill.interpolate_long(timeline(spark, d), ["value"], 1440, _ALL, mode="position").drop("entity")


@register("forward_fill_timeline", f"""{_TIMELINE}
filled as (select minute, last_value(value ignore nulls) over ({_TB}) as value from panel)
select minute, value from filled""")
def q_forward_fill_timeline(spark, d):
    """W3 on one long entity: filled day by day."""
    return fill.forward_fill_long(timeline(spark, d), ["value"], 1440, _ALL).drop("entity")


@register("pct_change_timeline", f"""{_TIMELINE}
padded as (select *, last_value(value ignore nulls) over ({_TB}) as pad from panel)
select minute, {rnd("(pad / nullif(lag(pad) over (order by minute), 0) - 1.0) * 100.0", 2)} as growth,
       {rnd("(pad / nullif(lag(pad, 7) over (order by minute), 0) - 1.0) * 100.0", 2)} as growth_7,
       {rnd("(value / nullif(lag(value, 3) over (order by minute), 0) - 1.0) * 100.0", 2)} as growth_raw_3 from padded""")
def q_pct_change_timeline(spark, d):
    """W5 on one long entity: against the row before, the seventh before, and the third before without padding."""
    line = checkpointed(timeline(spark, d))
    line = growth.pct_change_long(line, "value", "growth", 1440, _ALL)
    line = growth.pct_change_long(line, "value", "growth_7", 1440, _ALL, periods=7)
    return growth.pct_change_long(line, "value", "growth_raw_3", 1440, _ALL, fill="none", periods=3).drop("entity", "value")


@register("pct_change", with_ctes(f"""
select country_code, year, gdp,
       {rnd(f"(pad / nullif(lag(pad) over ({_WO}), 0) - 1.0) * 100.0", 2)} as gdp_growth_pad,
       {rnd(f"(gdp / nullif(lag(gdp) over ({_WO}), 0) - 1.0) * 100.0", 2)} as gdp_growth_raw
from (select *, last_value(gdp ignore nulls) over ({_WB}) as pad from panel_co2)""", "panel_co2"))
def q_pct_change(spark, d):
    """Growth % vs the previous row, with (pad) and without NULL padding."""
    p = panels.panel_co2(spark, d).select("country_code", "year", "gdp")
    p = growth.pct_change(p, "gdp", "gdp_growth_pad")
    return growth.pct_change(p, "gdp", "gdp_growth_raw", fill="none")


@register("api_q1_top10_co2", with_ctes(f"""
select country_name, country_code, year, co2 from merged where {_LATEST} and co2 is not null
order by co2 desc, country_code limit 10""", "merged"))
def q_api_q1(spark, d):
    """W6 / API Q1: top 10 emitters of the latest year (ties keep key order)."""
    return top10_co2(spark, d)


def top10_co2(spark, d, year=None):
    """The ten largest emitters of ``year`` (default: the latest)."""
    m = merged(spark, d).where((F.col("year") == (_periods(spark, d)["last"] if year is None else year)) & F.col("co2").isNotNull())
    return rank.top_k(m.select("country_name", "country_code", "year", "co2"), "co2", 10, ["country_code"])


@register("api_q1_chosen_year", with_ctes(f"""
select country_name, country_code, year, co2 from merged where year = {YOY_YEAR} and co2 is not null
order by co2 desc, country_code limit 10""", "merged"))
def q_api_q1_chosen_year(spark, d):
    """API Q1 with a year: top 10 emitters of that year."""
    return top10_co2(spark, d, YOY_YEAR)


@register("api_q1_available_years", with_ctes("select distinct year from merged where year is not null order by year", "merged"))
def q_api_q1_available_years(spark, d):
    """API Q1: the years that can be chosen."""
    return fact(spark, d).where(F.col("year").isNotNull()).select("year").distinct().orderBy("year")


@register("top_k_per_period", with_ctes("""
select country_code, year, co2 from panel_co2
qualify row_number() over (partition by year order by co2 desc, country_code) <= 3""", "panel_co2"))
def q_top_k_per_period(spark, d):
    """W6 per group: top 3 entities per period (partial WindowGroupLimit before the shuffle)."""
    p = panels.panel_co2(spark, d).select("country_code", "year", "co2")
    return rank.top_k(p, "co2", 3, ["country_code"], partition=["year"])


@register("share_of_total", with_ctes(f"""
select country_code, co2,
       co2 / (select {xsum('co2')} from fact where year = (select max(year) from fact)) * 100.0 as share_pct
from fact where year = (select max(year) from fact)""", "fact"))
def q_share_of_total(spark, d):
    """Share of the latest year's total per country."""
    f = clean.latest_period(fact(spark, d), "year").select("country_code", "co2")
    return rank.share_of_total(f, "co2", "share_pct", exact=True)


# ── 2.6 sorts ───────────────────────────────────────────────────────────────
@register("sort_key", with_ctes("select country_code, year, co2 from fact order by country_code, year", "fact"))
def q_sort_key(spark, d):
    """SL1: output sorted by (entity, period)."""
    return fact(spark, d).select("country_code", "year", "co2").orderBy("country_code", "year")


@register("api_q3_per_capita", with_ctes(f"""
select country_name, country_code, co2_per_capita_calc from merged
where {_LATEST} and co2_per_capita_calc is not null order by co2_per_capita_calc desc""", "merged"))
def q_api_q3(spark, d):
    """SL3 / API Q3: per-capita emissions of the latest year, descending."""
    m = merged(spark, d).where(F.col("year") == _periods(spark, d)["last"])
    return (clean.drop_any_null(m, ["co2_per_capita_calc"])
            .select("country_name", "country_code", "co2_per_capita_calc")
            .orderBy(F.col("co2_per_capita_calc").desc_nulls_last()))


@register("api_q4_yoy", with_ctes(f"""
select country_name, country_code, arrivals_growth_pct,
       case when arrivals_growth_pct >= 0 then 'up' else 'down' end as direction
from merged where year = {YOY_YEAR} and arrivals_growth_pct is not null order by arrivals_growth_pct desc""",
                                  "merged"))
def q_api_q4(spark, d):
    """SL4 / API Q4: growth ranking of a fixed year with a sign flag."""
    return yoy_growth(merged(spark, d))


def yoy_growth(m, year=YOY_YEAR):
    """Growth of arrivals in ``year`` per country; from the arrivals themselves if the table has no growth column."""
    if "arrivals_growth_pct" not in m.columns:
        m = (m.groupBy("country_name", "country_code", "year").agg(F.sum("tourist_arrivals").alias("tourist_arrivals")))
        m = growth.pct_change(m, "tourist_arrivals", "arrivals_growth_pct", digits=None)
    return (clean.drop_any_null(m.where(F.col("year") == year), ["arrivals_growth_pct"])
            .select("country_name", "country_code", "arrivals_growth_pct",
                    sign_flag("arrivals_growth_pct").alias("direction"))
            .orderBy(F.col("arrivals_growth_pct").desc_nulls_last()))


@register("api_q4_runtime", with_ctes(f"""
select country_name, country_code, g as arrivals_growth_pct, case when g >= 0 then 'up' else 'down' end as direction from (
  select *, (pad / nullif(lag(pad) over (partition by country_code order by year), 0) - 1.0) * 100.0 as g from (
    select *, last_value(tourist_arrivals ignore nulls) over ({_WB}) as pad from merged))
where year = {YOY_YEAR} and g is not null order by g desc""", "merged"))
def q_api_q4_runtime(spark, d):
    """API Q4 without the stored growth column: growth from the arrivals."""
    return yoy_growth(merged(spark, d).drop("arrivals_growth_pct"))


@register("api_q5_arrivals_vs_co2", with_ctes(f"""
select country_name, country_code, year, tourist_arrivals, co2 from merged
where {_VALID} and ((year = (select max(year) from merged) and country_name is not null)
  or (year = (select max(year) from merged where {_VALID})
      and not exists (select 1 from merged where {_VALID} and country_name is not null and year = (select max(year) from merged))))""", "merged"))
def q_api_q5(spark, d):
    """API Q5: named countries of the latest year with both values; if it has none, the latest year that has any."""
    return arrivals_vs_co2(merged(spark, d))


def arrivals_vs_co2(m):
    valid = m.where((F.col("co2") > 0) & (F.col("tourist_arrivals") > 0))
    last = m.select(F.max("year")).scalar()
    named = valid.where((F.col("year") == last) & F.col("country_name").isNotNull())
    any_named = F.coalesce(named.select(F.count(F.lit(1))).scalar(), F.lit(0)) > 0
    chosen = F.when(any_named, (F.col("year") == last) & F.col("country_name").isNotNull()).otherwise(F.col("year") == valid.select(F.max("year")).scalar())
    return valid.where(chosen).select("country_name", "country_code", "year", "tourist_arrivals", "co2")


@register("api_q7_pre_post", _Q7_SQL)
def q_api_q7(spark, d):
    """API Q7: pre vs post arrivals per country, top 15 by post."""
    return rank.top_k(q_period_compare(spark, d), "arrivals_post", 15, ["country_name"])


@register("api_q8_reduction", with_ctes("""
select country_name, co2_first, co2_last, (co2_first - co2_last) / co2_first * 100.0 as reduction_pct
from c where co2_first > 0 order by reduction_pct desc""", "merged", extra={
    "fl": "select min(year) as y0, max(year) as y1 from merged",
    "c": f"""select country_name,
             coalesce({xsum('case when year = (select y0 from fl) then co2 end')}, 0) as co2_first,
             coalesce({xsum('case when year = (select y1 from fl) then co2 end')}, 0) as co2_last
      from merged where country_name is not null and (year = (select y0 from fl) or year = (select y1 from fl))
      group by country_name
      having count(case when year = (select y0 from fl) then 1 end) > 0
         and count(case when year = (select y1 from fl) then 1 end) > 0"""}))
def q_api_q8(spark, d):
    """F7 / API Q8: emission reduction between the first and the last year."""
    return emission_reduction(merged(spark, d), fact(spark, d))


def emission_reduction(m, f):
    """Reduction per country from the first to the last year of ``f``; fails when it has fewer than two."""
    y0, y1 = f.select(F.min("year")).scalar(), f.select(F.max("year")).scalar()
    enough = F.when(F.coalesce(y0 < y1, F.lit(False)), y0).otherwise(F.raise_error(F.lit("at least two years of data are needed")).cast("bigint"))
    m = m.withColumn("co2", F.col("co2").cast("decimal(38,10)"))
    cmp = compare.period_compare(m, "country_name", "co2", enough, y1, suffixes=("_first", "_last"), zero_if_all_null=True)
    cmp = cmp.withColumns({"co2_first": F.col("co2_first").cast("double"), "co2_last": F.col("co2_last").cast("double")})
    from tidepanel.functions.numeric import reduction_pct
    return (cmp.where(F.col("co2_first") > 0).withColumn("reduction_pct", reduction_pct("co2_first", "co2_last"))
            .orderBy(F.col("reduction_pct").desc_nulls_last()))


# ── 2.7 set operations ──────────────────────────────────────────────────────
@register("union_all", with_ctes("""
select country_code, year, co2, null::double as tourist_arrivals from silver_co2
union all select country_code, year, null::double, tourist_arrivals from silver_tourism""",
                                 "silver_co2", "silver_tourism"))
def q_union_all(spark, d):
    """SO1: concatenate by column name, missing columns -> NULL."""
    a = s_co2(spark, d).select("country_code", "year", "co2")
    b = s_tourism(spark, d).select("country_code", "year", "tourist_arrivals")
    return a.unionByName(b, allowMissingColumns=True)


@register("except", with_ctes("""
select country_code from dim_country except select country_code from silver_tourism where year = 1997""",
                              "dim_country", "silver_tourism"))
def q_except(spark, d):
    """SO2: expected minus present (set difference)."""
    a = panels.dim_country(spark, d).select("country_code")
    b = s_tourism(spark, d).where(F.col("year") == 1997).select("country_code")
    return a.subtract(b)


@register("distinct", with_ctes("select distinct country_code, country from fact", "fact"))
def q_distinct(spark, d):
    """SO3: distinct (code, name) pairs."""
    return fact(spark, d).select("country_code", "country").distinct()


# ── 2.8 scalar functions ────────────────────────────────────────────────────
@register("safe_ratio", with_ctes(f"""
select country_code, year,
       case when population > 0 then {rnd('co2 * 1000000.0::DOUBLE / population', 4)} end as co2_per_capita_calc,
       case when gdp > 0 then {rnd('co2 * 1000000000.0::DOUBLE / gdp', 6)} end as co2_intensity_gdp,
       case when population > 0 and gdp > 0 then {rnd('gdp / population', 2)} end as gdp_per_capita
from panel_co2""", "panel_co2"))
def q_safe_ratio(spark, d):
    """guarded, rounded ratios on the raw panel (NULL/zero denominators -> NULL)."""
    p = panels.panel_co2(spark, d)
    return p.select("country_code", "year",
                    safe_ratio("co2", "population", 1e6, 4).alias("co2_per_capita_calc"),
                    safe_ratio("co2", "gdp", 1e9, 6).alias("co2_intensity_gdp"),
                    safe_ratio("gdp", "population", 1.0, 2, extra_mask=F.col("gdp") > 0).alias("gdp_per_capita"))


@register("np_round", f"""
select l_orderkey, l_linenumber, {rnd('l_extendedprice * l_discount', 2)} as disc_amount,
       {rnd('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 2)} as charge from lineitem""")
def q_np_round(spark, d):
    """half-even rounding of the scaled double over every line item."""
    li = panels.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     np_round(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("disc_amount"),
                     np_round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")), 2)
                     .alias("charge"))


@register("to_numeric_coerce", """
select event_id, try_cast(event_type as double) as event_type_num,
       try_cast(regexp_extract(props, '[0-9]+', 0) as bigint) as k from events""")
def q_to_numeric(spark, d):
    """coercion where unparsable values become NULL."""
    ev = panels.table(spark, d, "events")
    return ev.select("event_id", to_numeric("event_type").alias("event_type_num"),
                     to_numeric(F.regexp_extract("props", "[0-9]+", 0), "bigint").alias("k"))


@register("dominant_category", with_ctes("""
select country_code, year, pct_air, pct_sea, pct_land,
       case when pct_air is not null and pct_air = greatest(pct_air, pct_sea, pct_land) then 'air'
            when pct_sea is not null and pct_sea = greatest(pct_air, pct_sea, pct_land) then 'sea'
            when pct_land is not null and pct_land = greatest(pct_air, pct_sea, pct_land) then 'land' end
         as dominant_transport
from bronze_transport_wide""", "bronze_transport_wide"))
def q_dominant_category(spark, d):
    """label of the largest share, NULLs skipped, ties to the first."""
    w = silver.bronze_transport_wide(panels.panel_transport_long(spark, d))
    return w.select("country_code", "year", "pct_air", "pct_sea", "pct_land",
                    dominant_category({"air": "pct_air", "sea": "pct_sea", "land": "pct_land"})
                    .alias("dominant_transport"))


@register("quadrant_label", with_ctes("""
select country_code, year, gdp_growth_pct, co2_growth_pct, sustainability_label from fact""", "fact"))
def q_quadrant_label(spark, d):
    """two-signal quadrant label."""
    f = fact(spark, d)
    return f.select("country_code", "year", "gdp_growth_pct", "co2_growth_pct",
                    quadrant_label("gdp_growth_pct", "co2_growth_pct").alias("sustainability_label"))


# ── C6 bronze ───────────────────────────────────────────────────────────────
@register("bronze_transport", with_ctes("select * from bronze_transport_wide", "bronze_transport_wide"))
def q_bronze_transport(spark, d):
    """Landed long sheet -> wide transport panel (inbound, keywords, aliases, members, pivot, codes)."""
    members = panels.nation_codes(spark, d).select("country")
    return bronze.transport_from_sheet(panels.long_indicator_sheet(spark, d), _ALIASES, members,
                                       panels.nation_codes(spark, d)).drop("is_duplicate")


@register("null_ordering", with_ctes("""
select country_code, year, gdp, row_number() over (order by gdp asc nulls last, country_code, year) as rising, row_number() over (order by gdp desc nulls last, country_code, year) as falling
from panel_co2""", "panel_co2"))
def q_null_ordering(spark, d):
    """SL2: places in sorted outputs, NULL last in both directions. The order is that of the sorted frames themselves."""
    rows = checkpointed(panels.panel_co2(spark, d).select("country_code", "year", "gdp"))

    def placed(order, name):
        # the rows of a global sort lie in its partitions one after the other
        done = rows.orderBy(order, "country_code", "year").select("country_code", "year", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
        done = checkpointed(done)
        sizes = {r["part"]: r["count"] for r in done.groupBy("part").count().collect()}  # a row per partition
        before, total = {}, 0
        for part in sorted(sizes):
            before[part], total = total, total + sizes[part]
        base = F.create_map(*[F.lit(x) for part, n in before.items() for x in (part, n)]) if before else F.create_map(F.lit(0), F.lit(0))
        return done.select("country_code", "year", (F.element_at(base, F.col("part")) + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("bigint").alias(name))

    return rows.join(placed(F.col("gdp").asc_nulls_last(), "rising"), ["country_code", "year"]).join(placed(F.col("gdp").desc_nulls_last(), "falling"), ["country_code", "year"])
