"""Registered data-quality, coverage and outlier queries (DQ1–DQ13, A16, DQ10 suites)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepanel.operators import profile, quality
from tidepanel.operators.outliers import iqr_outliers
from tidepanel.plans import layers, panels
from tidepanel.plans.oracle import rnd, with_ctes
from tidepanel.plans.queries import fact, s_co2, s_tourism, s_transport
from tidepanel.plans.registry import register
from tidepanel.session import scratch_dir
from tidepanel.spec import CO2_SPEC, TOURISM_SPEC, TRANSPORT_SPEC

# Expected members: the 25 nation codes (rule-built); expected periods 1995–2001.
EXPECTED = tuple(f"N{k}" for k in range(25))
START, END = 1995, 2001
_EXP_SQL = ", ".join(f"'{m}'" for m in EXPECTED)


def bronze_table(spark, d, name):
    """A stored bronze table without the column that numbers its rows."""
    return layers.table(spark, d, name).drop(layers.ROW)


def _npct_sql(col: str) -> str:
    return rnd(f"avg(case when {col} is null then 1.0 else 0.0 end) * 100.0", 2)


# ── DQ2 ─────────────────────────────────────────────────────────────────────
_SILVER_CO2_COLS = ["country", "country_code", "year", "co2", "gdp", "population", "co2_per_capita_calc",
                    "co2_intensity_gdp", "gdp_per_capita", "gdp_growth_pct"]


@register("null_profile", with_ctes("\nunion all\n".join(
    f"select {i} as ordinal, '{c}' as \"column\", {_npct_sql(c)} as null_pct from silver_co2"
    for i, c in enumerate(_SILVER_CO2_COLS)), "silver_co2"))
def q_null_profile(spark, d):
    """DQ2: % NULL of every column in one pass."""
    return quality.null_profile(s_co2(spark, d))


# ── DQ13 ────────────────────────────────────────────────────────────────────
_FACT_COLS = ["country", "country_code", "year", "co2", "co2_per_capita_calc", "co2_intensity_gdp", "gdp",
              "gdp_per_capita", "gdp_growth_pct", "population", "tourist_arrivals", "tourism_receipts_usd",
              "tourist_departures", "arrivals_growth_pct", "receipts_per_tourist", "tourists_air", "tourists_sea",
              "tourists_land", "tourists_total", "pct_air", "pct_sea", "pct_land", "dominant_transport",
              "co2_per_tourist", "co2_growth_pct", "sustainability_label"]


@register("frame_summary", with_ctes(f"""
select count(*) as n_rows, {len(_FACT_COLS)} as n_cols,
       sum({" + ".join(f"(case when {c} is null then 1 else 0 end)" for c in _FACT_COLS)})::BIGINT as total_nulls,
       count(distinct country_code) as n_entities, count(distinct year) as n_periods from fact""", "fact"))
def q_frame_summary(spark, d):
    """DQ13: shape, NULL cells, distinct entities and periods."""
    return quality.frame_summary(fact(spark, d))


# ── DQ1 ─────────────────────────────────────────────────────────────────────
def _report_sql(name: str, src: str, before: str, cols: list[str], thresholds: dict) -> str:
    flags = []
    for c in cols:
        if c in thresholds:
            thr = float(thresholds[c])
            flags.append(f"case when {_npct_sql(c)} > {thr} then 'WARN: ''{c}'' has ' || "
                         f"cast({_npct_sql(c)} as varchar) || '% nulls (threshold: {thr}%)' end")
    mm = (f"array_to_string(list_sort(list_filter([{_EXP_SQL}], lambda m: not list_contains("
          f"list(distinct country_code), m))), ',')")
    mp = (f"array_to_string(list_sort(list_filter(range({START}, {END + 1}), lambda y: not list_contains("
          f"list(distinct year), y))), ',')")
    flags.append(f"case when {mm} <> '' then 'members without data: ' || {mm} end")
    flags.append(f"case when {mp} <> '' then 'periods without data: ' || {mp} end")
    fl = f"list_filter([{', '.join(flags)}], lambda x: x is not null)"
    return f"""select '{name}' as dataset, (select count(*) from {before}) as rows_before, count(*) as rows_after,
       (select count(*) from {before}) - count(*) as rows_dropped, count(distinct country_code) as entities_covered,
       array_to_string(list_sort(list_filter(list(distinct country_code), lambda m: list_contains([{_EXP_SQL}], m))),
                       ',') as members_covered,
       array_to_string(list_sort(list(distinct year)), ',') as periods_covered, {mm} as missing_members,
       {mp} as missing_periods,
       to_json(map([{", ".join(f"'{c}'" for c in cols)}], [{", ".join(_npct_sql(c) for c in cols)}]))::VARCHAR
         as null_pct_by_column,
       case when len({fl}) = 0 then 'OK - no alerts' else array_to_string({fl}, ' | ') end as quality_flags
from {src}"""


_TOUR_COLS = ["country", "country_code", "year", "tourist_arrivals", "tourism_receipts_usd", "tourist_departures",
              "arrivals_growth_pct", "receipts_per_tourist"]
_TR_COLS = ["country", "country_code", "year", "tourists_air", "tourists_sea", "tourists_land", "tourists_total",
            "pct_air", "pct_sea", "pct_land", "dominant_transport"]


@register("quality_report", with_ctes("\nunion all\n".join([
    _report_sql("co2_emissions", "silver_co2", "panel_co2", _SILVER_CO2_COLS, CO2_SPEC.null_thresholds),
    _report_sql("tourism_arrivals", "silver_tourism", "panel_tourism", _TOUR_COLS, TOURISM_SPEC.null_thresholds),
    _report_sql("transport_mode", "silver_transport", "bronze_transport_wide", _TR_COLS,
                TRANSPORT_SPEC.null_thresholds)]), "silver_co2", "silver_tourism", "silver_transport"))
def q_quality_report(spark, d):
    """DQ1: before/after rows, coverage, NULL-threshold flags, missing members/periods per silver dataset."""
    bronze = {k: bronze_table(spark, d, k) for k in ("bronze_co2", "bronze_tourism", "bronze_transport")}
    co2 = quality.quality_report(bronze["bronze_co2"], s_co2(spark, d), "co2_emissions",
                                 CO2_SPEC.null_thresholds, EXPECTED, START, END, members="expected")
    tour = quality.quality_report(bronze["bronze_tourism"], s_tourism(spark, d), "tourism_arrivals",
                                  TOURISM_SPEC.null_thresholds, EXPECTED, START, END, members="expected")
    tr = quality.quality_report(bronze["bronze_transport"], s_transport(spark, d), "transport_mode",
                                TRANSPORT_SPEC.null_thresholds, EXPECTED, START, END, members="expected")
    return co2.unionByName(tour).unionByName(tr)


@register("quality_members", with_ctes(f"""
select coalesce(h.country_code, e.country_code) as member, e.country_code is not null as expected, coalesce(h.n_rows, 0) as n_rows, coalesce(h.n_periods, 0) as n_periods
from (select unnest([{_EXP_SQL}, 'N25']) as country_code) e
full join (select country_code, count(*) as n_rows, count(distinct year) as n_periods from silver_tourism group by country_code) h on e.country_code = h.country_code""", "silver_tourism"))
def q_quality_members(spark, d):
    """DQ1 as rows: members of the silver arrivals with their rows and periods, and an expected one that has none."""
    return quality.covered_members(s_tourism(spark, d), EXPECTED + ("N25",))


# ── DQ12 / A17 ──────────────────────────────────────────────────────────────
@register("coverage_report", with_ctes(f"""
select e.country_code, coalesce(h.n_rows, 0) as n_rows,
       array_to_string(list_sort(list_filter(range({START}, {END + 1}),
                       lambda y: not list_contains(coalesce(h.years, []), y))), ',') as missing_periods
from (select unnest([{_EXP_SQL}, 'N25']) as country_code) e
left join (select country_code, count(*) as n_rows, list(year) as years from silver_tourism
           where year between {START} and {END} group by country_code) h on e.country_code = h.country_code
where coalesce(h.n_rows, 0) < {END - START + 1}""", "silver_tourism"))
def q_coverage_report(spark, d):
    """DQ12: incomplete entities with their missing periods (expected members include one absent code)."""
    return quality.coverage_report(s_tourism(spark, d), START, END, EXPECTED + ("N25",))


# ── DQ11 ────────────────────────────────────────────────────────────────────
_GATES = [("panel_co2", "co2", 30.0), ("panel_tourism", "tourist_arrivals", 60.0),
          ("bronze_transport_wide", "tourists_total", 95.0)]


@register("ingest_gate", with_ctes("\nunion all\n".join(
    f"""select '{t}' as source, '{c}' as "column", count(*) as n_rows,
       avg(case when {c} is null then 1.0 else 0.0 end) * 100.0 as null_pct, {lim}::DOUBLE as max_null_pct,
       count(*) > 0 and avg(case when {c} is null then 1.0 else 0.0 end) * 100.0 <= {lim} as ok from {t}"""
    for t, c, lim in _GATES), "panel_co2", "panel_tourism", "bronze_transport_wide"))
def q_ingest_gate(spark, d):
    """DQ11: abort thresholds on NULL share (and emptiness) of the landed sources."""
    srcs = {"panel_co2": bronze_table(spark, d, "bronze_co2"), "panel_tourism": bronze_table(spark, d, "bronze_tourism"),
            "bronze_transport_wide": bronze_table(spark, d, "bronze_transport")}
    out = None
    for t, c, lim in _GATES:
        g = quality.ingest_gate(srcs[t], {c: lim})
        n_rows = srcs[t].select(F.count(F.lit(1))).scalar()
        r = (g.where(F.col("column") == c).withColumn("n_rows", n_rows)
             .withColumn("ok", F.col("ok") & (F.col("n_rows") > 0))
             .select(F.lit(t).alias("source"), "column", "n_rows", "null_pct", "max_null_pct", "ok"))
        out = r if out is None else out.unionByName(r)
    return out


# ── DQ3–DQ10 ────────────────────────────────────────────────────────────────
def _res(dataset, layer, i, check, column, ok, reason):
    col = "null" if column is None else f"'{column}'"
    return (f"select '{dataset}' as dataset, '{layer}' as layer, {i} as check_no, '{check}' as \"check\", "
            f"{col}::VARCHAR as \"column\", ({ok}) as ok, case when not ({ok}) then {reason} end as reason")


def _suite_sql(dataset, layer, src, checks) -> str:
    parts = []
    for i, ch in enumerate(checks):
        t, c = ch["type"], ch.get("column")
        if t == "table_row_count":
            exp, mn = ch.get("expected_value"), ch.get("min_value")
            conds, reasons = [], []
            if exp is not None:
                conds.append(f"count(*) = {exp}")
                reasons.append(f"case when count(*) <> {exp} then 'Expected {exp} rows, got ' || count(*) end")
            if mn is not None:
                conds.append(f"count(*) >= {mn}")
                reasons.append(f"case when count(*) < {mn} then 'Expected min {mn} rows, got ' || count(*) end")
            parts.append(_res(dataset, layer, i, t, None, " and ".join(conds) or "true",
                              f"coalesce({', '.join(reasons)})") + f" from {src}")
        elif t == "column_values_to_not_be_null":
            thr = ch.get("threshold_pct", 0.0)
            pct = f"(case when count(*) > 0 then count(*) filter (where {c} is null) / count(*) * 100.0 else 0.0 end)"
            reason = (f"cast(count(*) filter (where {c} is null) as varchar) || ' nulls (' || "
                      f"printf('%.1f', {rnd(pct, 1)}) || '%) exceeds threshold {thr}%'")
            parts.append(_res(dataset, layer, i, t, c, f"{pct} <= {float(thr)}", reason) + f" from {src}")
        elif t == "column_values_to_be_between":
            lo, hi = ch["min_value"], ch["max_value"]
            n = f"count(*) filter (where {c} is not null and ({c} < {lo} or {c} > {hi}))"
            parts.append(_res(dataset, layer, i, t, c, f"{n} = 0",
                              f"cast({n} as varchar) || ' values outside [{lo}, {hi}]'") + f" from {src}")
        elif t == "column_values_type":
            et = ch.get("expected_type", "float")
            parsed = f"try_cast(cast({c} as varchar) as double)"
            bad = f"{parsed} is null" if et == "int" else f"{c} is not null and {parsed} is null"
            n = f"count(*) filter (where {bad})"
            parts.append(_res(dataset, layer, i, t, c, f"{n} = 0",
                              f"cast({n} as varchar) || ' values not parseable as {et}'") + f" from {src}")
        elif t == "column_values_in_set":
            vals = ", ".join(f"'{v}'" for v in ch["value_set"])
            inv = (f"(select v from (select distinct {c} as v from {src} where coalesce({c} in ({vals}), false)"
                   f" = false) order by v nulls first limit 5)")
            agg = (f"(select count(*) as n, string_agg(coalesce('''' || cast(v as varchar) || '''', 'None'), ', ' "
                   f"order by v nulls first) as vals from {inv})")
            parts.append(_res(dataset, layer, i, t, c, "n = 0", "'Invalid values: [' || vals || ']'") + f" from {agg}")
        elif t == "no_duplicates":
            cols = ", ".join(ch["columns"])
            sub = f"(select coalesce(sum(n), 0) as n from (select count(*) as n from {src} group by {cols}) where n > 1)"
            parts.append(_res(dataset, layer, i, t, ",".join(ch["columns"]), "n = 0",
                              "cast(n as varchar) || ' duplicate rows found'") + f" from {sub}")
        elif t == "column_count":
            n = f"(select max(json_array_length(json_keys(to_json(p)))) as n from {src} p)"
            exp = ch["expected_value"]
            parts.append(_res(dataset, layer, i, t, None, f"n = {exp}", f"'Expected {exp} cols, got ' || n") + f" from {n}")
    return "\nunion all\n".join(parts)


# The silver/gold suites (our label set replaces a stale one; a
# NULL threshold replaces "no NULL at all" where the outer join makes NULLs
# legitimate).
SUITES = {
    ("bronze", "co2_emissions"): [
        {"type": "table_row_count", "min_value": 100},
        {"type": "column_count", "expected_value": 8},
        {"type": "column_values_to_not_be_null", "column": "country_code"},
        {"type": "column_values_to_not_be_null", "column": "year"},
        {"type": "column_values_in_set", "column": "country_code", "value_set": [f"N{k}" for k in range(20)]},
        {"type": "column_values_type", "column": "year", "expected_type": "int"},
        {"type": "column_values_type", "column": "co2", "expected_type": "float"},
    ],
    ("bronze", "tourism_arrivals"): [
        {"type": "table_row_count", "min_value": 50},
        {"type": "column_values_to_not_be_null", "column": "country_code"},
    ],
    ("bronze", "transport_mode"): [
        {"type": "table_row_count", "min_value": 50},
    ],
    ("silver", "co2_emissions"): [
        {"type": "table_row_count", "expected_value": 175},
        {"type": "column_values_to_not_be_null", "column": "co2"},
        {"type": "column_values_to_not_be_null", "column": "gdp", "threshold_pct": 5.0},
        {"type": "column_values_type", "column": "gdp_growth_pct", "expected_type": "float"},
        {"type": "no_duplicates", "columns": ["country_code", "year"]},
    ],
    ("silver", "tourism_arrivals"): [
        {"type": "table_row_count", "min_value": 100},
        {"type": "column_values_type", "column": "arrivals_growth_pct", "expected_type": "float"},
        {"type": "column_values_type", "column": "arrivals_growth_pct", "expected_type": "int"},
    ],
    ("silver", "transport_mode"): [
        {"type": "table_row_count", "expected_value": 175},
        {"type": "column_values_to_not_be_null", "column": "dominant_transport"},
        {"type": "column_values_to_be_between", "column": "pct_air", "min_value": 0, "max_value": 30},
        {"type": "column_values_to_be_between", "column": "pct_land", "min_value": 0, "max_value": 100},
        {"type": "column_values_in_set", "column": "dominant_transport", "value_set": ["air", "land", "sea"]},
    ],
    ("gold", "fact_tourism_emissions"): [
        {"type": "table_row_count", "min_value": 100},
        {"type": "column_values_to_not_be_null", "column": "co2_per_tourist", "threshold_pct": 40.0},
        {"type": "column_values_to_be_between", "column": "co2_per_tourist", "min_value": 0, "max_value": 10000},
        {"type": "column_values_in_set", "column": "sustainability_label",
         "value_set": ["verde", "amarillo", "rojo", "gris"]},
        {"type": "no_duplicates", "columns": ["country_code", "year"]},
    ],
    ("gold", "dim_country"): [
        {"type": "table_row_count", "expected_value": 25},
        {"type": "column_values_to_not_be_null", "column": "country_name"},
        {"type": "column_values_in_set", "column": "region", "value_set": ["AFRICA", "AMERICA", "ASIA", "EUROPE"]},
    ],
}
_SRC = {("bronze", "co2_emissions"): "panel_co2", ("bronze", "tourism_arrivals"): "panel_tourism",
        ("bronze", "transport_mode"): "bronze_transport_wide", ("silver", "co2_emissions"): "silver_co2", ("silver", "tourism_arrivals"): "silver_tourism",
        ("silver", "transport_mode"): "silver_transport", ("gold", "fact_tourism_emissions"): "fact",
        ("gold", "dim_country"): "dim_country"}


def _frame_of(spark, d, layer, name):
    if layer == "bronze":
        return bronze_table(spark, d, {"co2_emissions": "bronze_co2", "tourism_arrivals": "bronze_tourism", "transport_mode": "bronze_transport"}[name])
    return {("silver", "co2_emissions"): s_co2, ("silver", "tourism_arrivals"): s_tourism,
            ("silver", "transport_mode"): s_transport, ("gold", "fact_tourism_emissions"): fact,
            ("gold", "dim_country"): panels.dim_country}[(layer, name)](spark, d)


def _suite_frames(spark, d):
    out = None
    for (layer, name), checks in SUITES.items():
        r = quality.run_suite(_frame_of(spark, d, layer, name), checks, name, layer)
        out = r if out is None else out.unionByName(r)
    return out


_SUITE_SQL = "\nunion all\n".join(_suite_sql(name, layer, _SRC[(layer, name)], checks)
                                  for (layer, name), checks in SUITES.items())


@register("run_suite", with_ctes(_SUITE_SQL, "panel_co2", "panel_tourism", "bronze_transport_wide", "silver_co2", "silver_tourism", "silver_transport", "fact",
                                 "dim_country"))
def q_run_suite(spark, d):
    """DQ10: declarative suites over bronze, silver and gold, one result row per check."""
    return _suite_frames(spark, d)


_NCOLS = {"panel_co2": 6, "panel_tourism": 6, "bronze_transport_wide": 10, "silver_co2": 10, "silver_tourism": 8, "silver_transport": 11, "fact": 26, "dim_country": 4}


@register("suite_summary", with_ctes("\nunion all\n".join(f"""
select dataset, layer, count(*) as total_checks, count(*) filter (where ok) as passed,
       count(*) filter (where not ok) as failed,
       case when count(*) filter (where not ok) = 0
            then printf('%d/%d checks OK', count(*) filter (where ok), count(*))
            else printf('⚠️ %d/%d checks FAILED', count(*) filter (where not ok), count(*)) end as summary,
       (select count(*) from {_SRC[k]}) as n_rows, {_NCOLS[_SRC[k]]} as n_cols
from ({_suite_sql(k[1], k[0], _SRC[k], checks)}) group by dataset, layer""" for k, checks in SUITES.items()),
                                     "panel_co2", "panel_tourism", "bronze_transport_wide", "silver_co2", "silver_tourism", "silver_transport",
                                     "fact", "dim_country"))
def q_suite_summary(spark, d):
    """DQ10 report: total / passed / failed / summary and table stats per dataset."""
    out = None
    for (layer, name), checks in SUITES.items():
        r = quality.suite_report(_frame_of(spark, d, layer, name), checks, name, layer)
        out = r if out is None else out.unionByName(r)
    return out


def _one_check(name, layer, src_cte, check, frame_fn):
    sql = with_ctes(_suite_sql(name, layer, src_cte, [check]), src_cte)

    def build(spark, d):
        return quality.run_suite(frame_fn(spark, d), [check], name, layer)

    return sql, build


for _qname, _layer, _ds, _cte, _check, _fn in [
    ("check_row_count", "silver", "tourism_arrivals", "silver_tourism",
     {"type": "table_row_count", "expected_value": 144}, s_tourism),
    ("check_not_null", "silver", "co2_emissions", "silver_co2",
     {"type": "column_values_to_not_be_null", "column": "population"}, s_co2),
    ("check_no_duplicates", "gold", "fact_tourism_emissions", "fact",
     {"type": "no_duplicates", "columns": ["country", "sustainability_label"]}, fact),
    ("check_in_set", "gold", "fact_tourism_emissions", "fact",
     {"type": "column_values_in_set", "column": "sustainability_label", "value_set": ["high", "medium", "low"]}, fact),
    ("check_between", "silver", "tourism_arrivals", "silver_tourism",
     {"type": "column_values_to_be_between", "column": "arrivals_growth_pct", "min_value": -10, "max_value": 10},
     s_tourism),
    ("check_type", "silver", "co2_emissions", "silver_co2",
     {"type": "column_values_type", "column": "gdp", "expected_type": "int"}, s_co2),
]:
    _sql, _build = _one_check(_ds, _layer, _cte, _check, _fn)
    _build.__doc__ = f"DQ check {_check['type']} on {_ds}."
    register(_qname, _sql)(_build)


@register("check_column_count", with_ctes("""
select 'co2_emissions' as dataset, 'bronze' as layer, 0 as check_no, 'column_count' as "check", null::VARCHAR as "column",
       n = 8 as ok, case when n <> 8 then 'Expected 8 cols, got ' || n end as reason
from (select max(json_array_length(json_keys(to_json(p)))) as n from panel_co2 p)""", "panel_co2"))
def q_check_column_count(spark, d):
    """DQ9: exact number of columns (driver-side schema check, reported as a row)."""
    return quality.run_suite(panels.panel_co2(spark, d), [{"type": "column_count", "expected_value": 8}],
                             "co2_emissions", "bronze")


# ── A16 ─────────────────────────────────────────────────────────────────────
def _iqr_sql(src: str, cols: dict, order: list[str], deps: tuple = (), digits: int = 6) -> str:
    t = "\nunion all\n".join(f"select {', '.join(order)}, '{c}' as \"column\", cast({c} as double) as value from {src}"
                             for c in cols)
    m = "\nunion all\n".join(f"select '{c}' as \"column\", {float(v)}::DOUBLE as multiplier" for c, v in cols.items())
    o = ", ".join(order)
    samples = ", ".join(f"max(case when rn = {i} then value end) as sample_{i}" for i in range(1, 6))
    return with_ctes(f"""
select b."column", 'iqr' as method, {rnd('q1', digits)} as q1, {rnd('q3', digits)} as q3,
       {rnd('iqr', digits)} as iqr, {rnd('lower_bound', digits)} as lower_bound,
       {rnd('upper_bound', digits)} as upper_bound, multiplier, coalesce(c.outliers_count, 0) as outliers_count,
       coalesce(c.outliers_count, 0) / n_rows * 100.0 as outlier_percentage,
       sample_1, sample_2, sample_3, sample_4, sample_5
from b left join c on b."column" = c."column"
""", *deps, extra={
        "t": t, "m": m,
        "s": """select "column", quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3,
                       count(*) as n_rows from t group by "column\"""",
        "b": """select s.*, m.multiplier, q3 - q1 as iqr, q1 - m.multiplier * (q3 - q1) as lower_bound,
                       q3 + m.multiplier * (q3 - q1) as upper_bound from s join m on s."column" = m."column\"""",
        "f": f"""select t.*, row_number() over (partition by t."column" order by {', '.join('t.' + x for x in order)}) as rn
                from t join b on t."column" = b."column" where t.value < b.lower_bound or t.value > b.upper_bound""",
        "c": f"""select "column", count(*) as outliers_count, {samples} from f group by "column\"""",
    })


# IQR multipliers of the emissions panel columns.
_CO2_OUT = {"co2": 1.5, "gdp": 1.5, "population": 2.0}
_LI_OUT = {"l_extendedprice": 1.5, "l_quantity": 1.5, "l_discount": 3.0}


@register("iqr_outliers", _iqr_sql("silver_co2", _CO2_OUT, ["country_code", "year"], deps=("silver_co2",)))
def q_iqr_outliers(spark, d):
    """IQR outliers of the silver emissions panel (flag only)."""
    return iqr_outliers(s_co2(spark, d), _CO2_OUT, ["country_code", "year"], digits=6)


# IQR multipliers of the other two silver panels.
_TOURISM_OUT = {"tourist_arrivals": 1.5, "tourism_receipts_usd": 1.5}
_TRANSPORT_OUT = {"tourists_air": 1.5, "tourists_sea": 2.0, "tourists_land": 1.5}
_OUT = (("co2_emissions", "silver_co2", _CO2_OUT), ("tourism_arrivals", "silver_tourism", _TOURISM_OUT), ("transport_mode", "silver_transport", _TRANSPORT_OUT))

for _name, _src, _mult in _OUT[1:]:
    def _iqr(spark, d, _src=_src, _mult=_mult):
        return iqr_outliers({"silver_tourism": s_tourism, "silver_transport": s_transport}[_src](spark, d), _mult, ["country_code", "year"], digits=6)

    _iqr.__doc__ = f"A16: IQR outliers of the silver table {_name}."
    register(f"iqr_outliers_{_name}", _iqr_sql(_src, _mult, ["country_code", "year"], deps=(_src,)))(_iqr)


@register("outlier_report", "\nunion all\n".join(f"select '{n}' as dataset, \"column\", outliers_count, lower_bound, upper_bound from ({_iqr_sql(src, m, ['country_code', 'year'], deps=(src,))})"
                                                  for n, src, m in _OUT))
def q_outlier_report_written(spark, d):
    """A16 + IO13: the outlier report of the three silver tables, written by date (twice: the second replaces the first) and read back."""
    from tidepanel.sources import sinks
    report, path = q_outlier_report(spark, d), scratch_dir(spark, "outliers")
    for _ in range(2):
        part = sinks.write_report(report, path, "2001-12-31")
    return spark.read.schema(report.schema).json(part).select("dataset", "column", "outliers_count", "lower_bound", "upper_bound")


def q_outlier_report(spark, d):
    """IQR outliers of the three silver tables."""
    out = None
    for (name, _, multipliers), frame in zip(_OUT, (s_co2, s_tourism, s_transport)):
        r = iqr_outliers(frame(spark, d), multipliers, ["country_code", "year"], digits=6).select(F.lit(name).alias("dataset"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@register("iqr_outliers_lineitem", _iqr_sql("lineitem", _LI_OUT, ["l_orderkey", "l_linenumber"]))
def q_iqr_outliers_lineitem(spark, d):
    """A16 at volume: IQR outliers over every line item."""
    li = panels.table(spark, d, "lineitem")
    return iqr_outliers(li, _LI_OUT, ["l_orderkey", "l_linenumber"], digits=6)


@register("iqr_outliers_by_region", with_ctes(f"""
select region, {rnd('q1', 6)} as q1, {rnd('q3', 6)} as q3, {rnd('q3 - q1', 6)} as iqr,
       {rnd('q1 - 1.5::DOUBLE * (q3 - q1)', 6)} as lower_bound, {rnd('q3 + 1.5::DOUBLE * (q3 - q1)', 6)} as upper_bound,
       1.5::DOUBLE as multiplier,
       (select count(*) from j where j.region = s.region
          and (j.co2 < s.q1 - 1.5::DOUBLE * (s.q3 - s.q1) or j.co2 > s.q3 + 1.5::DOUBLE * (s.q3 - s.q1)))
         as outliers_count,
       (select count(*) from j where j.region = s.region
          and (j.co2 < s.q1 - 1.5::DOUBLE * (s.q3 - s.q1) or j.co2 > s.q3 + 1.5::DOUBLE * (s.q3 - s.q1)))
         / n_rows * 100.0 as outlier_percentage
from s""", "silver_co2", "dim_country", extra={
    "j": "select d.region, c.co2 from silver_co2 c join dim_country d on c.country_code = d.country_code",
    "s": "select region, quantile_cont(co2, 0.25) as q1, quantile_cont(co2, 0.75) as q3, count(*) as n_rows "
         "from j group by region"}))
def q_iqr_outliers_by_region(spark, d):
    """A16 per group: emissions outliers within each region (one plan for groups of any size)."""
    from tidepanel.operators.outliers import iqr_outliers_by
    j = s_co2(spark, d).join(panels.dim_country(spark, d).select("country_code", "region"), "country_code")
    return iqr_outliers_by(j, "region", "co2", 1.5, digits=6)


_LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey", "l_returnflag"]


def _line_by_year(spark, d):
    return panels.table(spark, d, "lineitem").select(*_LINE, "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("ship_year"))


def _exact_columns(numbers, texts):
    n = lambda c: f"select '{c}' as \"column\", count(*) as n_rows, count(*) - count({c}) as n_nulls, cast(min({c}) as double) as least_number, cast(max({c}) as double) as most_number, count(distinct {c}) as exact from lineitem"
    t = lambda c: f"select '{c}', count(*), count(*) - count({c}), null, null, count(distinct {c}) from lineitem"
    return " union all ".join([*map(n, numbers), *map(t, texts)])


@register("profile_merged", f"""
select "column", n_rows, n_nulls, least_number, most_number, exact as n_distinct_exact, true as distinct_near, "column" <> 'l_returnflag' as quartiles_near
from ({_exact_columns(_LINE[:4], _LINE[4:])})""")
def q_profile_merged(spark, d):
    """A6 / DQ2 / DQ13 from stored sketches, a profile row per ship year and column merged: within their error of the exact values."""
    base = scratch_dir(spark, "profiled")
    _line_by_year(spark, d).write.partitionBy("ship_year").parquet(f"{base}/t")
    profile.refresh_profile(spark, f"{base}/t", f"{base}/p", _LINE, "ship_year")
    done = profile.refresh_profile(spark, f"{base}/t", f"{base}/p", _LINE, "ship_year")
    if done.read:
        raise AssertionError(f"read again: {done.read}")
    m = profile.merged_profile(done.profile)
    rows = panels.table(spark, d, "lineitem")
    exact = rows.agg(*[F.countDistinct(c).alias(f"d{i}") for i, c in enumerate(_LINE)]).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n_distinct_exact")) for i, c in enumerate(_LINE)])))
    est = {r["column"]: r for r in m.select("column", "q_0", "q_2").collect()}  # a row per column
    up = lambda c, q: F.avg((F.col(c).cast("double") <= F.lit(est[c][q])).cast("double")).alias(f"up_{q}")
    low = lambda c, q: F.avg((F.col(c).cast("double") < F.lit(est[c][q])).cast("double")).alias(f"low_{q}")
    ranks = rows.agg(*[F.struct(*[f(c, q) for q in ("q_0", "q_2") for f in (up, low)]).alias(f"r_{i}") for i, c in enumerate(_LINE[:4])])
    near = lambda r: ((r["low_q_0"] <= 0.25 + 3 * profile.RANK_ERROR) & (r["up_q_0"] >= 0.25 - 3 * profile.RANK_ERROR) & (r["low_q_2"] <= 0.75 + 3 * profile.RANK_ERROR) & (r["up_q_2"] >= 0.75 - 3 * profile.RANK_ERROR))
    quartiles = ranks.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), near(F.col(f"r_{i}")).alias("quartiles_near")) for i, c in enumerate(_LINE[:4])])))
    return (m.join(exact, "column").join(quartiles, "column", "left")
            .select("column", "n_rows", "n_nulls", "least_number", "most_number", "n_distinct_exact",
                    (F.abs(F.col("n_distinct") - F.col("n_distinct_exact")) <= 1 + 4 * profile.DISTINCT_ERROR * F.col("n_distinct_exact")).alias("distinct_near"), F.coalesce("quartiles_near", F.lit(False)).alias("quartiles_near")))


@register("profile_refresh", """
select cast(year(l_shipdate) as varchar) as partition, year(l_shipdate) = 1995 as read_again, case when year(l_shipdate) = 1995 then 2 else 1 end * count(*) as n_rows
from lineitem group by 1, 2, year(l_shipdate)""")
def q_profile_refresh(spark, d):
    """After one ship year got its rows a second time, the profile is up to date and only that year was read."""
    base = scratch_dir(spark, "refreshed")
    rows = _line_by_year(spark, d)
    rows.write.partitionBy("ship_year").parquet(f"{base}/t")
    profile.refresh_profile(spark, f"{base}/t", f"{base}/p", ["l_quantity"], "ship_year")
    rows.where("ship_year = 1995").write.mode("append").partitionBy("ship_year").parquet(f"{base}/t")
    done = profile.refresh_profile(spark, f"{base}/t", f"{base}/p", ["l_quantity"], "ship_year")
    by_part = done.profile.select(F.element_at(F.split(F.input_file_name(), "/"), -2).alias("of"), "n_rows").select(F.element_at(F.split("of", "-"), -1).alias("partition"), "n_rows")
    return by_part.select("partition", F.col("partition").isin(done.read).alias("read_again"), "n_rows")


@register("profile_metadata", with_ctes("""
select 'co2_emissions' as "table", count(*) as n_rows, count(distinct country_code) as n_members, min(year) as period_min, max(year) as period_max from silver_co2""", "silver_co2"))
def q_profile_metadata(spark, d):
    """IO11 without a scan: rows, members and period range of a stored silver table from its stored profile."""
    path, cols = layers.lake(spark, d)["silver_co2"], ["country_code", "year", "co2", "gdp"]
    done = profile.refresh_profile(spark, path, f"{scratch_dir(spark, 'profiles')}/co2", cols, by=None)
    return profile.profiled_metadata(done.profile, "co2_emissions").select("table", "n_rows", "n_members", "period_min", "period_max")
