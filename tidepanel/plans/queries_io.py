"""Registered source/sink round trips (IO1–IO14) and the SQL API questions.

Each query writes Spark-derived data to a fresh folder under the session's
``spark.checkpoint.dir`` (the shared folder on a cluster), reads it back with
the reader under test and returns the result; the oracle is the SQL of the
data that was written.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.plans import panels
from tidepanel.plans.oracle import with_ctes
from tidepanel.plans.queries import MIN_YEAR, fact, s_co2, s_tourism
from tidepanel.plans.queries_quality import q_quality_report
from tidepanel.plans.registry import QUERIES, register
from tidepanel.session import scratch_dir
from tidepanel.sources import catalog, readers, sinks

_SQL_DIR = os.path.join(os.path.dirname(__file__), "sql")
CO2_COLS = ["country", "country_code", "year", "co2", "gdp", "population"]


def sql_text(name: str, **params) -> str:
    with open(os.path.join(_SQL_DIR, f"{name}.sql")) as fh:
        return fh.read().format(min_year=MIN_YEAR, **params)


@register("write_read_partitioned", with_ctes("select * from panel_co2", "panel_co2"))
def q_write_read_partitioned(spark, d):
    """IO8 + IO1: Hive-partitioned write (year=), read back with partition types forced."""
    path = scratch_dir(spark, "bronze_co2")
    sinks.write_bronze_partitioned(panels.panel_co2(spark, d), path)
    return readers.read_partitioned(spark, path).select(*CO2_COLS)


@register("write_bronze_partitioned", with_ctes("""
select year, country_code, count(*) as n_rows from panel_co2 group by year, country_code""", "panel_co2"))
def q_write_bronze_partitioned(spark, d):
    """IO8: two-key layout (year, country_code); the written partitions and their rows."""
    path = scratch_dir(spark, "bronze_co2_2key")
    sinks.write_bronze_partitioned(panels.panel_co2(spark, d), path, ("year", "country_code"), ())
    back = spark.read.parquet(path)
    return back.groupBy(F.col("year").cast("bigint").alias("year"), "country_code").agg(F.count(F.lit(1)).alias("n_rows"))


@register("read_tree", with_ctes("""
select country_code, year, co2, null::double as tourist_arrivals from silver_co2
union all select country_code, year, null::double, tourist_arrivals from silver_tourism""",
                                 "silver_co2", "silver_tourism"))
def q_read_tree(spark, d):
    """IO2: two folders with different column sets, unioned by name (missing -> NULL)."""
    base = scratch_dir(spark, "tree")
    sinks.write_table(s_co2(spark, d).select("country_code", "year", "co2"), f"{base}/co2/part=a")
    sinks.write_table(s_tourism(spark, d).select("country_code", "year", "tourist_arrivals"), f"{base}/tourism")
    return readers.read_tree(spark, [f"{base}/co2", f"{base}/tourism"])


@register("read_single", with_ctes("select * from fact", "fact"))
def q_read_single(spark, d):
    """IO9 + IO3: write the fact as one table, read it back (period as nullable bigint)."""
    path = scratch_dir(spark, "fact")
    sinks.write_table(fact(spark, d), path, ["country_code", "year"])
    return readers.read_single(spark, path)


_CO2_FULL = T.StructType([
    T.StructField("country", T.StringType()), T.StructField("country_code", T.StringType()),
    T.StructField("year", T.LongType()), T.StructField("co2", T.DoubleType()),
    T.StructField("gdp", T.DoubleType()), T.StructField("population", T.DoubleType()),
    T.StructField("methane", T.DoubleType()), T.StructField("share_global_co2", T.DoubleType()),
])


@register("read_schema_override", with_ctes("""
select *, null::double as methane, null::double as share_global_co2 from panel_co2""", "panel_co2"))
def q_read_schema_override(spark, d):
    """IO4: fixed 8-column schema over files that hold 6 columns."""
    path = scratch_dir(spark, "co2_override")
    sinks.write_bronze_partitioned(panels.panel_co2(spark, d), path)
    return readers.read_schema_override(spark, path, _CO2_FULL, base_path=path)


@register("read_csv_wide", with_ctes("select * from panel_co2", "panel_co2"))
def q_read_csv_wide(spark, d):
    """IO5: wide CSV with header, text -> numbers with try_cast."""
    path = scratch_dir(spark, "co2_csv")
    panels.panel_co2(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    return readers.read_csv_wide(spark, path, numeric=["co2", "gdp", "population"], integer=["year"])


def _indicator_records(spark, d):
    p = panels.panel_tourism(spark, d)
    dim = panels.dim_country(spark, d)
    rows = p.join(dim, "country_code").select(
        F.struct(F.lit("ST.INT.ARVL").alias("id"), F.lit("International tourism, number of arrivals").alias("value"))
        .alias("indicator"),
        F.struct(F.col("country_code_iso2").alias("id"), F.col("country").alias("value")).alias("country"),
        F.col("country_code").alias("countryiso3code"), F.col("year").cast("string").alias("date"),
        F.col("tourist_arrivals").alias("value"))
    # regional aggregates carry 3-character ids and must be skipped by the reader
    agg = p.join(dim, "country_code").groupBy("region", "year").agg(F.sum("tourist_arrivals").alias("v")).select(
        F.struct(F.lit("ST.INT.ARVL").alias("id"), F.lit("International tourism, number of arrivals").alias("value"))
        .alias("indicator"),
        F.struct(F.concat(F.lit("R"), F.substring("region", 1, 2)).alias("id"), F.col("region").alias("value"))
        .alias("country"),
        F.lit("").alias("countryiso3code"), F.col("year").cast("string").alias("date"), F.col("v").alias("value"))
    return rows.unionByName(agg)


@register("read_json_indicator", with_ctes("""
select country, country_code, year, tourist_arrivals from panel_tourism where year between 1996 and 2001""",
                                           "panel_tourism"))
def q_read_json_indicator(spark, d):
    """IO6: nested records -> flat rows; aggregates, unknown members and out-of-range years dropped."""
    path = scratch_dir(spark, "wb_json")
    _indicator_records(spark, d).write.mode("overwrite").json(path)
    members = panels.nation_codes(spark, d).select("country")
    return readers.read_json_indicator(spark, path, "tourist_arrivals", members, 1996, 2001)


@register("read_long_indicators", with_ctes("select * from long_sheet", "long_sheet"))
def q_read_long_indicators(spark, d):
    """IO7: long indicator sheet landed as CSV."""
    path = scratch_dir(spark, "long_csv")
    panels.long_indicator_sheet(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    return readers.read_long_indicators(spark, path, "csv")


# Units and descriptions of the fact columns.
FACT_DOCS = {
    "country": ("", "entity name"),
    "country_code": ("", "entity code"),
    "year": ("year", "period"),
    "co2": ("Mt", "emissions"),
    "co2_per_capita_calc": ("t/person", "emissions per inhabitant"),
    "co2_intensity_gdp": ("kg/USD", "emissions per unit of GDP"),
    "gdp": ("USD", "gross domestic product"),
    "gdp_per_capita": ("USD/person", "GDP per inhabitant"),
    "gdp_growth_pct": ("%", "GDP growth vs previous period"),
    "population": ("persons", "population"),
    "tourist_arrivals": ("arrivals", "international arrivals"),
    "tourism_receipts_usd": ("USD", "tourism receipts"),
    "tourist_departures": ("departures", "international departures"),
    "arrivals_growth_pct": ("%", "arrivals growth vs previous period"),
    "receipts_per_tourist": ("USD/arrival", "receipts per arrival"),
    "tourists_air": ("arrivals", "arrivals by air"),
    "tourists_sea": ("arrivals", "arrivals by sea"),
    "tourists_land": ("arrivals", "arrivals by land"),
    "tourists_total": ("arrivals", "arrivals, all modes"),
    "pct_air": ("%", "share of air"),
    "pct_sea": ("%", "share of sea"),
    "pct_land": ("%", "share of land"),
    "dominant_transport": ("", "mode with the largest share"),
    "co2_per_tourist": ("t/arrival", "emissions per arrival"),
    "co2_growth_pct": ("%", "emissions growth vs previous period"),
    "sustainability_label": ("", "growth quadrant label"),
}
_FACT_TYPES = {c: ("bigint" if c == "year" else "string" if c in ("country", "country_code", "dominant_transport",
                                                                   "sustainability_label") else "double")
               for c in FACT_DOCS}


# Descriptive fields of the exported fact.
FACT_INFO = {"title": "Tourism and emissions panel", "license": "CC BY 4.0",
             "source": "Derived from the warehouse tables (orders, lineitem, customer, supplier, nation)"}


def _meta_sql() -> str:
    from tidepanel.plans.oracle import rnd
    parts = [f"""select 'fact_tourism_emissions' as dataset_id, 'v1' as version, 'CC BY 4.0' as license,
       (select count(*) from fact) as rows, '{c}' as "column",
       {rnd(f"avg(case when {c} is null then 1.0 else 0.0 end) * 100.0", 1)} as null_pct,
       '{_FACT_TYPES[c]}' as type, '{FACT_DOCS[c][0]}' as unit from fact""" for c in FACT_DOCS]
    return with_ctes("\nunion all\n".join(parts), "fact")


def _md_sql() -> str:
    from tidepanel.plans.oracle import rnd
    head = [f"# Data Dictionary — fact_tourism_emissions (v1)", ""]
    head += [f"**{k}:** {v}" for k, v in FACT_INFO.items()] + ["", "| Column | Type | Unit | Description | Null % |",
                                                               "|--------|------|------|-------------|--------|"]
    tail = ["", "*Generated on 2001-12-31*"]
    lits = "\nunion all\n".join(f"select '{t}' as value" for t in head + tail)
    body = "\nunion all\n".join(
        f"""select printf('| `%s` | %s | %s | %s | %.1f%% |', '{c}', '{_FACT_TYPES[c]}',
              '{FACT_DOCS[c][0] or "—"}', '{FACT_DOCS[c][1] or "—"}',
              {rnd(f"avg(case when {c} is null then 1.0 else 0.0 end) * 100.0", 1)}) from fact"""
        for c in FACT_DOCS)
    return with_ctes(lits + "\nunion all\n" + body, "fact")


def _export(spark, d):
    return sinks.export_open_data(fact(spark, d), scratch_dir(spark, "open-data"), "v1", "gold",
                                  "fact_tourism_emissions", FACT_DOCS, FACT_INFO, "2001-12-31")


@register("export_open_data", with_ctes("""
select 'parquet' as format, country_code, year, co2, dominant_transport from fact
union all select 'csv', country_code, year, co2, dominant_transport from fact""", "fact"))
def q_export_open_data(spark, d):
    """IO10: versioned Parquet + CSV export; both read back."""
    out = _export(spark, d)
    cols = ["country_code", "year", "co2", "dominant_transport"]
    rows = spark.read.parquet(out["parquet"]).select(F.lit("parquet").alias("format"), *cols)
    text = spark.read.option("header", "true").csv(out["csv"])
    return rows.unionByName(text.select(F.lit("csv").alias("format"), *[F.col(c).cast(t) for c, t in rows.dtypes if c != "format"]))


@register("open_data_metadata", _meta_sql())
def q_open_data_metadata(spark, d):
    """IO11 export: metadata.json read back -> one row per column (type, unit, NULL %) plus identity/rows."""
    out = _export(spark, d)
    schema = ("dataset_id string, version string, license string, rows bigint, "
              "null_pct map<string,double>, schema map<string,struct<type:string,unit:string,description:string>>")
    m = spark.read.schema(schema).json(out["metadata"])
    return m.select("dataset_id", "version", "license", "rows", F.explode("null_pct").alias("column", "null_pct"),
                    "schema").select("dataset_id", "version", "license", "rows", "column", "null_pct",
                                     F.col("schema")[F.col("column")]["type"].alias("type"),
                                     F.col("schema")[F.col("column")]["unit"].alias("unit"))


@register("data_dictionary_markdown", _md_sql())
def q_data_dictionary_markdown(spark, d):
    """IO12 export: data_dictionary.md read back as lines."""
    return spark.read.text(_export(spark, d)["dictionary"])


@register("table_metadata", with_ctes("""
select 'fact_tourism_emissions' as "table", count(*) as n_rows, 26 as n_columns, min(year) as period_min,
       max(year) as period_max, count(distinct country_code) as n_members from fact""", "fact"))
def q_table_metadata(spark, d):
    """IO11: table metadata in one aggregation."""
    return sinks.table_metadata(fact(spark, d), "fact_tourism_emissions")


@register("table_members", with_ctes("""
select distinct 'fact_tourism_emissions' as "table", country_code as member from fact where country_code is not null""", "fact"))
def q_table_members(spark, d):
    """IO11: the members of a table as rows."""
    return sinks.table_members(fact(spark, d), "fact_tourism_emissions")


@register("export_coverage", with_ctes("""
select 'tourism_arrivals' as dataset_id, unnest(list_sort(list(distinct country_code))) as country, min(year) as year_start, max(year) as year_end,
       count(*) as n_rows, 8 as n_columns from silver_tourism""", "silver_tourism"))
def q_export_coverage(spark, d):
    """IO10 + IO11 of a silver table: the coverage block of its written metadata."""
    t = s_tourism(spark, d)
    out = sinks.export_open_data(t, scratch_dir(spark, "open-data-silver"), "v1", "silver", "tourism_arrivals",
                                 {c: ("", "") for c in t.columns}, FACT_INFO, "2001-12-31")
    schema = "dataset_id string, coverage struct<countries:array<string>,year_start:bigint,year_end:bigint,rows:bigint,columns:int>"
    return spark.read.schema(schema).json(out["metadata"]).select(
        "dataset_id", F.explode("coverage.countries").alias("country"), "coverage.year_start", "coverage.year_end", F.col("coverage.rows").alias("n_rows"),
        F.col("coverage.columns").alias("n_columns"))


def _dict_sql() -> str:
    from tidepanel.plans.oracle import rnd
    parts = [f"""select {i} as ordinal, '{c}' as "column", '{_FACT_TYPES[c]}' as type, '{FACT_DOCS[c][0]}' as unit,
       '{FACT_DOCS[c][1]}' as description,
       {rnd(f"avg(case when {c} is null then 1.0 else 0.0 end) * 100.0", 1)} as null_pct from fact"""
             for i, c in enumerate(FACT_DOCS)]
    return with_ctes("\nunion all\n".join(parts), "fact")


@register("data_dictionary", _dict_sql())
def q_data_dictionary(spark, d):
    """IO12: one row per column with type, unit, description and % NULL."""
    return sinks.data_dictionary(fact(spark, d), FACT_DOCS)



@register("write_report", QUERIES["quality_report"].sql)
def q_write_report(spark, d):
    """IO13: the silver quality report appended as JSON under run_date=, read back."""
    rep = q_quality_report(spark, d)
    path = scratch_dir(spark, "reports")
    part = sinks.write_report(rep, path, "2001-12-31")
    return spark.read.schema(rep.schema).json(part)


def _register_gold(spark, d):
    catalog.register_tables(spark, {"fact_tourism_emissions": fact(spark, d),
                                    "dim_country": panels.dim_country(spark, d)})


for _i, _name in enumerate(["q01_tourism_vs_co2", "q02_transport_impact", "q03_growth_vs_co2", "q04_evolution",
                            "q05_sustainable"], start=1):
    def _build(spark, d, _name=_name):
        _register_gold(spark, d)
        return spark.sql(sql_text(_name))

    _build.__doc__ = f"IO14 + SQL API: {_name} through spark.sql over registered views."
    register(f"sql_{_name}", QUERIES[_name].sql)(_build)


@register("register_tables", with_ctes("""
select f.country_code, d.region, f.year, f.co2 from fact f join dim_country d on f.country_code = d.country_code""",
                                       "fact", "dim_country"))
def q_register_tables(spark, d):
    """IO14: tables written to Parquet, registered as views, joined in SQL."""
    base = scratch_dir(spark, "gold")
    sinks.write_table(fact(spark, d), f"{base}/fact")
    sinks.write_table(panels.dim_country(spark, d), f"{base}/dim")
    catalog.register_tables(spark, {"g_fact": f"{base}/fact", "g_dim": f"{base}/dim"})
    return spark.sql("SELECT f.country_code, d.region, f.year, f.co2 FROM g_fact f "
                     "JOIN g_dim d ON f.country_code = d.country_code")


@register("read_tree_mixed_types", with_ctes("""
select country_code, year, case when year % 3 = 0 then floor(co2) else co2 end as co2,
       case when year % 3 = 2 then cast(population as bigint) end as population from panel_co2""", "panel_co2"))
def q_read_tree_mixed_types(spark, d):
    """IO2 over files that type a column differently: int and bigint, bigint and double, a column that only some have."""
    base, p = scratch_dir(spark, "mixed"), panels.panel_co2(spark, d)
    own = lambda k: p.where(F.col("year") % 3 == k)
    own(0).select("country_code", F.col("year").cast("int").alias("year"), F.floor("co2").alias("co2")).write.parquet(f"{base}/a")
    own(1).select("country_code", "year", "co2").write.parquet(f"{base}/b/c")
    own(2).select("country_code", "year", "co2", F.col("population").cast("bigint").alias("population")).write.parquet(f"{base}/d")
    return readers.read_tree(spark, base)


@register("quarantine", with_ctes("""
select 'year' as "column", case when year % 7 = 0 then 'not an integer' else 'is missing' end as reason, true as rejected, count(*) as n_rows
from panel_co2 where year % 7 in (0, 1) group by 1, 2, 3
union all select 'co2', 'not a number', false, count(*) from panel_co2 where year % 5 = 0
union all select 'accepted', null, false, count(*) from panel_co2 where year % 7 not in (0, 1)
union all select 'rejects', null, true, count(*) from panel_co2 where year % 7 in (0, 1)""", "panel_co2"))
def q_quarantine(spark, d):
    """PF7 with refused rows kept: why rows or cells were refused, and that all rows are on one side."""
    from tidepanel.operators.clean import quarantine
    from tidepanel.spec import CO2_SPEC

    year, text = F.col("year"), F.col("year").cast("string")
    raw = panels.panel_co2(spark, d).select("country", "country_code", F.when(year % 7 == 0, F.concat(text, F.lit("-ish"))).when(year % 7 != 1, text).alias("year"),
                                            F.when(year % 5 == 0, "n/a").otherwise(F.col("co2").cast("string")).alias("co2"), "gdp")
    got = quarantine(raw, CO2_SPEC)
    side = lambda df, name, refused: df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("column"), F.lit(None).cast("string").alias("reason"), F.lit(refused).alias("rejected"), "n_rows")
    why = got.reasons.groupBy("column", "reason", "rejected").agg(F.count(F.lit(1)).alias("n_rows"))
    return why.unionByName(side(got.accepted, "accepted", False)).unionByName(side(got.rejects, "rejects", True))


@register("catalog_update", with_ctes("""
select country_code, year, case when year < 1996 then floor(co2) else co2 end as co2, case when year >= 1996 then population end as population from panel_co2""", "panel_co2"))
def q_catalog_update(spark, d):
    """IO14: a registered table gets wider and new columns and new partitions without being dropped."""
    path, p, name = scratch_dir(spark, "catalog"), panels.panel_co2(spark, d), "grown_" + uuid.uuid4().hex[:8]
    p.where("year < 1996").select("country_code", F.floor("co2").cast("int").alias("co2"), "year").write.partitionBy("year").parquet(path)
    catalog.register_tables(spark, {name: path}, database="default")
    p.where("year >= 1996").select("country_code", "co2", "population", "year").write.mode("append").partitionBy("year").parquet(path)
    catalog.register_tables(spark, {name: path}, database="default")
    return spark.table(f"default.{name}").select("country_code", F.col("year").cast("bigint").alias("year"), "co2", "population")


@register("bronze_transport_roundtrip", with_ctes("select * from bronze_transport_wide", "bronze_transport_wide"))
def q_bronze_transport_roundtrip(spark, d):
    """C6 end to end: sheet landed as CSV -> read -> bronze chain."""
    from tidepanel.plans import bronze
    path = scratch_dir(spark, "sheet")
    panels.long_indicator_sheet(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    sheet = readers.read_long_indicators(spark, path)
    codes = panels.nation_codes(spark, d)
    wide = bronze.transport_from_sheet(sheet, panels.reporter_aliases(), codes.select("country"), codes)
    out = scratch_dir(spark, "bronze_transport")
    bronze.land(wide, "transport_mode", out)
    return readers.read_partitioned(spark, out).select(*[c for c in wide.columns if c != "is_duplicate"])



@register("stream_landing_ingest", with_ctes("select * from panel_co2", "panel_co2"))
def q_stream_landing_ingest(spark, d):
    """C6 incremental: two landings of CSV files ingested by two availableNow runs into bronze."""
    from tidepanel.operators.clean import apply_schema
    from tidepanel.spec import CO2_SPEC
    from tidepanel.streaming import ingest_landed

    base = scratch_dir(spark, "landing")
    landing, bronze, ckpt = f"{base}/landing", f"{base}/bronze", f"{base}/_checkpoint"
    raw_schema = "country string, country_code string, year string, co2 string, gdp string, population string"
    p = panels.panel_co2(spark, d)
    for cond in (F.col("year") <= 1997, F.col("year") > 1997):
        # a new landing (new files in the same folder), then an incremental run over the same checkpoint
        p.where(cond).write.mode("append").option("header", "true").csv(landing)
        ingest_landed(spark, landing, raw_schema, bronze, ckpt, transform=lambda s: apply_schema(s, CO2_SPEC))
    return readers.read_partitioned(spark, bronze).select(*CO2_COLS)


@register("bronze_co2_from_csv", with_ctes("""
select country, country_code, year, co2, gdp, population from panel_co2 where year between 1996 and 2001""",
                                           "panel_co2"))
def q_bronze_co2_from_csv(spark, d):
    """C6 emissions: wide CSV with raw names -> bronze chain -> gate -> partitioned write -> read back."""
    from tidepanel.plans import bronze

    landing, out = scratch_dir(spark, "co2_landing"), scratch_dir(spark, "co2_bronze")
    p = panels.panel_co2(spark, d)
    nk = F.substring(F.col("country_code"), 2, 10).cast("int")
    raw = p.select(F.when(nk % 4 == 0, F.concat(F.col("country"), F.lit(" (Rep.)"))).otherwise(F.col("country"))
                   .alias("country"), F.lit("XXX").alias("iso_code"), "year", "co2", "gdp", "population",
                   F.lit("").alias("notes"))
    raw.write.mode("overwrite").option("header", "true").csv(landing)
    codes = panels.nation_codes(spark, d)
    df = bronze.co2_from_wide(readers.read_csv_wide(spark, landing), panels.reporter_aliases(),
                              codes.select("country"), codes, 1996, 2001)
    bronze.land(df, "co2_emissions", out)
    return readers.read_partitioned(spark, out).select(*CO2_COLS)


@register("bronze_tourism_from_json", with_ctes("""
select country, country_code, year, tourist_arrivals, tourism_receipts_usd, tourist_departures
from panel_tourism""", "panel_tourism"))
def q_bronze_tourism_from_json(spark, d):
    """C6 tourism: three nested-JSON indicators -> flat -> full-outer assembly (J1) -> write -> read back."""
    from tidepanel.plans import bronze

    p = panels.panel_tourism(spark, d)
    dim = panels.dim_country(spark, d)
    members = panels.nation_codes(spark, d).select("country")
    frames = []
    for col, ind in (("tourist_arrivals", "ST.INT.ARVL"), ("tourism_receipts_usd", "ST.INT.RCPT.CD"),
                     ("tourist_departures", "ST.INT.DPRT")):
        path = scratch_dir(spark, f"wb_{ind}")
        p.join(dim, "country_code").select(
            F.struct(F.lit(ind).alias("id"), F.lit(col).alias("value")).alias("indicator"),
            F.struct(F.col("country_code_iso2").alias("id"), F.col("country").alias("value")).alias("country"),
            F.col("country_code").alias("countryiso3code"), F.col("year").cast("string").alias("date"),
            F.col(col).alias("value")).write.mode("overwrite").json(path)
        frames.append(readers.read_json_indicator(spark, path, col, members))
    out = scratch_dir(spark, "tourism_bronze")
    bronze.land(bronze.tourism_from_indicators(frames), "tourism_arrivals", out)
    return readers.read_partitioned(spark, out).select("country", "country_code", "year", "tourist_arrivals",
                                                       "tourism_receipts_usd", "tourist_departures")


@register("read_json_pages", with_ctes("""
select country, country_code, year, tourist_arrivals from panel_tourism where year between 1996 and 2001""",
                                       "panel_tourism"))
def q_read_json_pages(spark, d):
    """IO6 raw layout: API pages [metadata, [records]] (one page per year, one per line) -> flat rows."""
    recs = _indicator_records(spark, d)
    page = recs.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct(*recs.columns)).alias("r"))
    text = page.select(F.concat(F.lit("["), F.to_json(F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"),
                                                                F.col("n").alias("per_page"), F.col("n").alias("total"))),
                                F.lit(","), F.to_json(F.col("r")), F.lit("]")).alias("value"))
    path = scratch_dir(spark, "wb_pages")
    text.write.mode("overwrite").text(path)
    members = panels.nation_codes(spark, d).select("country")
    return readers.read_json_indicator(spark, path, "tourist_arrivals", members, 1996, 2001, layout="pages")
