"""Entity × period panels derived from the warehouse tables.

Nation × year panels stand in for the country × year sources; part × month
and user × day panels exercise the same operators at volume.

Scale notes: the fact tables are aggregated to the join key *before* they
meet their dimension (sum/count decompose exactly), so the large join sees
one row per customer (orders) or per (supplier, year, flag) (lineitem)
instead of one per order/line.
`nation` is a 25-row dimension; Spark broadcasts it through its own size
threshold. Only the needed columns reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec_sum(c) -> F.Column:
    return F.sum(F.col(c).cast("decimal(18,2)"))


def _nation(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.col("n_name").alias("country"),
        F.replace(F.col("n_name"), F.lit("NATION_"), F.lit("N")).alias("country_code"),
    )


ORDERS_BY, ORDERS_SUMS = ["o_custkey", "y"], ["amt"]
LINES_BY, LINES_SUMS = ["l_suppkey", "y", "l_returnflag"], ["qty", "amt", "n"]


def orders_customer_agg(orders: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Orders pre-aggregated to (customer, order year); with ``by`` also per those columns."""
    return orders.groupBy(*(by or []), "o_custkey", F.year("o_orderdate").alias("y")).agg(_dec_sum("o_totalprice").alias("amt"))


def panel_co2(spark: SparkSession, sf_dir: str, orders_agg: DataFrame | None = None) -> DataFrame:
    """nation × order year: co2 = order value / 1e6, gdp = value × 10, population = distinct customers.

    Orders are aggregated per customer and year before they meet their
    customer; the plan does not depend on the years there are.
    """
    per = orders_agg if orders_agg is not None else orders_customer_agg(table(spark, sf_dir, "orders"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = per.where(F.col("y").isNotNull()).join(cust, per.o_custkey == cust.c_custkey).join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    g = j.groupBy("country", "country_code", "n_nationkey", "y").agg(
        F.sum("amt").cast("double").alias("amt"), F.count(F.lit(1)).cast("double").alias("ncust"))
    y = F.col("y")
    nk = F.col("n_nationkey")
    return g.select(
        "country", "country_code", y.cast("bigint").alias("year"),
        (F.col("amt") / F.lit(1000000.0)).alias("co2"),
        F.when((nk * 7 + y) % 6 == 0, F.lit(None)).otherwise(F.col("amt") * F.lit(10.0)).cast("double").alias("gdp"),
        F.when((nk + y) % 9 == 0, F.lit(None)).otherwise(F.col("ncust")).cast("double").alias("population"),
    )


def line_supplier_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem pre-aggregated to (supplier, ship year, return flag).

    Both supplier-side panels derive from this one aggregate (sums and counts
    decompose exactly), so a pipeline that materializes it scans lineitem once.
    """
    return lines_agg(table(spark, sf_dir, "lineitem"))


def lines_agg(lines: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``line_supplier_agg`` of these rows; with ``by`` also per those columns."""
    return lines.groupBy(*(by or []), "l_suppkey", F.year("l_shipdate").alias("y"), "l_returnflag").agg(
        F.sum("l_quantity").alias("qty"), _dec_sum("l_extendedprice").alias("amt"), F.count(F.lit(1)).alias("n"))


def _with_nation(spark, sf_dir, df):
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return df.join(sup, df.l_suppkey == sup.s_suppkey).join(_nation(spark, sf_dir),
                                                            F.col("s_nationkey") == F.col("n_nationkey"))


def panel_tourism(spark: SparkSession, sf_dir: str, line_agg: DataFrame | None = None) -> DataFrame:
    """nation (of supplier) × ship year: arrivals = quantity, receipts = value, departures = lines."""
    la = line_agg if line_agg is not None else line_supplier_agg(spark, sf_dir)
    j = _with_nation(spark, sf_dir, la)
    g = j.groupBy("country", "country_code", "n_nationkey", "y").agg(
        F.sum("qty").alias("qty"), F.sum("amt").cast("double").alias("amt"), F.sum("n").cast("double").alias("n"))
    y, nk = F.col("y"), F.col("n_nationkey")
    return g.select(
        "country", "country_code", y.cast("bigint").alias("year"),
        F.when((nk + y) % 7 == 0, F.lit(None)).otherwise(F.col("qty")).cast("double").alias("tourist_arrivals"),
        F.col("amt").alias("tourism_receipts_usd"),
        F.col("n").alias("tourist_departures"),
    )


def panel_transport_long(spark: SparkSession, sf_dir: str, line_agg: DataFrame | None = None) -> DataFrame:
    """Long sheet: nation × ship year × transport mode (A -> air, N -> sea, else land)."""
    la = line_agg if line_agg is not None else line_supplier_agg(spark, sf_dir)
    j = _with_nation(spark, sf_dir, la)
    y, nk, flag = F.col("y"), F.col("n_nationkey"), F.col("l_returnflag")
    j = j.where(~((flag == "N") & ((nk + y) % 3 == 0)))
    g = j.groupBy("country", "country_code", "n_nationkey", "y", "l_returnflag").agg(F.sum("qty").alias("value"))
    mode = F.when(flag == "A", "air").when(flag == "N", "sea").otherwise("land")
    return g.select("country", "country_code", y.cast("bigint").alias("year"),
                    mode.alias("transport_mode"), F.col("value").cast("double").alias("value"))


def long_indicator_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transport panel as a landed long sheet (reporter, year, indicator label, value).

    Like a real landed sheet it carries raw reporter spellings (every fourth
    nation as "<name> (Rep.)") and outbound rows that ingestion must skip.
    """
    p = panel_transport_long(spark, sf_dir)
    nk = F.substring(F.col("country_code"), 2, 10).cast("int")
    reporter = F.when(nk % 4 == 0, F.concat(F.col("country"), F.lit(" (Rep.)"))).otherwise(F.col("country"))
    label = (F.when(F.col("transport_mode") == "air", "Inbound arrivals by air")
             .when(F.col("transport_mode") == "sea", "Inbound arrivals by water")
             .otherwise("Inbound arrivals by land"))
    inbound = p.select(reporter.alias("reporter_area_label"), "year", label.alias("indicator_label"), "value")
    outbound = p.where(F.col("transport_mode") == "land").select(
        reporter.alias("reporter_area_label"), "year", F.lit("Outbound departures by land").alias("indicator_label"),
        "value")
    return inbound.unionByName(outbound)


def reporter_aliases() -> dict[str, str]:
    """Raw reporter spelling -> canonical nation name (rule: every fourth nation key)."""
    return {f"NATION_{k} (Rep.)": f"NATION_{k}" for k in range(0, 25, 4)}


def nation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name -> code table used by code lookups."""
    return _nation(spark, sf_dir).select("country", "country_code")


def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country dimension: nation ⋈ region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.replace(F.col("n_name"), F.lit("NATION_"), F.lit("N")).alias("country_code"),
                    F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("country_code_iso2"),
                    F.col("n_name").alias("country_name"),
                    F.col("r_name").alias("region")))


# ── large panels for volume ─────────────────────────────────────────────────
def panel_part_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part × ship month (period = yyyymm): same measures as the tourism panel."""
    li = table(spark, sf_dir, "lineitem")
    period = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("bigint")
    g = li.groupBy(F.col("l_partkey").alias("entity"), period.alias("period")).agg(
        F.sum("l_quantity").alias("qty"), _dec_sum("l_extendedprice").cast("double").alias("amt"),
        F.count(F.lit(1)).cast("double").alias("n"))
    return g.select(
        "entity", "period",
        F.when((F.col("entity") + F.col("period")) % 7 == 0, F.lit(None)).otherwise(F.col("qty")).cast("double")
        .alias("arrivals"),
        F.col("amt").alias("receipts"),
        F.col("n").alias("departures"),
    )


def panel_user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user × event day (period = yyyymmdd): event value sum and event count."""
    ev = table(spark, sf_dir, "events")
    period = F.date_format("ts", "yyyyMMdd").cast("bigint")
    g = ev.groupBy(F.col("user_id").alias("entity"), period.alias("period")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("amt"),
        F.count(F.lit(1)).cast("double").alias("n"))
    return g.select("entity", "period",
                    F.when((F.col("entity") + F.col("period")) % 5 == 0, F.lit(None)).otherwise(F.col("amt"))
                    .alias("arrivals"),
                    F.col("n").alias("departures"))
