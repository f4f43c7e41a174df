"""Invariants of the layers on the driver tables, and empty / single-row edge cases."""

import pytest
from pyspark.sql import functions as F

from tidepanel.plans import gold, layers, panels, silver

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def built(spark):
    co2 = layers.build_silver_co2(spark, SF)
    tour = layers.build_silver_tourism(spark, SF)
    tr = layers.build_silver_transport(spark, SF)
    return co2, tour, tr, gold.gold_fact(co2, tour, tr)


def test_keys_unique(built):
    for df in built:
        assert df.groupBy("country_code", "year").count().where("count > 1").count() == 0


def test_mode_shares_sum_to_100(built):
    tr = built[2]
    s = tr.where("tourists_total > 0").select((F.coalesce("pct_air", F.lit(0.0)) + F.coalesce("pct_sea", F.lit(0.0))
                                               + F.coalesce("pct_land", F.lit(0.0))).alias("s"))
    assert s.where(F.abs(F.col("s") - 100) > 0.5).count() == 0


def test_fill_never_alters_known_values(spark, built):
    raw = panels.panel_co2(spark, SF).select("country_code", "year", F.col("gdp").alias("g0"),
                                             F.col("population").alias("p0"))
    j = built[0].join(raw, ["country_code", "year"])
    assert j.where("g0 is not null and g0 <> gdp").count() == 0
    assert j.where("p0 is not null and p0 <> population").count() == 0


def test_fact_rows_equal_union_of_keys(built):
    co2, tour, tr, fact = built
    keys = co2.select("country_code", "year").union(tour.select("country_code", "year")) \
        .union(tr.select("country_code", "year")).distinct()
    assert fact.count() == keys.count()


def test_growth_never_infinite(built):
    fact = built[3]
    for c in ("gdp_growth_pct", "arrivals_growth_pct", "co2_growth_pct"):
        assert fact.where(F.col(c).isin(float("inf"), float("-inf")) | F.isnan(c)).count() == 0


def test_empty_frames_flow_through(spark):
    empty_co2 = spark.createDataFrame([], "country string, country_code string, year bigint, co2 double, "
                                          "gdp double, population double")
    empty_tour = spark.createDataFrame([], "country string, country_code string, year bigint, "
                                           "tourist_arrivals double, tourism_receipts_usd double, "
                                           "tourist_departures double")
    empty_tr = spark.createDataFrame([], "country string, country_code string, year bigint, tourists_air double, "
                                         "tourists_sea double, tourists_land double, tourists_total double")
    fact = gold.gold_fact(silver.silver_co2(empty_co2, "year"), silver.silver_tourism(empty_tour, "year"),
                          silver.silver_transport(empty_tr, "year"))
    assert fact.count() == 0 and "sustainability_label" in fact.columns


def test_single_row_panel(spark):
    one = spark.createDataFrame([("A", "AAA", 2020, 1.0, None, 5.0)], "country string, country_code string, "
                                "year bigint, co2 double, gdp double, population double")
    r = silver.silver_co2(one, "year").collect()[0]
    assert (r.gdp, r.gdp_growth_pct, r.co2_per_capita_calc) == (None, None, 200000.0)
