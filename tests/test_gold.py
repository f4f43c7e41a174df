"""Gold fact and dimension: columns, keys, labels, joins."""

import pytest

from tidepanel.operators.assemble import fact_with_dim, outer_assemble
from tidepanel.plans import gold, panels
from tidepanel.functions.categorize import quadrant_label

CO2 = ("country string, country_code string, year bigint, co2 double, co2_per_capita_calc double, "
       "co2_intensity_gdp double, gdp double, gdp_per_capita double, gdp_growth_pct double, population double")
TOUR = ("country string, country_code string, year bigint, tourist_arrivals double, tourism_receipts_usd double, "
        "tourist_departures double, arrivals_growth_pct double, receipts_per_tourist double")
TR = ("country string, country_code string, year bigint, tourists_air double, tourists_sea double, "
      "tourists_land double, tourists_total double, pct_air double, pct_sea double, pct_land double, "
      "dominant_transport string")


@pytest.fixture
def silvers(spark):
    """Two islands in the emissions; the first has tourists too, as has a third that the emissions do not know."""
    def emitted(k, t, growth):
        return f"Isle {k}", f"I{k}", 1960 + t, 12.0 * (k + 1) - 2 * t, 0.5, 0.1, 8e6 * (t + 1), 300.0, growth, 9000.0

    def visited(k, t, growth):
        return f"Isle {k}", f"I{k}", 1960 + t, 3000.0 * (t + 1), 6e5, None, growth, 200.0

    co2 = spark.createDataFrame([emitted(0, 0, None), emitted(0, 1, 100.0), emitted(1, 0, None)], CO2)
    tour = spark.createDataFrame([visited(0, 0, None), visited(0, 1, 100.0), visited(2, 1, None)], TOUR)
    tr = spark.createDataFrame([("Isle 0", "I0", 1960, 300.0, 2400.0, 300.0, 3000.0, 10.0, 80.0, 10.0, "sea")], TR)
    return co2, tour, tr


def test_fact_rows_keys_and_columns(silvers):
    fact = gold.gold_fact(*silvers)
    got = {(r.country_code, r.year): r for r in fact.collect()}
    assert set(got) == {("I0", 1960), ("I0", 1961), ("I1", 1960), ("I2", 1961)}
    assert fact.columns[:3] == ["country", "country_code", "year"]
    for c in ("co2_per_tourist", "co2_growth_pct", "sustainability_label", "dominant_transport"):
        assert c in fact.columns
    assert got[("I0", 1960)].co2_per_tourist == 12.0 * 1e6 / 3000.0 and got[("I0", 1961)].co2_per_tourist == pytest.approx(10e6 / 6000.0, abs=1e-4)
    assert got[("I0", 1960)].dominant_transport == "sea"
    assert got[("I2", 1961)].country is None  # only the emissions side names countries
    assert got[("I1", 1960)].tourist_arrivals is None


def test_fact_labels(silvers):
    got = {(r.country_code, r.year): r.sustainability_label for r in gold.gold_fact(*silvers).collect()}
    assert got[("I0", 1960)] == "sin_datos"
    assert got[("I0", 1961)] == "verde"  # product up, emissions down


def test_quadrant_rules(spark):
    df = spark.createDataFrame([(1.0, -1.0), (1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0), (None, 1.0), (0.0, 0.0)],
                               "g double, c double")
    assert [r[0] for r in df.select(quadrant_label("g", "c")).collect()] == \
        ["verde", "amarillo", "rojo", "gris", "sin_datos", "gris"]


def test_union_assembly_equals_join_assembly(spark, silvers):
    co2, tour, tr = silvers
    keys = ["country_code", "year"]
    slim = [co2.drop("country"), tour.drop("country"), tr.drop("country")]
    a = outer_assemble(slim, keys, "union")
    b = outer_assemble(slim, keys, "join")
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_backfill_country_from_same_code(spark):
    from tidepanel.operators.assemble import backfill_dim_attr
    df = spark.createDataFrame([("ARG", 2019, "Argentina"), ("ARG", 2020, None), ("CHL", 2020, None)],
                               "country_code string, year bigint, country string")
    got = {(r.country_code, r.year): r.country for r in backfill_dim_attr(df, "country", "country_code").collect()}
    assert got == {("ARG", 2019): "Argentina", ("ARG", 2020): "Argentina", ("CHL", 2020): None}


def test_fact_with_dim_left_join_and_suffix(spark):
    fact = spark.createDataFrame([("ARG", 2019, "x"), ("ZZZ", 2019, "y")], "country_code string, year bigint, region string")
    dim = spark.createDataFrame([("ARG", "Argentina", "South America")], "country_code string, country_name string, region string")
    out = fact_with_dim(fact, dim)
    assert out.columns == ["country_code", "year", "region", "country_name", "region_dim"]
    got = {r.country_code: r for r in out.collect()}
    assert got["ARG"].region_dim == "South America" and got["ZZZ"].country_name is None
    nokey = spark.createDataFrame([("a",)], "other string")
    assert fact_with_dim(fact, nokey).columns == fact.columns


def test_dim_invariants(spark):
    dim = panels.dim_country(spark, "/root/testdata/sf0.001")
    rows = dim.collect()
    assert len(rows) == 25 and len({r.country_code for r in rows}) == 25
    assert all(r.country_name and len(r.country_code_iso2) == 2 for r in rows)


def test_fact_parquet_round_trip(spark, silvers, tmp_path):
    fact = gold.gold_fact(*silvers)
    fact.write.parquet(str(tmp_path / "fact"))
    back = spark.read.parquet(str(tmp_path / "fact"))
    assert back.schema.simpleString() == fact.schema.simpleString()
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, fact.collect()), key=str)
