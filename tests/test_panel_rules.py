"""The rules of the silver, gold and check layers on small generated panels."""

import math

import pytest
from pyspark.sql import functions as F

from tidepanel.operators.assemble import outer_assemble, total_if_missing
from tidepanel.operators.clean import apply_schema, dedup_first, drop_empty_rows
from tidepanel.operators.fill import fill_gaps
from tidepanel.operators.quality import enforce_gate, ingest_gate, quality_report, run_suite, suite_report
from tidepanel.plans import gold, queries_ops, silver
from tidepanel.spec import CO2_SPEC, PanelKey

KEY = ["country_code", "year"]
EMISSIONS = "country string, country_code string, year bigint, co2 double, gdp double, population double"
ARRIVALS = "country string, country_code string, year bigint, tourist_arrivals double, tourism_receipts_usd double, tourist_departures double"
MODES = "country string, country_code string, year bigint, tourists_air double, tourists_sea double, tourists_land double, tourists_total double"


def emission(k, y):
    """Values of entity k in year y, by a rule of their own."""
    return 3.0 * k + y % 7, 1e9 * (k + 2) * (1 + (y - 2000) / 16), 1e5 * (k + 1) + 250 * (y - 2000)


@pytest.fixture
def emissions(spark):
    return spark.createDataFrame([(f" Isle {k} ", f"q{k}", y, *emission(k, y)) for k in range(3) for y in range(2001, 2005)], EMISSIONS)


def by_key(df):
    return {(r.country_code, r.year): r for r in df.collect()}


def blank(df, code, year, *cols):
    return df.withColumns({c: F.when((F.col("country_code") == code) & (F.col("year") == year), None).otherwise(F.col(c)) for c in cols})


def test_keys_are_typed_trimmed_and_upper(emissions):
    out = apply_schema(emissions.withColumn("year", F.concat(F.col("year").cast("string"), F.lit(".0"))), CO2_SPEC)
    assert dict(out.dtypes)["year"] == "bigint" and {r.country_code for r in out.collect()} == {"Q0", "Q1", "Q2"}
    assert {r.country for r in out.collect()} == {"Isle 0", "Isle 1", "Isle 2"}


def test_first_landed_row_wins_also_over_an_empty_one(emissions):
    landed = emissions.withColumn("o", F.lit(5)).unionByName(emissions.where("country_code = 'q1'").withColumn("co2", F.lit(-1.0)).withColumn("o", F.lit(6)))
    landed = landed.unionByName(emissions.withColumns({c: F.lit(None).cast("double") for c in ("co2", "gdp", "population")}).withColumn("o", F.lit(7)))
    first = dedup_first(landed, KEY, "o")
    assert first.count() == 12 and by_key(first)["q1", 2002].co2 == emission(1, 2002)[0]
    assert by_key(silver.silver_co2(landed, "o"))["Q2", 2003].co2 == emission(2, 2003)[0]
    assert "o" not in silver.silver_co2(landed, "o").columns


def test_a_row_goes_only_when_all_measures_are_missing(emissions):
    cols = ["co2", "gdp", "population"]
    assert drop_empty_rows(blank(emissions, "q0", 2001, *cols), cols).count() == 11
    assert drop_empty_rows(blank(emissions, "q0", 2001, "co2", "gdp"), cols).count() == 12


def test_gaps(spark):
    rows = [("E", p, v) for p, v in enumerate([None, 8.0, None, None, 14.0, None])]
    df = spark.createDataFrame(rows, "country_code string, year bigint, v double")
    key = PanelKey(("country_code",), "year")
    assert [r.v for r in fill_gaps(df, fill_forward=["v"], key=key).orderBy("year").collect()] == [None, 8, 8, 8, 14, 14]
    assert [r.v for r in fill_gaps(df, interpolate=["v"], key=key).orderBy("year").collect()] == [None, 8, 10, 12, 14, 14]


def test_emission_ratios_and_growth(emissions):
    out = by_key(silver.silver_co2(emissions, "year"))
    for k in range(3):
        for y in range(2001, 2005):
            co2, gdp, people = emission(k, y)
            r = out[f"Q{k}", y]
            assert r.co2_per_capita_calc == pytest.approx(co2 * 1e6 / people, abs=1e-4) and r.gdp_per_capita == pytest.approx(gdp / people, abs=0.01)
            if y > 2001:
                assert r.gdp_growth_pct == pytest.approx((gdp / emission(k, y - 1)[1] - 1) * 100, abs=0.01)
            else:
                assert r.gdp_growth_pct is None


def test_no_ratio_over_zero_or_nothing(spark):
    df = spark.createDataFrame([("A", "A", 1, 4.0, 0.0, 0.0), ("B", "B", 1, 4.0, None, None)], EMISSIONS)
    assert all(r.co2_per_capita_calc is None and r.co2_intensity_gdp is None for r in silver.silver_co2(df, "year").collect())
    df = spark.createDataFrame([("A", "A", 1, 0.0, 9.0, None), ("B", "B", 1, None, None, None)], ARRIVALS)
    assert [(r.country_code, r.receipts_per_tourist) for r in silver.silver_tourism(df, "year").collect()] == [("A", None)]


def test_arrival_growth_and_receipts(spark):
    df = spark.createDataFrame([("A", "A", 1, 50.0, 600.0, None), ("A", "A", 2, 80.0, 1000.0, None), ("A", "A", 3, 60.0, 90.0, None)], ARRIVALS)
    out = by_key(silver.silver_tourism(df, "year"))
    assert [out["A", y].arrivals_growth_pct for y in (1, 2, 3)] == [None, 60.0, -25.0]
    assert [out["A", y].receipts_per_tourist for y in (1, 2, 3)] == [12.0, 12.5, 1.5]


def test_mode_totals_shares_and_dominant(spark):
    df = spark.createDataFrame([("A", "A", 1, 30.0, 50.0, 20.0, None), ("A", "A", 2, None, None, None, None), ("B", "B", 1, 1.0, 1.0, 6.0, 16.0), ("C", "C", 1, 0.0, 0.0, 0.0, 0.0)], MODES)
    out = by_key(silver.mode_shares(total_if_missing(df, "tourists_total", ["tourists_air", "tourists_sea", "tourists_land"])))
    assert (out["A", 1].tourists_total, out["A", 1].pct_sea, out["A", 1].dominant_transport) == (100.0, 50.0, "sea")
    assert (out["B", 1].pct_land, out["B", 1].dominant_transport) == (37.5, "land")
    assert out["A", 2].dominant_transport is None and out["C", 1].pct_air is None


def test_quality_report(emissions):
    after = blank(emissions.where("not (country_code = 'q2' and year > 2002)"), "q0", 2001, "co2")
    r = quality_report(emissions, after, "panel", {"co2": 5.0}, ["q0", "q9"], 2001, 2005).collect()[0]
    assert (r.rows_before, r.rows_after, r.rows_dropped, r.entities_covered) == (12, 10, 2, 3)
    assert r.members_covered == "q0,q1,q2" and r.missing_members == "q9" and r.missing_periods == "2005" and r.periods_covered == "2001,2002,2003,2004"
    assert "co2" in r.quality_flags and "10.0" in r.quality_flags
    assert quality_report(emissions, emissions, "panel", {"co2": 5.0}).collect()[0].quality_flags == "OK - no alerts"


@pytest.fixture
def gold_inputs(spark, emissions):
    tour = spark.createDataFrame([("", f"q{k}", y, 1e4 * (k + 1) * (y - 1999), 1e6, None) for k in range(3) for y in range(2001, 2004)], ARRIVALS)
    modes = spark.createDataFrame([("", f"q{k}", y, 6.0, 3.0, 1.0, None) for k in range(3) for y in range(2001, 2005)], MODES)
    return silver.silver_co2(emissions, "year"), silver.silver_tourism(tour, "year"), silver.silver_transport(modes, "year")


def test_fact_rows_ratio_and_order(gold_inputs):
    fact = gold.gold_fact(*gold_inputs)
    out = by_key(fact)
    assert len(out) == fact.count() == 12
    for k in range(3):
        assert out[f"Q{k}", 2003].co2_per_tourist == pytest.approx(emission(k, 2003)[0] * 1e6 / (4e4 * (k + 1)), abs=1e-3)
        assert out[f"Q{k}", 2004].co2_per_tourist is None and out[f"Q{k}", 2004].dominant_transport == "air"
    assert [(r.country_code, r.year) for r in gold.sort_fact(fact).collect()] == sorted(out)


def test_fact_labels_follow_the_two_growth_rates(gold_inputs):
    labels = {}
    for r in gold.gold_fact(*gold_inputs).collect():
        if r.gdp_growth_pct is not None and r.co2_growth_pct is not None:
            labels.setdefault((r.gdp_growth_pct > 0, r.co2_growth_pct > 0), set()).add(r.sustainability_label)
    assert labels and all(len(v) == 1 for v in labels.values()) and len(set(map(frozenset, labels.values()))) == len(labels)


def test_fact_without_tourism(gold_inputs):
    co2, tour, modes = gold_inputs
    fact = gold.gold_fact(co2, tour.limit(0), modes)
    assert fact.count() == 12 and fact.where("co2_per_tourist is not null").count() == 0


def test_repeated_keys_fail_or_join(spark):
    a = spark.createDataFrame([("k", 1, 10.0, 1.0), ("k", 1, 5.0, 9.0), ("m", 1, 2.0, 2.0)], "country_code string, year bigint, v double, w double")
    b = spark.createDataFrame([("k", 1, 7.0)], "country_code string, year bigint, z double")
    with pytest.raises(Exception, match="several rows"):
        outer_assemble([a, b], KEY).collect()
    with pytest.raises(Exception, match="several rows"):
        outer_assemble([a, b], KEY).select("country_code").collect()
    assert sorted((r.v, r.w, r.z) for r in outer_assemble([a, b], KEY, "join").where("country_code = 'k'").collect()) == [(5.0, 9.0, 7.0), (10.0, 1.0, 7.0)]
    assert outer_assemble([a.dropDuplicates(["country_code"]), b], KEY).count() == 2


def test_gate_of_missing_and_empty(emissions):
    gate = ingest_gate(blank(emissions, "q0", 2001, "co2"), {"co2": 10.0, "gdp": 0.0, "absent": 50.0})
    assert {r.column: r.ok for r in gate.collect()} == {"__rows": True, "co2": True, "gdp": True, "absent": False}
    with pytest.raises(ValueError, match="absent"):
        enforce_gate(gate)
    assert not any(r.ok for r in ingest_gate(emissions.limit(0), {"co2": 10.0}).collect())
    enforce_gate(ingest_gate(emissions, {"co2": 0.0}))


def one(df, **check):
    return run_suite(df, [check], "panel", "silver").collect()[0]


def test_each_check_and_its_reason(emissions):
    gap = blank(emissions, "q0", 2001, "co2")
    for check, reason in [
            (dict(type="table_row_count", expected_value=12), None), (dict(type="table_row_count", expected_value=9), "Expected 9 rows, got 12"),
            (dict(type="table_row_count", min_value=3), None), (dict(type="table_row_count", min_value=40), "Expected min 40 rows, got 12"),
            (dict(type="column_count", expected_value=6), None), (dict(type="column_count", expected_value=2), "Expected 2 cols, got 6"),
            (dict(type="column_values_to_not_be_null", column="gdp"), None), (dict(type="column_values_to_not_be_null", column="co2"), "1 nulls (8.3%) exceeds threshold 0.0%"),
            (dict(type="column_values_to_not_be_null", column="co2", threshold_pct=9.0), None), (dict(type="column_values_to_not_be_null", column="zz"), "Column 'zz' not found"),
            (dict(type="no_duplicates", columns=KEY), None), (dict(type="no_duplicates", columns=["year"]), "12 duplicate rows found"),
            (dict(type="column_values_in_set", column="country_code", value_set=["q0", "q1", "q2"]), None),
            (dict(type="column_values_in_set", column="country_code", value_set=["q0"]), "Invalid values: ['q1', 'q2']"),
            (dict(type="column_values_to_be_between", column="co2", min_value=0, max_value=99), None),
            (dict(type="column_values_to_be_between", column="year", min_value=2002, max_value=2004), "3 values outside [2002, 2004]"),
            (dict(type="column_values_type", column="country_code", expected_type="float"), "12 values not parseable as float"), (dict(type="magic"), "Unknown check type")]:
        r = one(gap, **check)
        assert (r.ok, r.reason) == (reason is None, reason)


def test_suite_summary(emissions):
    checks = [dict(type="table_row_count", expected_value=12), dict(type="column_values_to_not_be_null", column="co2"), dict(type="no_duplicates", columns=["country_code"])]
    r = suite_report(emissions, checks, "panel", "silver").collect()[0]
    assert (r.total_checks, r.passed, r.failed, r.n_rows, r.n_cols) == (3, 2, 1, 12, 6) and "1/3" in r.summary
    assert suite_report(emissions, checks[:2], "panel", "silver").collect()[0].summary == "2/2 checks OK"


def test_questions_outside_the_usual(spark, gold_inputs):
    fact = gold.gold_fact(*gold_inputs).withColumn("country_name", F.col("country"))
    grown = {r.country_code: r.arrivals_growth_pct for r in queries_ops.yoy_growth(fact.drop("arrivals_growth_pct"), 2002).collect()}
    assert grown == {f"Q{k}": pytest.approx(50.0) for k in range(3)}
    with pytest.raises(Exception, match="two years"):
        queries_ops.emission_reduction(fact.where("year = 2001"), fact.where("year = 2001")).collect()
    # 2004 has no arrivals: the latest year that has both
    assert {r.year for r in queries_ops.arrivals_vs_co2(fact).collect()} <= {2003} and not math.isnan(fact.count())


def test_landed_sheets_keep_and_flag_repeated_keys(spark):
    from tidepanel.plans import bronze

    key = "country string, country_code string, year bigint, "
    a = spark.createDataFrame([("Isle", "Q0", 2001, 4.0), ("Isle", "Q0", 2001, 5.0), ("Rock", "Q1", 2001, 6.0)], key + "tourist_arrivals double")
    b = spark.createDataFrame([("Isle", "Q0", 2001, 7.0), ("Rock", "Q1", 2030, 8.0)], key + "tourism_receipts_usd double")
    out = bronze.tourism_from_indicators([a, b])
    assert sorted((r.country_code, r.year, r.tourist_arrivals or 0, r.is_duplicate) for r in out.collect()) == [
        ("Q0", 2001, 4.0, True), ("Q0", 2001, 5.0, True), ("Q1", 2001, 6.0, False), ("Q1", 2030, 0, False)]
    with pytest.raises(ValueError, match="tourist_arrivals"):
        bronze.land(out.drop("tourist_arrivals"), "tourism_arrivals", "/nowhere")
    sheet = spark.createDataFrame([("Isle", "2001.0", "Inbound by air", "3"), ("Isle", "2044", "Inbound by land", "1"), ("Isle", "x", "Inbound by air", "9")],
                                  "reporter_area_label string, year string, indicator_label string, value string")
    wide = bronze.transport_from_sheet(sheet, {}, ["Isle"], {"Isle": "Q0"})
    assert sorted((r.year, r.tourists_total, r.is_duplicate) for r in wide.collect()) == [(2001, 3.0, False), (2044, 1.0, False)]
    assert [r.year for r in bronze.transport_from_sheet(sheet, {}, ["Isle"], {"Isle": "Q0"}, end=2010).collect()] == [2001]
