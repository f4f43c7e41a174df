"""Per-operator behaviour of the silver layer, on made-up islands whose values follow from their number and year."""

import itertools

import pytest
from pyspark.sql import functions as F

from tidepanel.functions.categorize import dominant_category
from tidepanel.functions.numeric import np_round, row_sum_min_count, safe_ratio
from tidepanel.operators.assemble import pivot_modes, total_if_missing
from tidepanel.operators.clean import READ_ORDER, apply_schema, dedup_first, drop_empty_rows, flag_duplicates
from tidepanel.operators.fill import forward_fill, interpolate_linear
from tidepanel.operators.growth import pct_change
from tidepanel.plans import silver
from tidepanel.spec import CO2_SPEC, PanelKey

KEY = ["country_code", "year"]
ISLANDS = ("Hollin", "Marsk", "Tove")
EMISSIONS = "country string, country_code string, year bigint, co2 double, gdp double, population double"


def island(k, t):
    """(name, code, year, emissions, product, people) of island ``k`` in the ``t``-th year."""
    return ISLANDS[k], f"I{k}", 1950 + t, 10.0 * (k + 1) + t, 1e9 * (k + 1) * (1 + t / 8), 1000.0 * (k + 2)


@pytest.fixture
def emissions(spark):
    return spark.createDataFrame([island(k, t) for k in range(3) for t in range(4)], EMISSIONS)


def column(df, name, order="year"):
    return [r[name] for r in df.orderBy(order).collect()]


def line(spark, values, first=1950):
    return spark.createDataFrame([("I7", first + i, v) for i, v in enumerate(values)], "country_code string, year bigint, v double")


def test_typing_cleans_names_codes_and_numbers(spark):
    messy = "country string, country_code string, year string, co2 string, gdp string, population string"
    rows = [(f"\t{n} ", f" i{k}  ", f"{1950 + k}{'.0' * (k % 2)}", f"{k}.25", "about 3" if k else "3e2", None) for k, n in enumerate(ISLANDS)]
    got = apply_schema(spark.createDataFrame(rows, messy), CO2_SPEC).orderBy("year").collect()
    assert [tuple(r) for r in got] == [(n, f"I{k}", 1950 + k, k + 0.25, None if k else 300.0, None) for k, n in enumerate(ISLANDS)]


@pytest.mark.parametrize("year", [None, "197O", "1970.5", ""])
def test_rows_without_a_year_fail_or_go(spark, year):
    df = spark.createDataFrame([("Hollin", "I0", year, 1.0), ("Marsk", "I1", "1970", 2.0)], "country string, country_code string, year string, co2 double")
    with pytest.raises(Exception, match="non-integer year"):
        apply_schema(df, CO2_SPEC).collect()
    assert column(apply_schema(df, CO2_SPEC, on_null_period="drop"), "country_code") == ["I1"]
    assert sorted(column(apply_schema(df, CO2_SPEC, on_null_period="keep"), "country_code")) == ["I0", "I1"]


@pytest.mark.parametrize("lost", ["country", "year", "co2"])
def test_a_lost_required_column_is_named(emissions, lost):
    with pytest.raises(ValueError, match=f"missing required.*{lost}"):
        apply_schema(emissions.drop(lost), CO2_SPEC)


def test_of_repeated_keys_the_first_in_order_stays(emissions):
    copies = [emissions.withColumns({"turn": F.lit(i), "co2": F.col("co2") + 1000 * i}) for i in (2, 0, 1)]
    every = copies[0].unionByName(copies[1]).unionByName(copies[2]).repartition(5)
    first, last = dedup_first(every, KEY, "turn"), dedup_first(every.withColumn("turn", -F.col("turn")), KEY, "turn")
    assert sorted(map(tuple, first.drop("turn").collect())) == sorted(map(tuple, emissions.collect())) and first.columns == every.columns
    assert all(r.co2 > 2000 for r in last.collect()) and last.count() == 12
    assert sorted(dedup_first(every, KEY, ["co2"]).collect()) == sorted(dedup_first(every.repartition(2), KEY, ["co2"]).collect())


def test_of_repeated_keys_the_first_read_stays(spark, tmp_path):
    landed = [(f"I{i % 2}", 1950, float(100 - i)) for i in range(9)]
    spark.createDataFrame(landed, "country_code string, year bigint, co2 double").coalesce(1).write.parquet(str(tmp_path / "d"))
    got = dedup_first(spark.read.parquet(str(tmp_path / "d")), KEY, order_by=READ_ORDER)
    assert sorted(map(tuple, got.collect())) == [("I0", 1950, 100.0), ("I1", 1950, 99.0)]


def test_flags_mark_all_rows_of_a_repeated_key(spark):
    keys = [(c, y) for c, y, n in [("I0", 1950, 1), ("I0", 1951, 3), ("I1", 1950, 2), (None, 1950, 2), (None, None, 1)] for _ in range(n)]
    got = flag_duplicates(spark.createDataFrame(keys, "country_code string, year bigint"), KEY).collect()
    assert all(r.is_duplicate == (keys.count((r.country_code, r.year)) > 1) for r in got) and len(got) == len(keys)


@pytest.mark.parametrize("cols,left", [(["a", "b"], 3), (["a"], 2), (["b", "absent"], 2), (["absent"], 4), ([], 4)])
def test_rows_empty_in_all_named_columns_go(spark, cols, left):
    df = spark.createDataFrame(list(itertools.product([1.0, None], repeat=2)), "a double, b double")
    assert drop_empty_rows(df, cols).count() == left


GAPS = [[None, None, 6.0, None, None, 12.0, None], [1.0], [None], [5.0, None], [None, 5.0], [0.0, None, None, None, -8.0], [3.0, 1.0, 2.0]]


def plain_forward(values):
    out = []
    for v in values:
        out.append(v if v is not None else out[-1] if out else None)
    return out


def plain_between(values, extrapolate):
    known = [i for i, v in enumerate(values) if v is not None]
    out = list(values)
    for i in range(len(values)):
        before, after = [k for k in known if k < i], [k for k in known if k > i]
        if out[i] is None and before:
            if after:
                a, b = before[-1], after[0]
                out[i] = values[a] + (values[b] - values[a]) / (b - a) * (i - a)
            elif extrapolate:
                out[i] = values[before[-1]]
    return out


@pytest.mark.parametrize("values", GAPS)
def test_gaps_against_plain_python(spark, values):
    df = line(spark, values)
    assert column(forward_fill(df, ["v"]), "v") == plain_forward(values)
    for extrapolate in (True, False):
        assert column(interpolate_linear(df, ["v"], extrapolate=extrapolate), "v") == pytest.approx(plain_between(values, extrapolate))


def test_places_and_periods_differ_where_years_are_missing(spark):
    df = spark.createDataFrame([("I1", y, v) for y, v in ((1900, 8.0), (1901, None), (1904, None), (1908, 0.0))], "country_code string, year bigint, v double")
    assert column(interpolate_linear(df, ["v"]), "v") == pytest.approx([8.0, 16 / 3, 8 / 3, 0.0])
    assert column(interpolate_linear(df, ["v"], mode="time"), "v") == [8.0, 7.0, 4.0, 0.0]


def test_another_key(spark):
    df = spark.createDataFrame([(e, q, float(q) if q % 3 == 0 else None) for e in (4, 9) for q in range(7)], "shop bigint, quarter bigint, v double")
    got = interpolate_linear(df, ["v"], PanelKey(("shop",), "quarter")).collect()
    assert all(r.v == r.quarter for r in got) and len(got) == 14


@pytest.mark.parametrize("values", [*GAPS, [4.0, 5.0, None, 0.0, None, 3.0, 6.0]])
def test_growth_against_plain_python(spark, values):
    def grown(xs):
        return [None if i == 0 or x is None or not xs[i - 1] else round((x / xs[i - 1] - 1) * 100, 2) for i, x in enumerate(xs)]

    assert column(pct_change(line(spark, values), "v", "g"), "g") == pytest.approx(grown(plain_forward(values)))
    assert column(pct_change(line(spark, values), "v", "g", fill="none"), "g") == pytest.approx(grown(values))


def test_np_round_half_even_on_scaled_double(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.5,), (-8.888888,)], "x double")
    got = [r[0] for r in df.select(np_round("x", 2)).collect()]
    assert got == [0.12, 0.14, 2.5, -8.89]
    assert [r[0] for r in df.select(np_round("x", 0)).collect()][2] == 2.0


def test_safe_ratio_zero_and_null_denominator(spark):
    df = spark.createDataFrame([(7.0, 0.0), (7.0, None), (7.0, 2.0), (None, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(safe_ratio("n", "d", 1.0, 2)).collect()]
    assert got == [None, None, 3.5, None]


def test_silver_emissions_derive_from_their_columns(emissions):
    got = silver.silver_co2(emissions, "year")
    assert got.columns[:3] == ["country", "country_code", "year"] and got.count() == 12
    for r in got.collect():
        _, _, _, co2, gdp, people = island(int(r.country_code[1]), r.year - 1950)
        assert r.co2_per_capita_calc == pytest.approx(co2 * 1e6 / people, abs=1e-4) and r.gdp_per_capita == pytest.approx(gdp / people, abs=1e-2)
        t = r.year - 1950
        assert (r.gdp_growth_pct is None) if t == 0 else r.gdp_growth_pct == pytest.approx(100 / (7 + t), abs=5e-3)


def test_silver_emissions_without_values_or_people(spark):
    rows = [("Hollin", "I0", 1950, None, None, None), ("Marsk", "I1", 1950, 2.0, 0.0, 0.0), ("Tove", "I2", 1950, None, 3.0, None)]
    got = {r.country_code: r for r in silver.silver_co2(spark.createDataFrame(rows, EMISSIONS), "year").collect()}
    assert set(got) == {"I1", "I2"}
    assert all(got[c][m] is None for c in got for m in ("co2_per_capita_calc", "gdp_per_capita")) and got["I1"].co2_intensity_gdp is None


def test_silver_tourism_grows_by_row_and_drops_unknown_arrivals(spark):
    rows = [("Hollin", "I0", 1950 + t, a, 300.0 * (t + 1), None) for t, a in enumerate([600.0, 900.0, None, 0.0, 45.0])]
    df = spark.createDataFrame(rows, "country string, country_code string, year bigint, tourist_arrivals double, tourism_receipts_usd double, tourist_departures double")
    got = silver.silver_tourism(df, "year").orderBy("year").collect()
    assert [(r.year, r.arrivals_growth_pct) for r in got] == [(1950, None), (1951, 50.0), (1953, -100.0), (1954, None)]
    assert [r.receipts_per_tourist for r in got] == [0.5, 0.67, None, 33.33]


WAYS = [((8.0, 1.0, 1.0, None), (10.0, 80.0, "air")), ((2.0, 5.0, 5.0, None), (12.0, 16.67, "sea")), ((None, None, 6.0, None), (6.0, None, "land")),
        ((0.0, 0.0, 0.0, None), (0.0, None, None)), ((3.0, None, None, 12.0), (12.0, 25.0, "air")), ((None, None, None, None), None)]


def test_silver_transport_totals_shares_and_the_main_way(spark):
    rows = [("Tove", "I2", 1950 + i, *given) for i, (given, _) in enumerate(WAYS)]
    df = spark.createDataFrame(rows, "country string, country_code string, year bigint, tourists_air double, tourists_sea double, tourists_land double, tourists_total double")
    got = {r.year - 1950: (r.tourists_total, r.pct_air, r.dominant_transport) for r in silver.silver_transport(df, "year").collect()}
    assert got == {i: want for i, (_, want) in enumerate(WAYS) if want}


def test_the_main_way_is_the_first_of_the_largest(spark):
    cells = list(itertools.product([None, 1.0, 2.0], repeat=3))
    got = spark.createDataFrame(cells, "x double, y double, z double").select("*", dominant_category({"ex": "x", "wye": "y", "zed": "z"}).alias("main")).collect()
    for r in got:
        known = {n: r[c] for n, c in (("ex", "x"), ("wye", "y"), ("zed", "z")) if r[c] is not None}
        assert r.main == (max(known, key=known.get) if known else None)


def test_sums_over_rows_need_one_value(spark):
    cells = list(itertools.product([None, 4.0], [None, 0.5], [None, 9.0]))
    df = spark.createDataFrame(cells, "a double, b double, t double")
    want = [None if a is None and b is None else (a or 0.0) + (b or 0.0) for a, b, _ in cells]
    assert [r[0] for r in df.select(row_sum_min_count(["a", "b"])).collect()] == want
    assert [r.t for r in total_if_missing(df, "t", ["a", "b"]).collect()] == [w if t is None else t for w, (_, _, t) in zip(want, cells)]


def test_a_pivoted_cell_without_values_is_zero_and_one_without_rows_is_null(spark):
    rows = [("I0", 1950, "sea", 2.0), ("I0", 1950, "sea", 5.0), ("I0", 1950, "land", None), ("I1", 1950, "air", 1.0)]
    df = spark.createDataFrame(rows, "country_code string, year bigint, mode string, v double")
    got = pivot_modes(df, KEY, "mode", "v", ["air", "sea", "land"], prefix="by_").orderBy("country_code").collect()
    assert [(r.by_air, r.by_sea, r.by_land) for r in got] == [(None, 7.0, 0.0), (1.0, None, None)]


def test_to_numeric_nan_is_missing(spark):
    from tidepanel.functions.numeric import to_numeric
    df = spark.createDataFrame([("NaN",), ("nan",), ("1.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(to_numeric("v")).collect()] == [None, None, 1.5, None, None]
    d = spark.createDataFrame([(float("nan"),), (2.0,)], "v double")
    assert [r[0] for r in d.select(to_numeric("v")).collect()] == [None, 2.0]


def test_long_entities_are_filled_span_by_span_alike(spark):
    import random

    from tidepanel.operators.fill import interpolate_long
    from tidepanel.spec import PanelKey

    rng = random.Random(8)
    rows = [(e, t, rng.random() if rng.random() < 0.3 else None, float(t) if t == 500 else None) for e in ("a", "b", None) for t in sorted(rng.sample(range(1000), 300))]
    df = spark.createDataFrame(rows, "e string, t long, v double, w double").repartition(5)
    key = PanelKey(("e",), "t")
    for extrapolate in (True, False):
        want = {(r.e, r.t): (r.v, r.w) for r in interpolate_linear(df, ["v", "w"], key, mode="time", extrapolate=extrapolate).collect()}
        for span in (7, 100, 5000):
            got = {(r.e, r.t): (r.v, r.w) for r in interpolate_long(df, ["v", "w"], span, key, extrapolate).collect()}
            assert got == want


def test_interpolation_time_is_linear_in_an_entitys_rows(spark):
    import time

    def seconds(n):
        df = spark.range(n).selectExpr("'one' as country_code", "id as year", "case when id % 1000 = 0 then id * 1.0 end as v")
        start = time.time()
        interpolate_linear(df, ["v"]).write.format("noop").mode("overwrite").save()
        return time.time() - start

    seconds(1000)
    assert seconds(160_000) < 12 * max(1.0, seconds(20_000))  # a quadratic plan takes 64 times as long


def test_sorted_output_has_nulls_last(spark):
    from tidepanel.plans.queries_ops import q_api_q3, q_sort_key

    codes = [(r.country_code, r.year) for r in q_sort_key(spark, "/root/testdata/sf0.001").collect()]
    assert codes == sorted(codes)
    values = [r.co2_per_capita_calc for r in q_api_q3(spark, "/root/testdata/sf0.001").collect()]
    assert values == sorted(values, reverse=True)
    from tidepanel.operators.rank import top_k
    df = spark.createDataFrame([("a", None), ("b", 2.0), ("c", 5.0), ("d", None), ("e", 2.0)], "k string, v double")
    assert [r.k for r in top_k(df, "v", 5, ["k"]).collect()] == ["c", "b", "e", "a", "d"]
