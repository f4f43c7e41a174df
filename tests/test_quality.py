"""Checks as data: pass/fail pairs with exact reason strings."""

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import quality
from tidepanel.operators.compare import missing_periods_by_entity
from tidepanel.operators.outliers import iqr_outliers


@pytest.fixture
def sample(spark):
    data = []
    for i, cc in enumerate(["ARG", "BRA"]):
        for y in range(2013, 2024):
            v = None if (y + i) % 3 == 0 else float(y - 2000)
            data.append((cc, y, 10.0 + y - 2013, v))
    return spark.createDataFrame(data, "country_code string, year bigint, co2 double, value double")


def _one(df, check):
    return quality.run_suite(df, [check], "ds", "silver").collect()[0]


def test_row_count(sample):
    assert _one(sample, {"type": "table_row_count", "expected_value": 22}).ok
    r = _one(sample, {"type": "table_row_count", "expected_value": 20})
    assert not r.ok and r.reason == "Expected 20 rows, got 22"
    r = _one(sample, {"type": "table_row_count", "min_value": 30})
    assert not r.ok and r.reason == "Expected min 30 rows, got 22"


def test_not_null(sample):
    assert _one(sample, {"type": "column_values_to_not_be_null", "column": "co2"}).ok
    r = _one(sample, {"type": "column_values_to_not_be_null", "column": "value"})
    assert not r.ok and r.reason == "7 nulls (31.8%) exceeds threshold 0.0%"
    assert _one(sample, {"type": "column_values_to_not_be_null", "column": "value", "threshold_pct": 40}).ok
    r = _one(sample, {"type": "column_values_to_not_be_null", "column": "nope"})
    assert not r.ok and r.reason == "Column 'nope' not found"


def test_not_null_empty_table(spark):
    empty = spark.createDataFrame([], "v double")
    assert _one(empty, {"type": "column_values_to_not_be_null", "column": "v"}).ok


def test_no_duplicates(spark, sample):
    assert _one(sample, {"type": "no_duplicates", "columns": ["country_code", "year"]}).ok
    dup = sample.unionByName(sample.where("country_code = 'ARG' and year = 2020"))
    r = _one(dup, {"type": "no_duplicates", "columns": ["country_code", "year"]})
    assert not r.ok and r.reason == "2 duplicate rows found"
    r = _one(sample, {"type": "no_duplicates", "columns": ["zz"]})
    assert not r.ok and r.reason == "Columns not found: ['zz']"


def test_in_set_counts_null_as_invalid(spark):
    df = spark.createDataFrame([("high",), ("low",), ("invalid",), (None,)], "status string")
    r = _one(df, {"type": "column_values_in_set", "column": "status", "value_set": ["high", "low"]})
    assert not r.ok and r.reason == "Invalid values: [None, 'invalid']"
    assert _one(df.where("status in ('high', 'low')"),
                {"type": "column_values_in_set", "column": "status", "value_set": ["high", "low"]}).ok


def test_between_ignores_nulls(sample):
    assert _one(sample, {"type": "column_values_to_be_between", "column": "value", "min_value": 0, "max_value": 30}).ok
    r = _one(sample, {"type": "column_values_to_be_between", "column": "co2", "min_value": 0, "max_value": 15})
    assert not r.ok and r.reason == "10 values outside [0, 15]"


def test_type_and_unknown(spark):
    df = spark.createDataFrame([("1",), ("2.5",), ("x",), (None,)], "v string")
    r = _one(df, {"type": "column_values_type", "column": "v", "expected_type": "float"})
    assert not r.ok and r.reason == "1 values not parseable as float"
    r = _one(df, {"type": "column_values_type", "column": "v", "expected_type": "int"})
    assert r.reason == "2 values not parseable as int"
    r = _one(df, {"type": "something_else"})
    assert not r.ok and r.reason == "Unknown check type"
    r = _one(df, {"type": "column_count", "expected_value": 3})
    assert not r.ok and r.reason == "Expected 3 cols, got 1"


def test_suite_and_summary(sample):
    res = quality.run_suite(sample, [{"type": "table_row_count", "expected_value": 22},
                                     {"type": "column_values_to_not_be_null", "column": "value"}], "ds", "silver")
    s = quality.suite_summary(res).collect()[0]
    assert (s.total_checks, s.passed, s.failed, s.summary) == (2, 1, 1, "⚠️ 1/2 checks FAILED")


def test_null_profile_one_pass(sample):
    prof = {r.column: r.null_pct for r in quality.null_profile(sample).collect()}
    assert prof == {"country_code": 0.0, "year": 0.0, "co2": 0.0, "value": 31.82}


def test_quality_report_flags(spark, sample):
    rep = quality.quality_report(sample.unionByName(sample.limit(3)), sample, "ds", {"value": 10.0},
                                 ["ARG", "BRA", "CHL"], 2012, 2023).collect()[0]
    assert (rep.rows_before, rep.rows_after, rep.rows_dropped) == (25, 22, 3)
    assert rep.missing_members == "CHL" and rep.missing_periods == "2012"
    assert "WARN: 'value' has 31.82% nulls (threshold: 10.0%)" in rep.quality_flags
    ok = quality.quality_report(sample, sample, "ds", {}, ["ARG"], 2013, 2023).collect()[0]
    assert ok.quality_flags == "OK - no alerts"


def test_coverage_and_missing_periods(spark, sample):
    part = sample.where("not (country_code = 'BRA' and year in (2015, 2016))")
    cov = {r.country_code: r for r in quality.coverage_report(part, 2013, 2023, ["ARG", "BRA", "CHL"]).collect()}
    assert set(cov) == {"BRA", "CHL"}
    assert cov["BRA"].missing_periods == "2015,2016" and cov["CHL"].n_rows == 0
    mp = missing_periods_by_entity(part, "country_code", 2013, 2023).collect()
    assert [(r.country_code, r.missing_periods) for r in mp] == [("BRA", [2015, 2016])]


def test_ingest_gate(spark, sample):
    g = {r.column: r.ok for r in quality.ingest_gate(sample, {"value": 30.0, "co2": 0.0}).collect()}
    assert g == {"__rows": True, "value": False, "co2": True}
    with pytest.raises(ValueError, match="value"):
        quality.enforce_gate(quality.ingest_gate(sample, {"value": 30.0}))


def test_iqr_outliers_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 100.0, None, -50.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v double")
    r = iqr_outliers(df, {"v": 1.5}, ["i"]).collect()[0]
    s = pd.Series(vals, dtype="float64")
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert r.q1 == pytest.approx(q1) and r.q3 == pytest.approx(q3)
    assert r.outliers_count == 2 and r.outlier_percentage == pytest.approx(2 / 9 * 100)
    assert (r.sample_1, r.sample_2, r.sample_3) == (100.0, -50.0, None)
    allnull = spark.createDataFrame([(1, None)], "i long, v double")
    r = iqr_outliers(allnull, {"v": 1.5}, ["i"]).collect()[0]
    assert r.outliers_count == 0 and r.outlier_percentage == 0.0


def test_frame_summary(sample):
    r = quality.frame_summary(sample).collect()[0]
    assert (r.n_rows, r.n_cols, r.total_nulls, r.n_entities, r.n_periods) == (22, 4, 7, 2, 11)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from tidepanel.operators.quantiles import exact_quantiles

    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(0, 1, 3000), np.full(2000, 5.0), rng.exponential(3, 1000)])
    rng.shuffle(vals)
    rows = [(float(v), float(i % 5), None) for i, v in enumerate(vals)] + [(None, None, None), (float("nan"), 1e9, None)]
    df = spark.createDataFrame(rows, "v double, w double, nothing double").repartition(3)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    other = np.array([r[1] for r in rows if r[1] is not None])
    for accuracy in (20, 10_000):  # wide brackets, and narrow ones
        got = exact_quantiles(df, ["v", "nothing", "w"], probs, accuracy)
        assert got["v"] == pytest.approx(list(np.quantile(vals, probs)), rel=0, abs=1e-12)
        assert got["w"] == pytest.approx(list(np.quantile(other, probs)), rel=0, abs=1e-12) and got["nothing"] == [None] * 7


def test_group_quantiles_of_hot_and_null_groups(spark):
    import numpy as np
    from tidepanel.operators.outliers import iqr_outliers_by
    from tidepanel.operators.quantiles import group_quantiles

    rng = np.random.default_rng(11)
    groups = {"hot": rng.normal(0, 1, 3000), "a": rng.normal(5, 2, 200), None: rng.normal(-3, 1, 50), "same": np.full(500, 2.0)}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("empty", None), ("empty", float("nan")), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: r for r in group_quantiles(df, ["g"], "v", [0.25, 0.6]).collect()}
    for g, xs in groups.items():
        assert (got[g].q0, got[g].q1) == pytest.approx(tuple(np.quantile(xs, [0.25, 0.6])), abs=1e-12) and got[g].n == len(xs)
    assert (got["empty"].n, got["empty"].q0) == (0, None)
    by = {r.g: r for r in iqr_outliers_by(df, "g", "v").collect()}
    for g, xs in groups.items():
        q1, q3 = np.quantile(xs, [0.25, 0.75])
        assert by[g].outliers_count == int(((xs < q1 - 1.5 * (q3 - q1)) | (xs > q3 + 1.5 * (q3 - q1))).sum())
    assert by["empty"].outliers_count == 0 and by[None].q1 is not None


def test_iqr_outliers_skip_nan(spark):
    rows = [(i, float(i) if i % 4 else float("nan")) for i in range(1000)] + [(1000, 1e6)]
    r = iqr_outliers(spark.createDataFrame(rows, "i long, a double"), {"a": 1.5}, ["i"]).collect()[0]
    assert (r.outliers_count, r.sample_1) == (1, 1e6) and 240 < r.q1 < 260


def test_iqr_outliers_approx_method_close_to_exact(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(rng.normal(0, 1, 3000))], "i long, a double")
    ex = iqr_outliers(df, {"a": 1.5}, ["i"]).collect()[0]
    ap = iqr_outliers(df, {"a": 1.5}, ["i"], method="approx").collect()[0]
    assert abs(ex.q1 - ap.q1) < 0.01 and abs(ex.q3 - ap.q3) < 0.01


def test_pct_change_zero_base_inf(spark):
    df = spark.createDataFrame([("A", 1, 0.0), ("A", 2, 5.0), ("B", 1, 0.0), ("B", 2, 0.0)],
                               "country_code string, year bigint, x double")
    from tidepanel.operators.growth import pct_change
    got = {(r.country_code, r.year): r.g for r in pct_change(df, "x", "g", zero_base="inf").collect()}
    assert got[("A", 2)] == float("inf") and got[("B", 2)] is None


def test_suite_counts_and_keys_in_one_shuffle(spark):
    rows = [("a", 1, 1.0, "x"), ("a", 1, None, "x"), (None, 1, 3.0, "y"), (None, 1, 4.0, "x"), ("b", None, 5.0, "z"), ("b", 2, 50.0, None)]
    df = spark.createDataFrame(rows, "k string, p int, v double, w string").repartition(3)
    checks = [{"type": "table_row_count", "expected_value": 6},
              {"type": "no_duplicates", "columns": ["k", "p"]},
              {"type": "column_values_to_not_be_null", "column": "k"},  # a key column: counted over all rows, not over groups
              {"type": "no_duplicates", "columns": ["p", "v"]},
              {"type": "no_duplicates", "subset": ["w"]},
              {"type": "no_duplicates", "columns": ["p", "k"]},  # the first one's columns in another order
              {"type": "column_values_to_be_between", "column": "v", "min_value": 0, "max_value": 10},
              {"type": "no_duplicates", "columns": []}]
    got = quality.run_suite(df, checks, "ds", "silver")
    assert [r.reason for r in got.collect()] == [
        None, "4 duplicate rows found", "2 nulls (33.3%) exceeds threshold 0.0%", None, "3 duplicate rows found", "4 duplicate rows found",
        "1 values outside [0, 10]", "6 duplicate rows found"]
    stats = quality._counts(df.coalesce(1), {"__rows": F.count(F.lit(1))}, {0: ["k", "p"], 1: ["w"]})
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange SinglePartition") == 1 and plan.count("Expand") == 1


def test_suite_keys_of_empty_and_clashing_tables(spark):
    checks = [{"type": "table_row_count", "min_value": 1}, {"type": "no_duplicates", "columns": ["k"]}, {"type": "no_duplicates", "columns": ["k", "v"]}]
    empty = quality.run_suite(spark.createDataFrame([], "k string, v double"), checks, "ds", "silver").collect()
    assert [(r.ok, r.reason) for r in empty] == [(False, "Expected min 1 rows, got 0"), (True, None), (True, None)]
    one = quality.run_suite(spark.createDataFrame([(None, None)], "k string, v double"), checks, "ds", "silver").collect()
    assert [r.ok for r in one] == [True, True, True]


@pytest.mark.parametrize("n_keys", [1, 2, 3])
def test_suite_keys_match_pandas(spark, n_keys):
    import itertools

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(n_keys)
    pdf = pd.DataFrame({c: rng.integers(0, 9, 60) for c in "abc"[:n_keys]})
    subsets = [list(s) for k in range(1, n_keys + 1) for s in itertools.combinations(pdf.columns, k)]
    got = quality.run_suite(spark.createDataFrame(pdf), [{"type": "no_duplicates", "columns": s} for s in subsets], "ds", "silver").collect()
    want = [int(pdf.duplicated(s, keep=False).sum()) for s in subsets]
    assert [r.reason for r in got] == [f"{n} duplicate rows found" if n else None for n in want]


def test_iqr_outliers_ids_that_share_names(spark):
    rows = [(i, float(i % 10), 0.0 if i else None) for i in range(200)] + [(-2, 900.0, 7.0), (-1, 800.0, None)]
    df = spark.createDataFrame(rows, "value long, column double, v double")
    r = {x.column: x for x in iqr_outliers(df, {"column": 1.5, "v": 1.5, "gone": 1.5}, ["value"]).collect()}
    assert (r["column"].outliers_count, r["column"].sample_1, r["column"].sample_2) == (2, 900.0, 800.0)
    assert (r["v"].outliers_count, r["v"].sample_1) == (1, 7.0) and r["v"].outlier_percentage == pytest.approx(100 / 202)
    empty = iqr_outliers(df.where("false"), {"column": 1.5}, ["value"]).collect()[0]
    assert (empty.outliers_count, empty.outlier_percentage, empty.q1) == (0, 0.0, None)


def test_report_lists_no_more_members_than_expected(spark, sample):
    rep = quality.quality_report(sample, sample, "ds", {}, ["BRA", "CHL"], members="expected").collect()[0]
    assert (rep.members_covered, rep.missing_members, rep.entities_covered) == ("BRA", "CHL", 2)
    assert quality.quality_report(sample, sample, "ds", {}, members="expected").collect()[0].members_covered == ""
    assert quality.quality_report(sample, sample, "ds", {}).collect()[0].members_covered == "ARG,BRA"
    with pytest.raises(ValueError, match="members"):
        quality.quality_report(sample, sample, "ds", {}, members="some")


def test_covered_members(spark, sample):
    odd = sample.unionByName(spark.createDataFrame([(None, 2013, 1.0, 1.0), ("ARG", 2013, 1.0, 1.0), ("ARG", None, 1.0, 1.0)], sample.schema))
    got = {r.member: (r.expected, r.n_rows, r.n_periods) for r in quality.covered_members(odd, ["BRA", "CHL", "CHL"]).collect()}
    assert got == {"ARG": (False, 13, 11), "BRA": (True, 11, 11), "CHL": (True, 0, 0)}
    assert quality.covered_members(sample.where("false")).count() == 0
