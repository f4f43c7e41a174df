"""Property tests: the Spark operators against a brute-force pandas/NumPy computation."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepanel.functions.numeric import np_round
from tidepanel.operators.fill import forward_fill, interpolate_linear
from tidepanel.operators.growth import pct_change

value = st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x, 3)),
                  st.just(0.0))
series = st.lists(value, min_size=1, max_size=8)
panel = st.lists(series, min_size=1, max_size=3)
SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))


def _frame(spark, p):
    rows = [(f"E{e}", 2000 + i, v) for e, s in enumerate(p) for i, v in enumerate(s)]
    pdf = pd.DataFrame(rows, columns=["country_code", "year", "v"]).astype({"v": "float64"})
    return spark.createDataFrame(rows, "country_code string, year bigint, v double"), pdf


def _same(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and (math.isnan(b) or math.isinf(b)))
    return b is not None and not math.isnan(b) and a == b


def _got(df, col="v"):
    return {(r.country_code, r.year): r[col] for r in df.collect()}


@SETTINGS
@given(panel)
def test_forward_fill_matches_pandas(spark, p):
    sdf, pdf = _frame(spark, p)
    want = pdf.assign(v=pdf.groupby("country_code")["v"].ffill())
    got = _got(forward_fill(sdf, ["v"]))
    assert all(_same(got[(r.country_code, r.year)], r.v) for r in want.itertuples())


@SETTINGS
@given(panel)
def test_interpolate_matches_pandas(spark, p):
    sdf, pdf = _frame(spark, p)
    want = pdf.assign(v=pdf.groupby("country_code")["v"].transform(
        lambda s: s.interpolate(method="linear", limit_direction="forward")))
    got = _got(interpolate_linear(sdf, ["v"]))
    for r in want.itertuples():
        g = got[(r.country_code, r.year)]
        assert (g is None and math.isnan(r.v)) or (g is not None and g == r.v)


@SETTINGS
@given(panel)
def test_pct_change_pad_matches_pandas(spark, p):
    sdf, pdf = _frame(spark, p)
    padded = pdf.groupby("country_code")["v"].ffill()
    prev = padded.groupby(pdf["country_code"]).shift(1)
    want = np.round((padded / prev - 1) * 100, 2)
    got = _got(pct_change(sdf, "v", "g"), "g")
    for key, w in zip(zip(pdf.country_code, pdf.year), want):
        assert _same(got[key], None if (math.isnan(w) or math.isinf(w)) else float(w))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=1, max_size=50),
       st.integers(min_value=0, max_value=6))
def test_np_round_matches_numpy(spark, xs, n):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(np_round("x", n)).collect()]
    assert got == [float(np.round(x, n)) for x in xs]


modes = st.sampled_from(["air", "sea", "land"])
long_rows = st.lists(st.tuples(st.sampled_from(["E0", "E1", "E2"]), st.integers(2000, 2003), modes,
                               st.one_of(st.none(), st.integers(0, 1000).map(float))), max_size=25)


@SETTINGS
@given(long_rows)
def test_pivot_matches_pandas_pivot_table(spark, rows):
    from tidepanel.operators.assemble import pivot_modes
    if not rows:
        return
    sdf = spark.createDataFrame(rows, "e string, year bigint, m string, v double")
    got = {(r.e, r.year): r for r in pivot_modes(sdf, ["e", "year"], "m", "v", ["air", "sea", "land"]).collect()}
    pdf = pd.DataFrame(rows, columns=["e", "year", "m", "v"])
    want = pdf.pivot_table(index=["e", "year"], columns="m", values="v", aggfunc="sum", dropna=False)
    for (e, y), r in got.items():
        for m in ("air", "sea", "land"):
            present = ((pdf.e == e) & (pdf.year == y) & (pdf.m == m)).any()
            w = want.loc[(e, y), m] if (m in want.columns and (e, y) in want.index) else float("nan")
            g = r[m]
            assert (g is None and not present) or (present and g == (0.0 if math.isnan(w) else w))


shares = st.lists(st.tuples(*[st.one_of(st.none(), st.integers(0, 5).map(float))] * 3), min_size=1, max_size=20)


@SETTINGS
@given(shares)
def test_dominant_matches_idxmax(spark, rows):
    from tidepanel.functions.categorize import dominant_category
    sdf = spark.createDataFrame(rows, "pct_air double, pct_sea double, pct_land double")
    got = [r[0] for r in sdf.select(dominant_category({"air": "pct_air", "sea": "pct_sea", "land": "pct_land"}))
           .collect()]
    pdf = pd.DataFrame(rows, columns=["pct_air", "pct_sea", "pct_land"], dtype="float64")
    for g, (_, row) in zip(got, pdf.iterrows()):
        want = None if row.isna().all() else {"pct_air": "air", "pct_sea": "sea", "pct_land": "land"}[row.idxmax()]
        assert g == want


keyed = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(1, 4),
                           st.one_of(st.none(), st.integers(0, 9).map(float))), max_size=10) \
    .map(lambda rs: list({(k, y): (k, y, v) for k, y, v in rs}.values()))


@SETTINGS
@given(keyed, keyed, keyed)
def test_union_assembly_equals_outer_joins(spark, a, b, c):
    from tidepanel.operators.assemble import outer_assemble
    frames = [spark.createDataFrame(rows, f"k string, y bigint, v{i} double") for i, rows in enumerate((a, b, c))]
    u = outer_assemble(frames, ["k", "y"], "union")
    j = outer_assemble(frames, ["k", "y"], "join")
    assert sorted(map(tuple, u.collect()), key=repr) == sorted(map(tuple, j.collect()), key=repr)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C", None]), st.integers(2000, 2003),
                          st.one_of(st.none(), st.integers(0, 9).map(float))), max_size=20))
def test_period_compare_matches_pandas_merge(spark, rows):
    from tidepanel.operators.compare import period_compare
    sdf = spark.createDataFrame(rows, "label string, year bigint, v double")
    got = {r.label: (r.v_2000, r.v_2003) for r in period_compare(sdf, "label", "v", 2000, 2003).collect()}
    pdf = pd.DataFrame(rows, columns=["label", "year", "v"]).astype({"v": "float64"})
    pre = pdf[pdf.year == 2000].groupby("label")["v"].sum().reset_index()
    post = pdf[pdf.year == 2003].groupby("label")["v"].sum().reset_index()
    want = {r.label: (r.v_2000, r.v_2003) for r in pre.merge(post, on="label", suffixes=("_2000", "_2003")).itertuples()}
    assert got == want
