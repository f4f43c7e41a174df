"""Span-by-span scans against windows over whole entities, on random panels."""

import random

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import fill, growth
from tidepanel.spec import PanelKey

KEY = PanelKey(("who", "where"), "t")


def panel(spark, seed):
    rng, rows = random.Random(seed), []
    for who in ("a", "b", None, "one"):
        for t in sorted(rng.sample(range(-40, 60), 1 if who == "one" else rng.randint(5, 60))):
            rows.append((who, rng.choice("xy") if who == "b" else "x", t, rng.choice([None, None, 0.0, round(rng.uniform(-5, 5), 1)]), rng.choice([None, rng.randint(0, 9)]), "kept"))
    rows += [("empty", "x", t, None, None, "kept") for t in range(0, 30, 4)] + [("late", "x", 500, 1.0, 1, "kept"), ("late", "x", -500, None, None, "kept"), ("late", "x", 900, None, 3, "kept")]
    return spark.createDataFrame(rows, "who string, where string, t long, v double, n int, note string").repartition(3)


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_fills_equal_windows_over_the_entity(spark, span):
    df = panel(spark, span)
    same(fill.forward_fill_long(df, ["v", "n", "missing"], span, KEY), fill.forward_fill(df, ["v", "n"], KEY))
    for mode in ("position", "time"):
        for extrapolate in (True, False):
            same(fill.interpolate_long(df, ["v", "n"], span, KEY, extrapolate, mode), fill.interpolate_linear(df, ["v", "n"], KEY, mode, extrapolate))
    assert fill.interpolate_long(df, [], span, KEY) is df


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_growth_equals_windows_over_the_entity(spark, span):
    df = panel(spark, 10 + span)
    for how in ({}, {"fill": "none"}, {"periods": 4}, {"fill": "none", "periods": 3}, {"zero_base": "inf"}, {"digits": None}):
        same(growth.pct_change_long(df, "v", "g", span, KEY, **how), growth.pct_change(df, "v", "g", KEY, **how))


def test_scans_of_nothing_and_wrong_arguments(spark):
    df = panel(spark, 1).limit(0)
    assert fill.forward_fill_long(df, ["v"], 5, KEY).count() == 0 and growth.pct_change_long(df, "v", "g", 5, KEY, periods=2).count() == 0
    with pytest.raises(ValueError):
        growth.pct_change_long(df, "v", "g", 5, KEY, fill="other")
    with pytest.raises(ValueError):
        growth.pct_change_long(df, "v", "g", 5, KEY, fill="none", periods=0)
    with pytest.raises(ValueError):
        fill.interpolate_long(df, ["v"], 5, KEY, mode="other")
