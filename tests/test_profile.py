"""Stored profiles: merged sketches against exact values, and what a refresh reads."""

import random

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import profile as P
from tidepanel.operators.deltas import stored_parts

SCHEMA = "year bigint, k string, v double, n int, nothing double"


@pytest.fixture
def stored(spark, tmp_path):
    rng = random.Random(6)
    rows = [(2000 + i % 4 if i % 50 else None, f"k{rng.randrange(3000)}", None if i % 11 == 0 else float("nan") if i % 13 == 0 else rng.gauss(0, 10), rng.randrange(9), None) for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    df.repartition(3).write.partitionBy("year").parquet(str(tmp_path / "t"))
    return str(tmp_path / "t"), str(tmp_path / "p")


COLS = ["k", "v", "n", "nothing"]


def merged(profile):
    return {r["column"]: r for r in P.merged_profile(profile).collect()}


def test_merged_sketches_are_within_their_bounds(spark, stored):
    path, store = stored
    got = merged(P.refresh_profile(spark, path, store, COLS).profile)
    df = spark.read.parquet(path)
    whole = merged(P.partial_profile(df, COLS))
    values = sorted(r.v for r in df.select("v").collect() if r.v is not None and r.v == r.v)
    for m in (got, whole):
        assert {c: (m[c].n_rows, m[c].n_nulls) for c in COLS} == {"k": (20_000, 0), "v": (20_000, 20_000 - len(values)), "n": (20_000, 0), "nothing": (20_000, 20_000)}
        assert abs(m["k"].n_distinct - df.select("k").distinct().count()) <= 3 * P.DISTINCT_ERROR * 3000 and m["n"].n_distinct == 9 and m["nothing"].n_distinct == 0
        assert (m["v"].least_number, m["v"].most_number) == (values[0], values[-1]) and m["k"].least == "k0" and m["nothing"].q_1 is None and m["nothing"].least_number is None
        for q, wanted in ((m["v"].q_0, 0.25), (m["v"].q_1, 0.5), (m["v"].q_2, 0.75)):
            assert abs(sum(x <= q for x in values) / len(values) - wanted) <= 3 * P.RANK_ERROR


def test_a_refresh_reads_changed_partitions_only(spark, stored):
    path, store = stored
    first = P.refresh_profile(spark, path, store, COLS)
    assert first.read == ["2000", "2001", "2002", "2003", "__HIVE_DEFAULT_PARTITION__"]
    assert P.refresh_profile(spark, path, store, COLS).read == []
    spark.createDataFrame([("new", 1e6, 1, None)], "k string, v double, n int, nothing double").write.mode("append").parquet(f"{path}/year=2002")
    second = P.refresh_profile(spark, path, store, COLS)
    got = merged(second.profile)
    assert second.read == ["2002"] and (got["v"].n_rows, got["v"].most_number, got["k"].most) == (20_001, 1e6, "new")
    spark.createDataFrame([("x", 1.0, 1, None)], "k string, v double, n int, nothing double").write.parquet(f"{path}/year=2010")
    assert P.refresh_profile(spark, path, store, COLS).read == ["2010"]
    assert len(stored_parts(spark, store)) == 6  # old versions are gone
    exact = merged(P.partial_profile(spark.read.parquet(path), COLS))
    again = merged(P.refresh_profile(spark, path, store, COLS).profile)
    assert {c: (r.n_rows, r.n_nulls, r.least, r.most_number) for c, r in again.items()} == {c: (r.n_rows, r.n_nulls, r.least, r.most_number) for c, r in exact.items()}


def test_outliers_follow_from_the_profile(spark, stored):
    path, store = stored
    df = spark.read.parquet(path).withColumn("id", F.monotonically_increasing_id())
    profile = P.refresh_profile(spark, path, store, COLS).profile
    got = {r["column"]: r for r in P.profile_outliers(df, profile, {"v": 1.5, "nothing": 1.5, "absent": 2.0}, ["id"]).collect()}
    v = got["v"]
    outside = [r.v for r in df.orderBy("id").collect() if r.v is not None and r.v == r.v and (r.v < v.lower_bound or r.v > v.upper_bound)]
    assert (v.outliers_count, v.sample_1, v.sample_5) == (len(outside), outside[0], outside[4]) and v.outlier_percentage == pytest.approx(len(outside) / 200)
    assert (got["nothing"].outliers_count, got["nothing"].q1, got["absent"].outliers_count) == (0, None, 0)


def test_profile_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    got = merged(P.partial_profile(none, COLS))
    assert all((r.n_rows, r.n_nulls, r.null_pct, r.n_distinct, r.q_1) == (0, 0, None, 0, None) for r in got.values())
    (tmp_path / "e").mkdir()
    done = P.refresh_profile(spark, str(tmp_path / "e"), str(tmp_path / "s"), COLS)
    assert done.read == [] and P.merged_profile(done.profile).count() == 0


def test_metadata_and_null_shares_without_reading_the_table(spark, tmp_path):
    from tidepanel.operators.quality import null_profile
    from tidepanel.sources.sinks import table_metadata

    path, store = str(tmp_path / "t"), str(tmp_path / "p")
    df = spark.createDataFrame([(f"c{i % 7}", 1990 + i % 9, None if i % 4 else 1.0) for i in range(100)], "country_code string, year bigint, v double")
    df.write.parquet(path)
    done = P.refresh_profile(spark, path, store, df.columns, by=None)
    assert done.read == ["whole"] and P.refresh_profile(spark, path, store, df.columns, by=None).read == []
    got = P.profiled_metadata(done.profile, "t")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in table_metadata(spark.read.parquet(path), "t").collect()]
    assert {r["column"]: r.null_pct for r in P.profiled_nulls(done.profile).collect()} == {r["column"]: r.null_pct for r in null_profile(spark.read.parquet(path)).collect()}
    assert all(path not in f for f in done.profile.inputFiles()) and f"{path}/" not in got._jdf.queryExecution().optimizedPlan().toString()
    df.write.mode("append").parquet(path)
    assert P.profiled_metadata(P.refresh_profile(spark, path, store, df.columns, by=None).profile, "t").first().n_rows == 200
