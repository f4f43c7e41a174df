"""Co-located tables: no exchange on the key, whole results, other sessions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidepanel.operators.assemble import build_fact
from tidepanel.operators.growth import pct_change
from tidepanel.session import scratch_dir
from tidepanel.sources.colocated import LAYOUT_FILE, is_colocated, read_colocated, write_colocated
from tidepanel.spec import PanelKey


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _side(spark, name, n=40):
    rows = spark.range(n * 6).select(F.concat(F.lit("E"), F.col("id") % n).alias("country_code"), (2000 + F.col("id") / n).cast("bigint").alias("year"))
    return rows.withColumn(name, (F.hash("country_code", "year") % 1000).cast("double") + 1000).where(f"hash('{name}', country_code, year) % 5 <> 0")


@pytest.fixture
def sides(spark):
    base = scratch_dir(spark, "sides")
    frames = [_side(spark, "co2"), _side(spark, "tourist_arrivals"), _side(spark, "pct_air")]
    for i, f in enumerate(frames):
        write_colocated(f, f"{base}/{i}", ["country_code"], ["year"], 4)
    return frames, [read_colocated(spark, f"{base}/{i}") for i in range(3)]


@pytest.mark.parametrize("method", ["union", "join"])
def test_fact_needs_no_exchange(sides, method):
    plain, stored = sides
    # a grouping by (country_code, year) is served by buckets of the entity; a join by both wants them all in the hash
    got = build_fact(*stored, method=method)
    if method == "union":
        assert "Exchange" not in _plan(got)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(build_fact(*plain, method=method)) and got.count() > 200


def test_growth_after_the_fact_needs_no_exchange(sides):
    plain, stored = sides
    grown = lambda fs: pct_change(build_fact(*fs), "co2", "growth", PanelKey(("country_code",), "year"))
    assert "Exchange" not in _plan(grown(stored))
    assert sorted(map(str, grown(stored).collect())) == sorted(map(str, grown(plain).collect()))


def test_joins_and_windows_on_the_key(spark, sides):
    _, (a, b, _) = sides
    joined = a.hint("merge").join(b, "country_code")
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    last = a.withColumn("rn", F.row_number().over(Window.partitionBy("country_code").orderBy("year")))
    assert "Exchange" not in _plan(last)


def test_session_that_did_not_write(spark):
    path = f"{scratch_dir(spark, 'kept')}/o'hara"
    df = spark.createDataFrame([(None, 1, None), ("a", 1, 2.5), ("a", 2, None), ("a", 1, 2.5)], "`k k` string, p int, v double")
    assert not is_colocated(spark, path)
    write_colocated(df, path, ["k k"], ["p"], 3)
    for t in [t.name for t in spark.catalog.listTables() if t.name.startswith("colocated_")]:
        spark.sql(f"DROP TABLE {t}")  # entries go, files stay
    assert is_colocated(spark, path)
    got = read_colocated(spark, path)
    assert got.schema.simpleString() == df.schema.simpleString() and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))


def test_replaced_tables_and_incomplete_folders(spark):
    from tidepanel.session import file_system

    path = f"{scratch_dir(spark, 'again')}/t"
    write_colocated(spark.range(10).toDF("k"), path, ["k"], buckets=2)
    assert read_colocated(spark, path).count() == 10
    write_colocated(spark.range(7).toDF("k"), path, ["k"], buckets=2)  # the same layout
    assert read_colocated(spark, path).count() == 7
    write_colocated(spark.range(5).selectExpr("id k", "id v"), path, ["k"], buckets=3)  # another one
    assert sorted(r.v for r in read_colocated(spark, path).collect()) == [0, 1, 2, 3, 4]
    write_colocated(spark.range(0).toDF("k"), path, ["k"], buckets=2)
    assert read_colocated(spark, path).count() == 0
    fs, mark = file_system(spark, f"{path}/{LAYOUT_FILE}")
    fs.delete(mark, False)
    with pytest.raises(ValueError, match="no co-located table"):
        read_colocated(spark, path)
    with pytest.raises(ValueError, match="columns not found"):
        write_colocated(spark.range(1), path, ["nope"])


def test_gold_fact_from_buckets_needs_no_exchange(spark):
    from tidepanel.plans import layers
    from tidepanel.plans.queries import q_gold_fact_colocated

    sf_dir, base = "/root/testdata/sf0.001", scratch_dir(spark, "colocated-lake")
    stored = layers.colocated_silver(spark, sf_dir, base, buckets=3)
    again = layers.colocated_silver(spark, sf_dir, base, buckets=3)
    for name, df in stored.items():
        assert df.inputFiles() == again[name].inputFiles()  # made once
    fact = q_gold_fact_colocated(spark, sf_dir)
    assert "Exchange" not in _plan(fact)
