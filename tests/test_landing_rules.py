"""Gated writes, quarantine, and trees of files that type a column differently."""

import pytest
from pyspark.sql import functions as F

from tidepanel.operators.clean import apply_schema, quarantine
from tidepanel.session import data_files
from tidepanel.sources import readers, sinks
from tidepanel.spec import SchemaSpec

ROWS = [("a", 2001, 1.0), ("b", 2001, None), ("a", 2002, 3.0), ("b", 2003, 4.0)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "country_code string, year bigint, v double").repartition(2)


def test_bronze_writer_counts_its_files(spark, tmp_path):
    path = str(tmp_path / "b")
    assert sinks.write_bronze_partitioned(frame(spark), path) == 3
    assert sinks.write_bronze_partitioned(frame(spark).where("year = 2002"), path) == 1 and len(data_files(spark, path)) == 3
    assert sinks.write_bronze_partitioned(frame(spark), str(tmp_path / "two"), ("year", "country_code")) == 4


def test_gated_write_runs_the_source_once(spark, tmp_path):
    path, calls = str(tmp_path / "g"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    df = frame(spark)
    landed = sinks.write_gated(df.mapInPandas(count, df.schema), path, {"v": 30.0})
    assert landed == sinks.Landed(rows=4, files=3, partitions=3) and calls.value == 4
    back = readers.read_partitioned(spark, path)
    assert sorted((r.country_code, r.year, r.v) for r in back.collect()) == sorted(ROWS, key=lambda r: (r[0], r[1]))
    sinks.write_gated(frame(spark, [("c", 2002, 9.0)]), path, {"v": 30.0})
    assert sorted((r.country_code, r.year) for r in readers.read_partitioned(spark, path).collect()) == [("a", 2001), ("b", 2001), ("b", 2003), ("c", 2002)]


@pytest.mark.parametrize("rows,limits,failed", [(ROWS, {"v": 10.0}, ["v"]), ([], {"v": 100.0}, ["__rows"]), (ROWS, {"v": 99.0, "w": 99.0}, ["w"])])
def test_gate_that_fails_leaves_nothing(spark, tmp_path, rows, limits, failed):
    path = str(tmp_path / "g")
    sinks.write_bronze_partitioned(frame(spark), path)
    before = data_files(spark, path)
    with pytest.raises(sinks.GateError) as e:
        sinks.write_gated(frame(spark, rows), path, limits)
    assert e.value.failed == failed and data_files(spark, path) == before
    assert not [x for x in (tmp_path / "g").iterdir() if x.name.startswith(".landing")]


SPEC = SchemaSpec(required=("country_code", "year"), numeric=("v", "w"))
MESSY = [(" a ", "2001", "1.5", "2"), ("b", "2002.0", "x", None), ("c", None, "1", "1"), ("d", "soon", "y", "z"), ("e", "2003.5", None, "nan"), (None, "2004", "", "4"), ("f", "NaN", "1", "1")]


def test_quarantine_keeps_every_row_and_says_why(spark):
    df = spark.createDataFrame(MESSY, "country_code string, year string, v string, w string").repartition(3)
    got = quarantine(df, SPEC)
    assert got.accepted.count() + got.rejects.count() == len(MESSY)
    assert sorted(map(str, got.accepted.collect())) == sorted(map(str, apply_schema(df, SPEC, on_null_period="drop").collect()))
    why = sorted((r.column, r.value or "", r.reason, r.rejected) for r in got.reasons.collect())
    assert why == sorted([("year", "", "is missing", True), ("year", "soon", "not an integer", True), ("year", "2003.5", "not an integer", True), ("year", "NaN", "is missing", True),
                          ("v", "x", "not a number", False), ("v", "y", "not a number", False), ("v", "", "not a number", False), ("w", "z", "not a number", False)])
    told = {r.row: r for r in got.rejects.collect()}
    assert sum("soon" in r.source and r.n_reasons == 3 for r in told.values()) == 1
    strict = quarantine(df, SPEC, strict=["v"])
    assert strict.accepted.count() == 1 and strict.rejects.count() == 6
    none = quarantine(df.limit(0), SPEC)
    assert none.accepted.count() == none.rejects.count() == none.reasons.count() == 0
    with pytest.raises(ValueError, match="year"):
        quarantine(df.drop("year"), SPEC)


@pytest.mark.parametrize("few", [64, 2])
def test_tree_of_unequal_types(spark, tmp_path, monkeypatch, few):
    alike = readers._alike
    monkeypatch.setattr(readers, "_alike", lambda s, p, n=few: alike(s, p, few))
    top = str(tmp_path / "t")
    parts = [("int", "1"), ("bigint", "5000000000"), ("double", "2.5"), ("int", "7")]
    for i, (kind, v) in enumerate(parts):
        spark.sql(f"select '{i}' as k, cast({v} as {kind}) as v, cast({v} as {'int' if i < 2 else 'bigint' if kind != 'bigint' else kind}) as n").write.parquet(f"{top}/p{i}") if i != 1 else \
            spark.sql(f"select '{i}' as k, cast({v} as {kind}) as v").write.parquet(f"{top}/p{i}")
    spark.sql("select '9' as k, 'text' as note, array(1, 2) as list").write.parquet(f"{top}/deep/er")
    got = readers.read_tree(spark, top)
    assert dict(got.dtypes) == {"k": "string", "v": "double", "n": "bigint", "note": "string", "list": "array<int>"}
    assert sorted((r.k, r.v, r.n) for r in got.collect()) == [("0", 1.0, 1), ("1", 5e9, None), ("2", 2.5, 2), ("3", 7.0, 7), ("9", None, None)]
    spark.sql("select 'x' as k, 'word' as v").write.parquet(f"{top}/p8")
    assert dict(readers.read_tree(spark, top).dtypes)["v"] == "string"


def test_trees_of_several_folders_and_other_errors(spark, tmp_path):
    spark.range(2).select(F.col("id").cast("int").alias("v")).write.parquet(str(tmp_path / "a"))
    spark.range(2).select((F.col("id") / 2).alias("v")).write.parquet(str(tmp_path / "b"))
    got = readers.read_tree(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert got.dtypes == [("v", "double")] and sorted(r.v for r in got.collect()) == [0.0, 0.0, 0.5, 1.0]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_tree(spark, str(tmp_path / "none"))
