"""Sources and sinks: write, read back, compare."""

import json
import os

import pytest

from pyspark.sql import functions as F

from tidepanel.sources import catalog, readers, sinks


def test_partition_writer_two_keys(spark, tmp_path):
    df = spark.createDataFrame([(2020, "ARG", 1.0), (2021, "BRA", 2.0), (2020, "ARG", 3.0)],
                               "year bigint, country_code string, value double")
    path = str(tmp_path / "bronze")
    sinks.write_bronze_partitioned(df, path, ("year", "country_code"), ())
    assert sorted(p for p in os.listdir(path) if p.startswith("year=")) == ["year=2020", "year=2021"]
    back = readers.read_partitioned(spark, path)
    assert dict(back.dtypes)["year"] == "bigint" and dict(back.dtypes)["country_code"] == "string"
    assert back.count() == 3


def test_partition_overwrite_is_dynamic(spark, tmp_path):
    path = str(tmp_path / "b")
    a = spark.createDataFrame([(2020, "ARG", 1.0), (2021, "ARG", 2.0)], "year bigint, country_code string, value double")
    sinks.write_bronze_partitioned(a, path)
    b = spark.createDataFrame([(2021, "ARG", 9.0)], "year bigint, country_code string, value double")
    sinks.write_bronze_partitioned(b, path)
    got = {(r.year, r.value) for r in readers.read_partitioned(spark, path).collect()}
    assert got == {(2020, 1.0), (2021, 9.0)}


def test_rebalanced_partition_write_keeps_every_row(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("bigint").alias("year"), F.col("id").alias("v"))
    path = str(tmp_path / "rebalanced")
    sinks.write_bronze_partitioned(df, path, ("year",), ())
    back = readers.read_partitioned(spark, path, entity=None)
    assert back.count() == 1000 and back.agg(F.sum("v")).collect()[0][0] == sum(range(1000))


def test_read_tree_union_by_name(spark, tmp_path):
    spark.createDataFrame([("A", 1.0)], "k string, a double").write.parquet(str(tmp_path / "t1" / "x"))
    spark.createDataFrame([("B", 2.0)], "k string, b double").write.parquet(str(tmp_path / "t2"))
    df = readers.read_tree(spark, [str(tmp_path / "t1"), str(tmp_path / "t2")])
    assert sorted(df.columns) == ["a", "b", "k"]
    assert sorted(map(tuple, df.select("k", "a", "b").collect()), key=str) == [("A", 1.0, None), ("B", None, 2.0)]


def test_schema_override_absent_columns_null(spark, tmp_path):
    spark.createDataFrame([("A", 1.0)], "k string, a double").write.parquet(str(tmp_path / "s"))
    df = readers.read_schema_override(spark, str(tmp_path / "s"), "k string, a double, extra double")
    assert df.collect()[0].extra is None


def test_csv_wide_coerces(spark, tmp_path):
    p = tmp_path / "w.csv"
    p.write_text("country,year,co2\nA,2020,1.5\nB,x,n/a\n")
    df = readers.read_csv_wide(spark, str(p), numeric=["co2"], integer=["year"])
    assert [tuple(r) for r in df.collect()] == [("A", 2020, 1.5), ("B", None, None)]


def test_json_indicator_filters(spark, tmp_path):
    recs = [
        {"indicator": {"id": "I", "value": "v"}, "country": {"id": "AR", "value": "Argentina"},
         "countryiso3code": "ARG", "date": "2020", "value": 5.0},
        {"indicator": {"id": "I", "value": "v"}, "country": {"id": "ZJ", "value": "Latin America"},
         "countryiso3code": "LCN", "date": "2020", "value": 9.0},
        {"indicator": {"id": "I", "value": "v"}, "country": {"id": "XLA", "value": "Argentina"},
         "countryiso3code": "", "date": "2020", "value": 9.0},
        {"indicator": {"id": "I", "value": "v"}, "country": {"id": "AR", "value": "Argentina"},
         "countryiso3code": "ARG", "date": "1990", "value": 1.0},
        {"indicator": {"id": "I", "value": "v"}, "country": {"id": "AR", "value": "Argentina"},
         "countryiso3code": "ARG", "date": "bad", "value": 1.0},
        {"indicator": {"id": "I", "value": "v"}, "country": {"id": "BO", "value": "Bolivia (Plurinational State of)"},
         "countryiso3code": "BOL", "date": "2021", "value": None},
    ]
    p = tmp_path / "wb.json"
    p.write_text("\n".join(json.dumps(r) for r in recs))
    df = readers.read_json_indicator(spark, str(p), "arrivals", ["Argentina", "Bolivia"], 2013, 2023,
                                     aliases={"Bolivia (Plurinational State of)": "Bolivia"})
    assert sorted(map(tuple, df.collect()), key=str) == [("Argentina", "ARG", 2020, 5.0), ("Bolivia", "BOL", 2021, None)]


def test_export_metadata_dictionary_report(spark, tmp_path):
    df = spark.createDataFrame([("ARG", 2020, 1.0), ("BRA", 2021, None)], "country_code string, year bigint, v double")
    out = sinks.export_open_data(df, str(tmp_path / "od"), "v1", "gold", "t")
    assert spark.read.option("header", "true").csv(out["csv"]).count() == 2
    md = sinks.table_metadata(df, "t").collect()[0]
    assert (md.n_rows, md.n_columns, md.period_min, md.period_max, md.n_members) == (2, 3, 2020, 2021, 2)
    assert sorted(r.member for r in sinks.table_members(df, "t").collect()) == ["ARG", "BRA"]
    dd = {r.column: r for r in sinks.data_dictionary(df, {"v": ("Mt", "value")}).collect()}
    assert dd["v"].unit == "Mt" and dd["v"].null_pct == 50.0 and dd["year"].type == "bigint"
    for _ in range(2):  # the second run of a date replaces the first
        part = sinks.write_report(df, str(tmp_path / "rep"), "2024-01-31")
    sinks.write_report(df, str(tmp_path / "rep"), "2024-02-29")
    assert spark.read.json(part).count() == 2 and spark.read.json(str(tmp_path / "rep")).count() == 4


def test_register_tables(spark, tmp_path):
    df = spark.createDataFrame([("ARG", 1.0)], "k string, v double")
    df.write.parquet(str(tmp_path / "p"))
    catalog.register_tables(spark, {"t_path": str(tmp_path / "p"), "t_df": df})
    assert spark.sql("select count(*) from t_path join t_df using (k)").collect()[0][0] == 1


def test_register_tables_in_catalog_database(spark, tmp_path):
    df = spark.createDataFrame([("ARG", 2020, 1.0), ("BRA", 2020, 2.0)], "country_code string, year bigint, v double")
    df.write.parquet(str(tmp_path / "fact"))
    names = catalog.register_tables(spark, {"fact_t": str(tmp_path / "fact")}, database="panel_db")
    assert names == ["panel_db.fact_t"]
    assert spark.sql("select sum(v) from panel_db.fact_t where year = 2020").collect()[0][0] == 3.0


def test_catalog_table_is_updated_in_place(spark, tmp_path):
    path = str(tmp_path / "grown")
    full = "panel_db.grown"
    spark.sql("select 'A' as k, cast(1 as int) as n, 2020 as year union all select 'B', 2, 2021").write.partitionBy("year").parquet(path)
    first = catalog.update_table(spark, "panel_db", "grown", path)
    assert first.created and first.partitions == 2
    marked = spark.sql("ALTER TABLE panel_db.grown SET TBLPROPERTIES ('kept' = 'yes')") and None
    spark.sql("select 'C' as k, cast(5000000000 as bigint) as n, 1.5D as extra, 2022 as year").write.mode("append").partitionBy("year").parquet(path)
    second = catalog.update_table(spark, "panel_db", "grown", path)
    assert marked is None and second == catalog.TableChange(False, ["extra"], ["n"], 1)
    assert "kept" in {r.key for r in spark.sql("SHOW TBLPROPERTIES panel_db.grown").collect()}  # the same table, not a new one
    assert sorted((r.k, r.n, r.extra, r.year) for r in spark.table(full).collect()) == [("A", 1, None, 2020), ("B", 2, None, 2021), ("C", 5_000_000_000, 1.5, 2022)]
    assert catalog.update_table(spark, "panel_db", "grown", path) == catalog.TableChange(False, [], [], 0)
    spark.sql("select 'D' as k, 'word' as n, 2023 as year").write.mode("append").partitionBy("year").parquet(path)
    with pytest.raises(ValueError, match="n: bigint -> string"):
        catalog.update_table(spark, "panel_db", "grown", path)
    assert spark.table(full).where("year < 2023").count() == 3
    other = str(tmp_path / "other")
    spark.sql("select 'E' as k, cast(9 as bigint) as n, 2021 as year union all select 'F', 3, 2030").write.partitionBy("year").parquet(other)
    assert catalog.update_table(spark, "panel_db", "grown", other).partitions == 1
    assert sorted((r.k, r.year) for r in spark.table(full).collect()) == [("E", 2021), ("F", 2030)]


def test_files_are_sorted_by_entity(spark, tmp_path):
    rows = [(2020 + i % 2, f"E{(i * 37) % 50:02d}", float(i)) for i in range(200)]
    sinks.write_bronze_partitioned(spark.createDataFrame(rows, "year bigint, country_code string, v double").repartition(4), str(tmp_path / "b"))
    for y in (2020, 2021):
        for f in os.listdir(tmp_path / "b" / f"year={y}"):
            if f.endswith(".parquet"):
                codes = [r.country_code for r in spark.read.parquet(str(tmp_path / "b" / f"year={y}" / f)).collect()]
                assert codes == sorted(codes)


def test_export_runs_its_source_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([("ARG", 2020, 1.0)], "country_code string, year bigint, v double")
    counted = spark.createDataFrame(df.rdd.map(lambda r: (runs.add(1), tuple(r))[1]), df.schema)
    out = sinks.export_open_data(counted, str(tmp_path / "od"), "v1", "gold", "t", {"v": ("Mt", "value")}, {"license": "x"}, "2024-01-31")
    assert runs.value == 1
    meta = json.loads(spark.read.text(out["metadata"]).first()[0])
    assert meta["coverage"] == {"countries": ["ARG"], "year_start": 2020, "year_end": 2020, "rows": 1, "columns": 3}


def test_catalog_tables_follow_their_place_and_have_their_partitions(spark, tmp_path):
    for name, v in (("a", 1.0), ("b", 2.0)):
        spark.createDataFrame([("ARG", v, 2020)], "k string, v double, year int").write.partitionBy("year").parquet(str(tmp_path / name))
        catalog.register_tables(spark, {"moved": str(tmp_path / name)}, database="panel_db")
        assert [(r.v, r.year) for r in spark.sql("select * from panel_db.moved").collect()] == [(v, 2020)]


def test_sheet_years_with_a_decimal_point(spark, tmp_path):
    p = tmp_path / "sheet.csv"
    p.write_text("reporter_area_label,year,indicator_label,value\nA,2020.0,Inbound by air,5\nA,2020.5,Inbound by air,6\nA,1e3,Inbound by air,7\n")
    assert sorted((r.year or 0, r.value) for r in readers.read_long_indicators(spark, str(p)).collect()) == [(0, 6.0), (1000, 7.0), (2020, 5.0)]


def test_layers_are_made_once_and_again_when_their_inputs_change(spark, tmp_path):
    import shutil

    from tidepanel.plans import layers

    src = tmp_path / "in"
    src.mkdir()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", src / f"{t}.parquet")
        os.chmod(src / f"{t}.parquet", 0o644)
    base = str(tmp_path / "store")
    first = layers.lake(spark, str(src), base)
    stamps = {k: os.stat(p).st_mtime_ns for k, p in first.items()}
    again = layers.lake(spark, str(src), base)
    assert again == first and {k: os.stat(p).st_mtime_ns for k, p in again.items()} == stamps
    os.utime(src / "orders.parquet", (1, 1))
    third = layers.lake(spark, str(src), base)
    assert {k for k in third if third[k] != first[k]} == {"bronze_co2", "silver_co2", "fact"}
    assert spark.read.parquet(third["fact"]).count() == spark.read.parquet(first["fact"]).count()
