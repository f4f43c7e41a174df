"""Aggregates from stored deltas: equal to a rebuild, and only new files are read."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tidepanel.operators.deltas import merged, refresh_deltas


def partial(rows, by):
    return rows.groupBy(*by, "k").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))


def whole(spark, path):
    return sorted(map(tuple, partial(spark.read.option("recursiveFileLookup", "true").parquet(path), []).collect()), key=str)


@pytest.mark.parametrize("name", ["t", "t with space+plus%20"])
def test_only_new_files_are_read(spark, tmp_path, name):
    path, store = str(tmp_path / name), str(tmp_path / "store")
    part = lambda a, b: spark.range(a, b).selectExpr("id % 7 as k", "id as v")
    part(0, 500).repartition(3).write.parquet(path)
    refresh = lambda: refresh_deltas(spark, path, store, partial)
    same = lambda got: sorted(map(tuple, merged(got.rows, ["k"], ["v", "n"]).collect()), key=str) == whole(spark, path)
    first = refresh()
    assert len(first.read) == 3 and same(first)
    assert refresh().read == [] and same(refresh())
    part(500, 900).coalesce(1).write.mode("append").parquet(path)
    part(900, 1000).coalesce(1).write.parquet(f"{path}/below")
    second = refresh()
    assert len(second.read) == 2 and same(second)
    gone = next(f for f in os.listdir(path) if f.endswith(".parquet"))
    os.remove(f"{path}/{gone}")
    third = refresh()
    assert third.read == [] and same(third)


def test_a_batch_that_did_not_end_does_not_count_nor_does_a_second_one(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    spark.range(50).selectExpr("id % 7 as k", "id as v").coalesce(1).write.parquet(path)
    first = refresh_deltas(spark, path, store, partial)
    batch, = os.listdir(store)
    shutil.copytree(f"{store}/{batch}", f"{store}/batch=twice")  # as of another session at the same time
    again = refresh_deltas(spark, path, store, partial)
    assert again.read == [] and sorted(again.rows.collect()) == sorted(first.rows.collect())
    for b in os.listdir(store):
        os.remove(f"{store}/{b}/_SUCCESS")
    assert len(refresh_deltas(spark, path, store, partial).read) == 1


def test_files_without_rows_and_no_files(spark, tmp_path):
    path, store = str(tmp_path / "e"), str(tmp_path / "s")
    spark.range(0).selectExpr("id % 7 as k", "id as v").write.parquet(path)
    assert merged(refresh_deltas(spark, path, store, partial).rows, ["k"], ["v", "n"]).count() == 0
    with pytest.raises(FileNotFoundError):
        refresh_deltas(spark, str(tmp_path / "none"), store, partial)


def test_layers_read_an_appended_file_only(spark, tmp_path):
    from tidepanel.operators import deltas
    from tidepanel.plans import layers

    src, base = tmp_path / "in", str(tmp_path / "lake")
    for t in ("region", "nation", "customer", "supplier"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").coalesce(1).write.parquet(str(src / f"{t}.parquet"))
    orders, lines = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("orders", "lineitem"))
    orders.where("o_orderkey % 3 > 0").coalesce(1).write.parquet(str(src / "orders.parquet"))
    lines.where("l_orderkey % 3 > 0").coalesce(1).write.parquet(str(src / "lineitem.parquet"))
    layers.lake(spark, str(src), base)
    orders.where("o_orderkey % 3 = 0").coalesce(1).write.mode("append").parquet(str(src / "orders.parquet"))
    lines.where("l_orderkey % 3 = 0").coalesce(1).write.mode("append").parquet(str(src / "lineitem.parquet"))
    seen = []
    real = deltas.refresh_deltas
    layers.refresh_deltas = lambda *a: seen.append(real(*a)) or seen[-1]
    try:
        grown = layers.lake(spark, str(src), base)
    finally:
        layers.refresh_deltas = real
    assert [len(s.read) for s in seen] == [1, 1]
    anew = layers.lake(spark, str(src), str(tmp_path / "anew"))
    for t in ("fact", "silver_co2", "silver_tourism", "silver_transport", "dim"):
        a, b = (spark.read.parquet(p[t]) for p in (grown, anew))
        keep = [c for c in a.columns if c != "source_row"]
        assert sorted(map(str, a.select(*keep).collect())) == sorted(map(str, b.select(*keep).collect()))
