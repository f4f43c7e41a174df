"""Incremental landed-file ingestion: each availableNow run reads only new files."""

from tidepanel.streaming import ingest_landed


def test_incremental_runs_exactly_once(spark, tmp_path):
    landing, bronze, ckpt = str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    schema = "country_code string, year bigint, v double"
    spark.createDataFrame([("A", 2020, 1.0), ("B", 2020, 2.0)], schema).write.option("header", "true").csv(landing)
    assert ingest_landed(spark, landing, schema, bronze, ckpt).rows == 2
    assert ingest_landed(spark, landing, schema, bronze, ckpt).rows == 0  # nothing new
    spark.createDataFrame([("C", 2021, 3.0)], schema).write.mode("append").option("header", "true").csv(landing)
    assert ingest_landed(spark, landing, schema, bronze, ckpt).rows == 1
    back = spark.read.parquet(bronze)
    assert sorted((r.country_code, r.year) for r in back.collect()) == [("A", 2020), ("B", 2020), ("C", 2021)]


def test_a_batch_that_fails_its_gate_is_not_committed(spark, tmp_path):
    landing, bronze, ckpt = str(tmp_path / "l"), str(tmp_path / "b"), str(tmp_path / "c")
    schema = "country_code string, year bigint, v double"
    spark.createDataFrame([("D", 2021, 2.0)], schema).write.option("header", "true").csv(landing)
    assert ingest_landed(spark, landing, schema, bronze, ckpt, gate={"v": 30.0}) == (1, [])
    spark.createDataFrame([("A", 2020, None), ("B", 2020, None), ("C", 2020, 1.0)], schema).coalesce(1).write.mode("append").option("header", "true").csv(landing)
    res = ingest_landed(spark, landing, schema, bronze, ckpt, gate={"v": 30.0, "absent": 100.0, "gone": 5.0})
    assert res.rows == 3 and [bad for _, bad in res.violations] == [["v", "gone"]]
    assert [r.country_code for r in spark.read.parquet(bronze).collect()] == ["D"]


def test_every_batch_is_counted(spark, tmp_path):
    landing, bronze, ckpt = str(tmp_path / "l"), str(tmp_path / "b"), str(tmp_path / "c")
    schema = "country_code string, year bigint, v double"
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")  # what Spark itself remembers does not matter
    try:
        spark.createDataFrame([(f"E{i}", 2020, None) for i in range(6)], schema).repartition(6, "country_code").write.option("maxRecordsPerFile", 1).option("header", "true").csv(landing)
        res = ingest_landed(spark, landing, schema, bronze, ckpt, max_files_per_trigger=1, gate={"v": 30.0})
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert res.rows == 6 and len(res.violations) == 6
