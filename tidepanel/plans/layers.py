"""Stored layers: bronze, silver and gold tables that any later session reads.

Each table lies under ``<store>/<layer>/<name>/<version>``. The version is a
digest of the files the table was made from (path, size, time of change) or of
the versions of the tables before it, so a table is made anew only if its
inputs have changed, and a table that is there is complete: it is written to
a folder of its own and renamed. The store is the folder in
``spark.tidepanel.store`` of the session, else ``lakes`` in its
``spark.checkpoint.dir``; without either it is a scratch folder (local
sessions only).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.operators.deltas import merged, refresh_deltas
from tidepanel.plans import gold, panels, silver
from tidepanel.session import file_system, scratch_dir
from tidepanel.sources.colocated import is_colocated, read_colocated, write_colocated
from tidepanel.sources.sinks import write_table

SORT = ["country_code", "year"]
LAYOUT = "2"  # of the stored tables; raised when what is stored changes
KEY = ["country_code", "year"]
ROW = "source_row"  # numbers the rows of a bronze table in the order they were landed
_SCRATCH_STORE: dict[str, str] = {}


def build_silver_co2(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_co2(panels.panel_co2(spark, d), KEY)  # the panels have one row per key: any order does


def build_silver_tourism(spark: SparkSession, d: str, line_agg: DataFrame | None = None) -> DataFrame:
    return silver.silver_tourism(panels.panel_tourism(spark, d, line_agg), KEY)


def build_silver_transport(spark: SparkSession, d: str, line_agg: DataFrame | None = None) -> DataFrame:
    return silver.silver_transport(silver.bronze_transport_wide(panels.panel_transport_long(spark, d, line_agg)), KEY)


def store_dir(spark: SparkSession) -> str:
    """The session's folder for stored layers."""
    own = spark.conf.get("spark.tidepanel.store", None)
    if own:
        return own.rstrip("/")
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/lakes"
    return _SCRATCH_STORE.setdefault(spark.sparkContext.applicationId, scratch_dir(spark, "lakes"))


def _digest(*parts: str) -> str:
    return hashlib.sha256("\n".join((LAYOUT, *parts)).encode()).hexdigest()[:20]


def _input_version(spark: SparkSession, d: str, table: str) -> str:
    fs, path = file_system(spark, f"{d.rstrip('/')}/{table}.parquet")
    files, found = [], fs.listFiles(path, True)  # also in folders below, as of a partitioned table
    while found.hasNext():
        files.append(found.next())
    return _digest(*sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files))


def _stored(spark: SparkSession, folder: str, version: str, build: Callable[[], DataFrame], sort=SORT) -> str:
    """Path of the table of this version, made if it is not there."""
    done = f"{folder}/{version}"
    fs, path = file_system(spark, done)
    # the writer's mark comes last; where a rename is a copy of files, a folder without it is not complete
    whole = file_system(spark, f"{done}/_SUCCESS")[1]
    if not fs.exists(whole):
        making = f"{folder}/.making-{uuid.uuid4().hex[:12]}"
        _, temp = file_system(spark, making)
        try:
            write_table(build(), making, sort)
            # another session may have been faster: then its table is the one
            if not fs.exists(whole):
                fs.delete(path, True)
                fs.rename(temp, path)
        finally:
            fs.delete(temp, True)
    return done


def _once(make: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
    """``make``, run by the first of several threads that ask."""
    lock, made = Lock(), []

    def get() -> DataFrame:
        with lock:
            if not made:
                made.append(make())
            return made[0]

    return get


def lake(spark: SparkSession, d: str, base: str | None = None) -> dict[str, str]:
    """Paths of the stored tables for the inputs in ``d``, made where they are missing or out of date."""
    base = (base or store_dir(spark)).rstrip("/")
    v = {t: _input_version(spark, d, t) for t in ("orders", "customer", "nation", "region", "lineitem", "supplier")}
    read = lambda p: spark.read.parquet(p)

    def layer(name: str, version: str, bronze: Callable[[], DataFrame], to_silver) -> dict[str, str]:
        b = _stored(spark, f"{base}/bronze/{name}", version, lambda: bronze().withColumn(ROW, F.monotonically_increasing_id()))
        return {"bronze": b, "silver": _stored(spark, f"{base}/silver/{name}", _digest(version), lambda: to_silver(read(b), ROW))}

    def added(name: str, as_name: str, partial, by: list[str], sums: list[str]) -> DataFrame:
        """An aggregate of a raw table from its files' deltas: only files that are new are read."""
        return merged(refresh_deltas(spark, f"{d.rstrip('/')}/{name}.parquet", f"{base}/deltas/{as_name}", partial).rows, by, sums)

    def supplier_side() -> dict[str, str]:
        # one lineitem scan feeds both supplier-side panels
        version = _digest(_digest(v["lineitem"]), v["supplier"], v["nation"])
        lines = _once(lambda: added("lineitem", "line_supplier_year_flag", panels.lines_agg, panels.LINES_BY, panels.LINES_SUMS))
        with ThreadPoolExecutor(2) as pool:
            t, m = pool.map(lambda f: f(), [
                lambda: layer("tourism_arrivals", version, lambda: panels.panel_tourism(spark, d, lines()), silver.silver_tourism),
                lambda: layer("transport_mode", version, lambda: silver.bronze_transport_wide(panels.panel_transport_long(spark, d, lines())), silver.silver_transport)])
        return {"bronze_tourism": t["bronze"], "silver_tourism": t["silver"], "bronze_transport": m["bronze"], "silver_transport": m["silver"]}

    # independent branches run as concurrent Spark jobs (the scheduler shares the executors)
    with ThreadPoolExecutor(3) as pool:
        co2, sides, dim = pool.map(lambda f: f(), [
            lambda: layer("co2_emissions", _digest(v["orders"], v["customer"], v["nation"]), lambda: panels.panel_co2(spark, d, added("orders", "orders_customer_year", panels.orders_customer_agg, panels.ORDERS_BY, panels.ORDERS_SUMS)), silver.silver_co2),
            supplier_side,
            lambda: _stored(spark, f"{base}/gold/dim_country", _digest(v["nation"], v["region"]), lambda: panels.dim_country(spark, d), ["country_code"])])
    paths = {"bronze_co2": co2["bronze"], "silver_co2": co2["silver"], **sides, "dim": dim}
    paths["fact"] = _stored(spark, f"{base}/gold/fact_tourism_emissions", _digest(*[paths[f"silver_{n}"] for n in ("co2", "tourism", "transport")]),
                            lambda: gold.gold_fact(*[read(paths[f"silver_{n}"]) for n in ("co2", "tourism", "transport")]))
    return paths


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(lake(spark, d)[name])


def colocated_silver(spark: SparkSession, d: str, base: str | None = None, buckets: int | None = None) -> dict[str, DataFrame]:
    """The silver tables bucketed by entity and sorted by period, made where they are missing or out of date.

    Their joins, groupings and windows by entity need no exchange, the fact among them. As many buckets as the
    session has shuffle partitions, unless given: tables meet only with the same number.
    """
    base, buckets = (base or store_dir(spark)).rstrip("/"), buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths, out = lake(spark, d, base), {}
    for name in ("silver_co2", "silver_tourism", "silver_transport"):
        folder = f"{base}/colocated/{name}"
        done = f"{folder}/{_digest(paths[name], str(buckets))}"
        if not is_colocated(spark, done):
            fs, path = file_system(spark, done)
            making = f"{folder}/.making-{uuid.uuid4().hex[:12]}"
            temp = file_system(spark, making)[1]
            try:
                write_colocated(spark.read.parquet(paths[name]), making, ["country_code"], ["year"], buckets)
                if not is_colocated(spark, done):  # another session may have been faster
                    fs.delete(path, True)
                    fs.rename(temp, path)
            finally:
                fs.delete(temp, True)
        out[name] = read_colocated(spark, done)
    return out
