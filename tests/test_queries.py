"""Every registered query against its SQL oracle (DuckDB) on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# the library's own queries; those of subpackages have tests of their own
OWN = sorted(E._registry())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v)
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "sustainability_label" in df.columns


def test_every_query_has_a_callable(spark):
    assert len(E.queries()) >= 100
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    spdf = sdf.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(spdf.columns) > 0
        return
    opdf = con.execute(sql).df()
    assert _rows(spdf) == _rows(opdf)


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin",
             "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", OWN)
def test_plan_has_no_python_udf_or_cross_join(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in FORBIDDEN if b in plan]
