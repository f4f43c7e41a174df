"""Co-located storage: tables bucketed and sorted by a key, so that joins, groupings and windows on it need no exchange.

Rows of a key lie in the bucket of its hash, a file per bucket. Tables with
the same number of buckets meet bucket by bucket: full outer unions with a
grouping, joins and windows on the key start from the scan. A bucket is read
by one task, so a key must not hold more than a task can take: for panels,
whose entities have a row per period, this is the entity; tables with hot keys
are bucketed by more columns or stay plain, where AQE splits skewed joins.

The layout (columns, buckets, schema) is kept in a hidden file beside the
data. It is written last: a folder without it is not complete. Any session
reads the table through it, with no catalog of its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepanel.session import file_system

LAYOUT_FILE = "_layout.json"


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = file_system(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        raise ValueError(f"no co-located table: {path} is missing")
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _name(path: str, layout: str) -> str:
    return "colocated_" + hashlib.sha256(f"{path}\n{layout}".encode()).hexdigest()[:20]


def write_colocated(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), buckets: int = 200) -> str:
    """Write ``df`` in ``buckets`` files by the hash of ``by``, each sorted by ``by`` and ``sort``; returns ``path``.

    Replaces what is there. NULL keys share a bucket. One shuffle, paid once
    by the writer instead of by every reader.
    """
    spark, path, by = df.sparkSession, path.rstrip("/"), list(by)
    order = [*by, *[c for c in sort if c not in by]]
    missing = [c for c in order if c not in df.columns]
    if missing or not by or buckets < 1:
        raise ValueError(f"cannot bucket by {order} in {buckets}: columns not found: {missing}")
    fs, mark = file_system(spark, f"{path}/{LAYOUT_FILE}")
    fs.delete(mark, False)
    layout = json.dumps({"by": by, "sort": order, "buckets": buckets, "schema": json.loads(df.schema.json())}, sort_keys=True)
    table = "writing_" + _name(path, layout)
    (df.repartition(buckets, *by).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *by).sortBy(*order).saveAsTable(table))
    spark.sql(f"DROP TABLE {table}")  # the entry, not the files: each session that reads makes its own, also where the folder was renamed
    _write_text(spark, f"{path}/{LAYOUT_FILE}", layout)
    return path


def is_colocated(spark: SparkSession, path: str) -> bool:
    """Whether a complete co-located table lies at ``path``."""
    fs, mark = file_system(spark, f"{path.rstrip('/')}/{LAYOUT_FILE}")
    return fs.exists(mark)


def read_colocated(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its buckets known to the planner."""
    path = path.rstrip("/")
    text = _read_text(spark, f"{path}/{LAYOUT_FILE}")
    layout, table = json.loads(text), _name(path, text)
    quoted = lambda cs: ", ".join(f"`{c.replace('`', '``')}`" for c in cs)
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"{quoted([f.name])} {f.dataType.simpleString()}" for f in StructType.fromJson(layout["schema"]).fields)
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet CLUSTERED BY ({quoted(layout['by'])}) "
                  f"SORTED BY ({quoted(layout['sort'])}) INTO {layout['buckets']} BUCKETS LOCATION '{where}'")
    else:
        spark.catalog.refreshTable(table)
    # Spark compares the partitionings of a union's sides with the qualifiers of their columns, which a projection over
    # a catalog table has and the scan below has not; a name of their own (kept apart by its metadata) has none on either
    own = lambda c: F.col(quoted([c])).alias(c, metadata={"bucketed_by": True})
    return spark.table(table).select(*[own(f.name) if f.name in layout["by"] else quoted([f.name]) for f in StructType.fromJson(layout["schema"]).fields])
