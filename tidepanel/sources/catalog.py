"""Make layered tables visible to SQL (IO14).

With a database, a table is external: it stands over a folder of Parquet
files. A table that is there already is brought up to date in place, so that
it is never gone: new columns are added, wider types are taken over, and only
partitions that are new are registered.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidepanel.session import data_files, file_system
from tidepanel.sources.readers import file_schemas, wider


class TableChange(NamedTuple):
    """What ``update_table`` did."""

    created: bool
    added: list[str]
    widened: list[str]
    partitions: int


# fixed values: type -> those that Parquet readers widen it to
_WIDENED = {"tinyint": {"smallint", "int", "bigint", "double"}, "smallint": {"int", "bigint", "double"}, "int": {"bigint", "double"}, "float": {"double"}}


def _partitions(spark: SparkSession, path: str, cols: list[str]) -> dict[tuple[str, ...], str]:
    """Values of the partition columns -> folder, of the folders that hold files."""
    top = file_system(spark, path)[0].getFileStatus(file_system(spark, path)[1]).getPath().toString()
    out = {}
    for f in data_files(spark, path):
        folder = f.rsplit("/", 1)[0]
        pairs = [p.split("=", 1) for p in folder[len(top):].strip("/").split("/") if "=" in p]
        if [p[0].lower() for p in pairs] == [c.lower() for c in cols]:
            out[tuple(unquote(p[1]) for p in pairs)] = folder
    return out


def _quoted(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(keys: list[str], values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"`{k}` = " + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else _quoted(v)) for k, v in zip(keys, values)) + ")"


def update_table(spark: SparkSession, database: str, name: str, path: str) -> TableChange:
    """Register the folder ``path`` as ``database``.``name``, or bring the table there up to date.

    Columns that new files have are added behind the others, and types are
    widened where Parquet readers can read the older files with them; any
    other change of a type, or of the partition columns, fails before anything
    is changed. Columns that files no longer have stay and are NULL. New
    partition folders are registered, those there stay as they are. A table
    that stood over another folder is moved, with its partitions.
    """
    full = f"`{database}`.`{name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    files: dict[str, T.DataType] = {}
    for schema, _ in file_schemas(spark, path):
        for f in schema.fields:
            files[f.name] = wider(files.get(f.name, f.dataType), f.dataType)
    taken = {c.lower() for c in files}
    folders = [f for f in spark.read.parquet(path).schema.fields if f.name.lower() not in taken]
    keys = [f.name for f in folders]
    if not spark.catalog.tableExists(f"{database}.{name}"):
        columns = ", ".join(f"`{c}` {t.simpleString()}" for c, t in [*files.items(), *[(f.name, f.dataType) for f in folders]])
        parted = f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet {parted} LOCATION {_quoted(path)}")
        if keys:
            spark.catalog.recoverPartitions(full)
        return TableChange(True, list(files), [], len(_partitions(spark, path, keys)) if keys else 0)
    columns = spark.catalog.listColumns(f"{database}.{name}")
    known = {c.name.lower(): c for c in columns if not c.isPartition}
    if [c.name.lower() for c in columns if c.isPartition] != [k.lower() for k in keys]:
        raise ValueError(f"{full}: partitioned by {[c.name for c in columns if c.isPartition]}, the folder by {keys}")
    added = {c: t for c, t in files.items() if c.lower() not in known}
    changed = {c: (known[c.lower()].dataType, t) for c, t in files.items() if c.lower() in known and t.simpleString() != known[c.lower()].dataType}
    widened = {c: t for c, (old, t) in changed.items() if t.simpleString() in _WIDENED.get(old, ())}
    # files may have a narrower type than the table
    odd = [f"{c}: {old} -> {t.simpleString()}" for c, (old, t) in changed.items() if c not in widened and old not in _WIDENED.get(t.simpleString(), ())]
    if odd:
        raise ValueError(f"{full}: types that cannot be widened: {odd}")
    if widened:
        new = {c.lower(): t for c, t in widened.items()}
        data = T.StructType([T.StructField(f.name, new.get(f.name.lower(), f.dataType)) for f in spark.table(full).schema.fields if f.name.lower() in known])
        # SQL has no statement for it on this kind of table
        jvm = spark._jvm
        ident = jvm.org.apache.spark.sql.catalyst.TableIdentifier(name, jvm.scala.Option.apply(database))
        spark._jsparkSession.sessionState().catalog().alterTableDataSchema(ident, jvm.org.apache.spark.sql.types.DataType.fromJson(data.json()))
    if added:
        spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(f'`{c}` {t.simpleString()}' for c, t in added.items())})")
    location = next(r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {full}").collect() if r["col_name"] == "Location")
    moved = file_system(spark, location)[1].toUri().getPath().rstrip("/") != file_system(spark, path)[1].toUri().getPath().rstrip("/")
    if moved:
        spark.sql(f"ALTER TABLE {full} SET LOCATION {_quoted(path)}")
    fresh: dict[tuple[str, ...], str] = {}
    if keys:
        here = _partitions(spark, path, keys)
        there = {tuple(unquote(p.split("=", 1)[1]) for p in r["partition"].split("/")) for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
        fresh = {v: f for v, f in here.items() if v not in there}
        for values, folder in sorted(fresh.items()):
            spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS PARTITION {_spec(keys, values)} LOCATION {_quoted(folder)}")
        for values in sorted(there) if moved else ():
            spark.sql(f"ALTER TABLE {full} PARTITION {_spec(keys, values)} SET LOCATION {_quoted(here[values])}" if values in here else f"ALTER TABLE {full} DROP PARTITION {_spec(keys, values)}")
    spark.catalog.refreshTable(full)
    return TableChange(False, list(added), list(widened), len(fresh))


def register_tables(spark: SparkSession, tables: Mapping[str, str | DataFrame], database: str | None = None) -> list[str]:
    """Register each table for ``spark.sql``.

    Paths become temp views over Parquet (or, with ``database``, external
    catalog tables at that place: one of the same name is updated, see
    ``update_table``); DataFrames become temp views.
    """
    names = []
    for name, src in tables.items():
        if isinstance(src, DataFrame):
            src.createOrReplaceTempView(name)
        elif database:
            update_table(spark, database, name, src)
        else:
            spark.read.parquet(src).createOrReplaceTempView(name)
        names.append(f"{database}.{name}" if database else name)
    return names
