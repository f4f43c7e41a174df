"""Readers for landed and layered data (IO1–IO7).

Every reader returns a lazy DataFrame; filters applied afterwards reach the
Parquet scan (PushedFilters / partition pruning), and only the selected
columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.functions.numeric import to_numeric
from tidepanel.functions.text import alias_lookup
from tidepanel.session import data_files


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                     period: str = "year", entity: str | None = "country_code") -> DataFrame:
    """IO1: every Parquet file under a Hive-partitioned prefix.

    Partition inference would type ``year=1997`` as int; the period is forced
    to bigint and the entity to string (or pass a full ``schema``).
    """
    r = spark.read.option("basePath", path)
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    casts = {}
    if period in df.columns:
        casts[period] = F.col(period).cast("bigint")
    if entity and entity in df.columns:
        casts[entity] = F.col(entity).cast("string")
    return df.withColumns(casts) if casts else df


def read_tree(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """IO2: all Parquet files below one or more folders, unioned by column name.

    Columns absent from a file are NULL. Files whose schemas merge are one
    scan. Where files type a column differently, those of one schema are
    scanned with it and the column is widened: integers to the larger one,
    numbers to double, all else to string.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups = [g for p in paths for g in _alike(spark, [p])]
    columns: dict[str, list[T.DataType]] = {}
    for schema, _ in groups:
        for f in schema.fields:
            columns.setdefault(f.name, []).append(f.dataType)
    wide = {c: reduce(wider, types) for c, types in columns.items()}
    frames = [_below(spark, files, schema).select(*[F.col(f"`{f.name}`").cast(wide[f.name]).alias(f.name) for f in schema.fields]) for schema, files in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _below(spark: SparkSession, files: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    return (r.schema(schema) if schema is not None else r).parquet(*files)


def _alike(spark: SparkSession, paths: list[str], few: int = 64) -> list[tuple[T.StructType, list[str]]]:
    """(schema, files) of groups whose schemas merge. Footers are read by Spark's own merge, of halves where it fails."""
    try:
        return [(_below(spark, paths).schema, paths)]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    files = [f for p in paths for f in data_files(spark, p) if f.endswith(".parquet")]
    if len(files) > few:
        found = [g for half in (files[:len(files) // 2], files[len(files) // 2:]) for g in _alike(spark, half, few)]
    else:
        with ThreadPoolExecutor(8) as pool:
            found = list(zip(pool.map(lambda f: _below(spark, [f]).schema, files), [[f] for f in files]))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, own in found:
        groups.setdefault(schema.simpleString(), (schema, []))[1].extend(own)
    return list(groups.values())


_WHOLE = ["tinyint", "smallint", "int", "bigint"]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    x, y = a.simpleString(), b.simpleString()
    if x == y:
        return a
    if x in _WHOLE and y in _WHOLE:
        return max(a, b, key=lambda t: _WHOLE.index(t.simpleString()))
    number = lambda t: t in _WHOLE or t in ("float", "double") or t.startswith("decimal")
    return T.DoubleType() if number(x) and number(y) else T.StringType()


def file_schemas(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """The schemas of the Parquet files below ``path``, without partition columns: groups of files whose schemas merge."""
    return _alike(spark, [path])


def read_single(spark: SparkSession, path: str, period: str = "year") -> DataFrame:
    """IO3: one Parquet table; the period coerced to a nullable bigint."""
    df = spark.read.parquet(path)
    return df.withColumn(period, to_numeric(period, "bigint")) if period in df.columns else df


def read_schema_override(spark: SparkSession, path: str, schema: T.StructType | str,
                         base_path: str | None = None) -> DataFrame:
    """IO4: read with a fixed schema; columns absent from the files read as NULL."""
    r = spark.read.schema(schema)
    if base_path:
        r = r.option("basePath", base_path)
    return r.parquet(path)


def read_csv_wide(spark: SparkSession, path: str, numeric: Sequence[str] = (), integer: Sequence[str] = ()) -> DataFrame:
    """IO5: wide CSV with a header. Everything is read as text (no inference
    pass over the data) and coerced with ``try_cast`` — a malformed cell
    becomes NULL instead of failing the job."""
    df = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    casts = {c: to_numeric(c) for c in numeric if c in df.columns}
    casts.update({c: to_numeric(c, "bigint") for c in integer if c in df.columns})
    return df.withColumns(casts) if casts else df


# Nested indicator record (one JSON object per line).
INDICATOR_SCHEMA = T.StructType([
    T.StructField("indicator", T.StructType([T.StructField("id", T.StringType()),
                                             T.StructField("value", T.StringType())])),
    T.StructField("country", T.StructType([T.StructField("id", T.StringType()),
                                           T.StructField("value", T.StringType())])),
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def read_json_pages(spark: SparkSession, path: str, whole_file: bool = False,
                    schema: T.StructType = INDICATOR_SCHEMA) -> DataFrame:
    """Raw API pages ``[ {page metadata}, [record, ...] ]`` -> one row per record.

    Each page (one per line, or one per file with ``whole_file``) is parsed
    with ``from_json``; the second element holds the records, which are
    exploded. Pages are independent, so the work spreads over files/lines.
    """
    raw = spark.read.option("wholetext", str(whole_file).lower()).text(path)
    page = F.from_json(F.col("value"), "array<string>")
    recs = F.from_json(F.element_at(page, 2), T.ArrayType(schema))
    return raw.select(F.explode(recs).alias("r")).select("r.*")


def read_json_indicator(spark: SparkSession, path: str, value_col: str, members, start: int | None = None, end: int | None = None,
                        aliases: Mapping[str, str] | None = None, codes: Mapping[str, str] | None = None,
                        multiline: bool = False, layout: str = "lines") -> DataFrame:
    """IO6: nested indicator records -> (country, country_code, year, value_col).

    ``layout="lines"``: one record per JSON line (or ``multiline`` documents);
    ``layout="pages"``: raw API pages (see ``read_json_pages``).
    Drops aggregates (country id length != 2), members not in ``members``,
    unparsable or out-of-range years (without ``start`` / ``end``: no range); a NULL value is kept. ``codes`` maps the
    canonical name to a code (fallback: the record's own iso3 code).
    ``members`` may be a list or a one-column DataFrame (left-semi join).
    """
    if layout == "pages":
        raw = read_json_pages(spark, path, whole_file=multiline)
    else:
        raw = spark.read.schema(INDICATOR_SCHEMA).option("multiLine", str(multiline).lower()).json(path)
    name = alias_lookup(F.col("country.value"), aliases or {})
    df = raw.select(F.col("country.id").alias("__iso2"), name.alias("country"),
                    F.col("countryiso3code").alias("__iso3"), to_numeric("date", "int").alias("year"),
                    F.col("value").cast("double").alias(value_col))
    df = df.where((F.length("__iso2") == 2) & F.col("year").isNotNull())
    df = df if start is None else df.where(F.col("year") >= start)
    df = df if end is None else df.where(F.col("year") <= end)
    if isinstance(members, DataFrame):
        df = df.join(members.select(F.col(members.columns[0]).alias("country")).distinct(), "country", "left_semi")
    else:
        df = df.where(F.col("country").isin(list(members)))
    code = F.col("__iso3")
    if codes:
        m = F.create_map(*[x for k, v in codes.items() for x in (F.lit(k), F.lit(v))])
        code = F.coalesce(F.try_element_at(m, F.col("country")), code)
    return df.select("country", code.alias("country_code"), F.col("year").cast("bigint").alias("year"), value_col)


def read_long_indicators(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """IO7: long sheet (reporter_area_label, year, indicator_label, value) landed as CSV or Parquet."""
    if fmt == "csv":
        df = spark.read.option("header", "true").csv(path)
        return df.withColumns({"year": to_numeric("year", "bigint"), "value": to_numeric("value")})
    return spark.read.parquet(path)
