"""Writers: layered tables, open-data exports, metadata and reports (IO8–IO13).

Writes go through the Hadoop FS of the cluster (no single-file collect, no
driver-side bytes). Partitioned writes use the ``REBALANCE`` hint: rows are
clustered by the partition keys, and AQE splits a partition value that holds
a large share of the data into several files while merging small ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidepanel.functions.numeric import np_round
from tidepanel.operators.quality import gate_metrics, gate_violations, null_profile
from tidepanel.session import data_files, file_system


def _laid_out(df: DataFrame, keys: list[str], sort_cols: Sequence[str]) -> DataFrame:
    sort = [c for c in sort_cols if c in df.columns and c not in keys]
    # the writer wants rows in the order of its folders and sorts anew, losing ours, unless that comes first
    return df.sortWithinPartitions(*keys, *sort) if sort else df


def write_bronze_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = ("year",),
                             sort_cols: Sequence[str] = ("country_code",), mode: str = "overwrite") -> int:
    """IO8: Hive-partitioned Snappy Parquet, replacing only the partitions present. Returns the number of files written.

    Default layout is ``year=`` with rows sorted by entity inside the files
    (entity × year directories make tiny files at scale).
    """
    keys, spark = list(partition_cols), df.sparkSession
    before = set(data_files(spark, path))
    (_laid_out(df.hint("rebalance", *keys), keys, sort_cols).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy").partitionBy(*keys).parquet(path))
    return sum(f not in before for f in data_files(spark, path))  # a writer's file names are its own


@dataclass(frozen=True)
class Landed:
    """What a gated write has done."""

    rows: int
    files: int
    partitions: int


class GateError(ValueError):
    """A source that its gate refused; ``failed`` names its columns."""

    def __init__(self, failed: list[str]):
        super().__init__(f"ingest gate failed for: {failed}")
        self.failed = failed


def write_gated(df: DataFrame, path: str, max_null_pct: Mapping[str, float], partition_cols: Sequence[str] = ("year",),
                sort_cols: Sequence[str] = ("country_code",)) -> Landed:
    """DQ11 + IO8: judge ``df`` while it is written; what the gate refuses leaves nothing behind.

    The source runs once: rows and NULLs are counted by the write itself, into
    a hidden folder inside ``path`` that readers pass over. If all columns of
    ``max_null_pct`` are there and below their limits, and there are rows, the
    new partition folders replace those of the same keys, one rename each;
    else the folder is removed and ``GateError`` raised. (Renames are atomic
    on HDFS, not on object stores, where a reader may see a partition in
    between.) Counts are taken behind the last shuffle, where the rows of a
    repeated task count once.
    """
    keys, spark = list(partition_cols), df.sparkSession
    absent = [c for c in max_null_pct if c not in df.columns]
    if absent:
        raise GateError(absent)
    seen = Observation()
    staged = f"{path.rstrip('/')}/.landing-{uuid.uuid4().hex[:12]}"
    fs, folder = file_system(spark, staged)
    try:
        counted = df.hint("rebalance", *keys).observe(seen, *gate_metrics(list(max_null_pct)))
        _laid_out(counted, keys, sort_cols).write.option("compression", "snappy").partitionBy(*keys).parquet(staged)
        metrics = seen.get
        failed = gate_violations(metrics, max_null_pct)
        if failed:
            raise GateError(failed)
        files = data_files(spark, staged)
        parts = sorted({f.rsplit("/", 1)[0] for f in files})
        for part in parts:
            _, own = file_system(spark, part)
            _, target = file_system(spark, f"{path.rstrip('/')}/{part.split(staged.rsplit('/', 1)[1] + '/', 1)[1]}")
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(own, target):
                raise OSError(f"cannot move {part} to its place")
        return Landed(int(metrics["rows"]), len(files), len(parts))
    finally:
        fs.delete(folder, True)


def write_table(df: DataFrame, path: str, sort_cols: Sequence[str] = ()) -> None:
    """IO9: overwrite a Snappy Parquet table (a folder of part files)."""
    out = df.sortWithinPartitions(*sort_cols) if sort_cols else df
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def export_open_data(df: DataFrame, base: str, version: str, layer: str, table: str,
                     docs: Mapping[str, tuple[str, str]] | None = None, info: Mapping[str, str] | None = None,
                     run_date: str | None = None) -> dict[str, str]:
    """IO10: Parquet + CSV (with header) under ``<base>/<version>/<layer>/<table>/``.

    With ``docs`` (column -> (unit, description)) it also writes
    ``metadata.json`` (IO11) and ``data_dictionary.md`` (IO12) through the
    text sink — each is a folder holding one small part file. ``df`` runs
    once: all but the Parquet files are made from these.
    """
    root = f"{base.rstrip('/')}/{version}/{layer}/{table}"
    out = {"parquet": f"{root}/parquet", "csv": f"{root}/csv", "root": root}
    df.write.mode("overwrite").parquet(out["parquet"])
    df = df.sparkSession.read.schema(df.schema).parquet(out["parquet"])
    df.write.mode("overwrite").option("header", "true").csv(out["csv"])
    if docs is not None:
        info = dict(info or {})
        out["metadata"], out["dictionary"] = f"{root}/metadata.json", f"{root}/data_dictionary.md"
        meta = open_data_metadata(df, table, version, docs, info, {"parquet": out["parquet"], "csv": out["csv"]},
                                  run_date)
        meta.repartition(1).write.mode("overwrite").text(out["metadata"])
        md = dictionary_markdown(data_dictionary(df, docs), table, version, info, run_date)
        md.repartition(1).sortWithinPartitions("line").select("value").write.mode("overwrite").text(out["dictionary"])
    return out


def open_data_metadata(df: DataFrame, table: str, version: str, docs: Mapping[str, tuple[str, str]],
                       info: Mapping[str, str], formats: Mapping[str, str], run_date: str | None,
                       entity: str = "country_code", period: str = "year") -> DataFrame:
    """One JSON line: identity, licence, coverage, formats, NULL % (r1) and schema per column (one pass).

    Coverage: members, first and last period (where the table has such
    columns), rows and columns.
    """
    types = dict(df.dtypes)
    where = [F.array_sort(F.collect_set(entity)).alias("__members")] if entity in types else [F.lit(None).cast("array<string>").alias("__members")]
    when = [f(period).cast("bigint").alias(f"__{n}") for f, n in ((F.min, "first"), (F.max, "last"))] if period in types \
        else [F.lit(None).cast("bigint").alias(f"__{n}") for n in ("first", "last")]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *where, *when,
                 *[F.avg(F.col(c).isNull().cast("double")).alias(f"__n{i}") for i, c in enumerate(df.columns)])
    null_pct = F.create_map(*[x for i, c in enumerate(df.columns)
                              for x in (F.lit(c), np_round(F.coalesce(F.col(f"__n{i}"), F.lit(0.0)) * 100.0, 1))])
    schema = F.create_map(*[x for c in df.columns
                            for x in (F.lit(c), F.struct(F.lit(types[c]).alias("type"),
                                                         F.lit(docs.get(c, ("", ""))[0]).alias("unit"),
                                                         F.lit(docs.get(c, ("", ""))[1]).alias("description")))])
    obj = F.struct(F.lit(table).alias("dataset_id"), F.lit(version).alias("version"),
                   *[F.lit(v).alias(k) for k, v in info.items()],
                   F.lit(run_date).alias("last_updated"), F.col("__rows").alias("rows"),
                   F.struct(F.col("__members").alias("countries"), F.col("__first").alias("year_start"), F.col("__last").alias("year_end"),
                            F.col("__rows").alias("rows"), F.lit(len(df.columns)).alias("columns")).alias("coverage"),
                   F.struct(*[F.lit(v).alias(k) for k, v in formats.items()]).alias("formats"),
                   null_pct.alias("null_pct"), schema.alias("schema"))
    return one.select(F.to_json(obj).alias("value"))


def dictionary_markdown(dictionary: DataFrame, table: str, version: str, info: Mapping[str, str],
                        run_date: str | None) -> DataFrame:
    """The data dictionary as Markdown lines (``line`` orders them)."""
    head = [f"# Data Dictionary — {table} ({version})", ""]
    head += [f"**{k}:** {v}" for k, v in info.items()] + ["", "| Column | Type | Unit | Description | Null % |",
                                                          "|--------|------|------|-------------|--------|"]
    tail = ["", f"*Generated on {run_date}*"] if run_date else []
    spark = dictionary.sparkSession
    lit_rows = spark.createDataFrame([(i, t) for i, t in enumerate(head)] +
                                     [(100_000 + i, t) for i, t in enumerate(tail)], "line int, value string")
    body = dictionary.select((F.col("ordinal") + len(head)).alias("line"),
                             F.format_string("| `%s` | %s | %s | %s | %.1f%% |", "column", "type",
                                             F.when(F.col("unit") == "", "—").otherwise(F.col("unit")),
                                             F.when(F.col("description") == "", "—").otherwise(F.col("description")),
                                             "null_pct").alias("value"))
    return lit_rows.unionByName(body)


def table_metadata(df: DataFrame, table: str, entity: str = "country_code", period: str = "year") -> DataFrame:
    """IO11: rows, columns, period range and member count; ``table_members`` has the members, as rows."""
    return df.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).alias("n_columns"), F.min(period).alias("period_min"),
                  F.max(period).alias("period_max"), F.countDistinct(entity).alias("n_members"))


def table_members(df: DataFrame, table: str, entity: str = "country_code") -> DataFrame:
    """IO11: the members of a table, however many, one row each."""
    return df.where(F.col(entity).isNotNull()).select(F.lit(table).alias("table"), F.col(entity).alias("member")).distinct()


def data_dictionary(df: DataFrame, docs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """IO12: one row per column — name, type, unit, description, % NULL (one pass)."""
    types = dict(df.dtypes)
    prof = null_profile(df, digits=1)
    meta = F.create_map(*[x for c in df.columns
                          for x in (F.lit(c), F.struct(F.lit(types[c]).alias("type"),
                                                       F.lit(docs.get(c, ("", ""))[0]).alias("unit"),
                                                       F.lit(docs.get(c, ("", ""))[1]).alias("description")))])
    m = F.element_at(meta, F.col("column"))
    return prof.select("ordinal", "column", m["type"].alias("type"), m["unit"].alias("unit"),
                       m["description"].alias("description"), "null_pct")


def write_report(report: DataFrame, path: str, run_date: str) -> str:
    """IO13: a report (any DataFrame) as JSON lines under ``run_date=<d>/``; a report of that date is replaced."""
    (report.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").json(path))
    return f"{path.rstrip('/')}/run_date={run_date}"
