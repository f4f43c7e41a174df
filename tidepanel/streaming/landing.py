"""Incremental ingestion of landed files into bronze (Structured Streaming).

Landed sources are ingested on a schedule. The Spark form of that is a
file-source stream run with ``trigger(availableNow=True)``: each run picks up
only the files that landed since the previous run (the checkpoint remembers
what was read), applies the stateless bronze typing and filtering, and commits
batch by batch. A batch has a folder of its own that it overwrites, so a run
that dies half-way and is restarted leaves its rows once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.quality import gate_metrics, gate_violations
from tidepanel.session import file_system


class IngestResult(NamedTuple):
    rows: int
    violations: list  # [(batch_id, [column, ...]), ...]


def ingest_landed(spark: SparkSession, landing_dir: str, schema: T.StructType | str, bronze_path: str,
                  checkpoint: str, fmt: str = "csv", transform: Callable[[DataFrame], DataFrame] | None = None,
                  partition_cols: Sequence[str] = ("year",), max_files_per_trigger: int | None = None,
                  gate: Mapping[str, float] | None = None) -> IngestResult:
    """Process every not-yet-ingested file of ``landing_dir`` and stop.

    Each micro-batch is written to ``bronze_path`` under ``batch_id=<n>/``; a
    batch that runs again after a failure replaces what it had written. With
    ``gate`` (column -> max NULL %; a missing column fails) a batch is first
    written to a staging folder next to the checkpoint, its NULL shares are
    measured there, and only then is it written to bronze. A batch that fails
    stays in staging (a batch without rows is none) and is named in ``IngestResult.violations``. Every batch
    reports its own row, however many there are.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing_dir)
    out = transform(stream) if transform else stream
    results: list[tuple[int, int, list[str]]] = []

    def commit(batch: DataFrame, batch_id: int) -> None:
        staged = f"{checkpoint.rstrip('/')}-staged/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(batch.schema).parquet(staged)
        cols = [c for c in gate or {} if c in batch.columns]
        metrics = rows.agg(*gate_metrics(cols)).first().asDict()
        bad = gate_violations(metrics, gate) if gate and metrics["rows"] else []
        if metrics["rows"] and not bad:
            (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id", *partition_cols).parquet(bronze_path))
        if not bad:  # a batch that fails stays, to be looked at
            fs, folder = file_system(spark, staged)
            fs.delete(folder, True)
        results.append((batch_id, metrics["rows"], bad))

    out.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(commit).start().awaitTermination()
    return IngestResult(sum(n for _, n, _ in results), [(b, bad) for b, _, bad in results if bad])
