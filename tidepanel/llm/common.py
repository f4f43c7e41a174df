"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.session import scratch_dir

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, partition_by: str | None = None, rows_at_once: int | None = None) -> DataFrame:
    """Write ``df`` once into the cluster's shared folder and read it back.

    Cuts the lineage: what follows reads files that outlive any executor, and
    a stage that is not deterministic under retry is computed only once.
    ``rows_at_once`` bounds how many rows a writer holds, for rows of megabytes.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    writer = df.write.mode("overwrite")
    if rows_at_once:
        writer = writer.option("parquet.block.row.count.limit", rows_at_once)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, as ``--py-files`` would."""
    context = spark.sparkContext
    if any(str(f).startswith("tidepanel-") for f in context._python_includes):
        return
    top = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(), "tidepanel-package.zip")  # on the driver, which serves it to the executors
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    context.addPyFile(path)


def release() -> None:
    """Give freed memory back to the system: Arrow's and, through the pool of malloc, numpy's and the tokenizers'."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def releasing(fn):
    """``fn`` of batches, with ``release`` after each batch it is done with and at the end.

    Allocators keep what a batch's temporary arrays took, in every worker and
    also between the stages of a job, as Spark's workers live on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                release()

        yield from fn(passed())
        release()

    return run


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` of a function of this package, 4 MB a batch unless the session says otherwise.

    Spark's own limits (10,000 rows, 64 MB) let the executor hold hundreds of
    megabytes outside its heap for texts of kilobytes, and keep them after.
    Workers give back what they have freed after each batch.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, "4m")  # read when the plan runs
    return df.mapInArrow(releasing(fn), schema)


def met_by_block(blocks: DataFrame, queries: DataFrame, n_blocks: int, fn, schema: str) -> DataFrame:
    """``fn`` over every row of ``queries`` with every block, as an Arrow stream.

    ``blocks`` has a row for each (or some) of the numbers 0 to ``n_blocks`` - 1
    in its column ``block``; all columns of both tables are in the stream, where
    a block's rows (``first`` is true) come before the queries it meets. A task
    holds one block; queries pass by. Blocks are bounded, so what is sent is a
    query a block: a small part of the work of meeting it.
    """
    sent = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumn("first", F.lit(False))
    rows = blocks.withColumn("first", F.lit(True)).unionByName(sent, allowMissingColumns=True)
    # a number of its own: the work of a partition does not show in its bytes, so small ones must not be joined
    return map_arrow(rows.repartition(min(2 * n_blocks, 8192), "block").sortWithinPartitions("block", F.desc("first")), fn, schema)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def prefix_sums(values: Column, block: int = 128) -> Column:
    """Running totals of an array of longs, 0 first, in time linear in its size but for one copy per block.

    Totals of blocks come first, then the totals within each block.
    """
    zero = F.lit(0).cast("long")

    def places(xs: Column, b: Column) -> Column:
        return F.sequence(b * block, F.least(b * block + block, F.size(xs)) - 1)

    def by_block(xs: Column) -> Column:  # never empty
        blocks = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda b: F.aggregate(places(xs, b), zero, lambda x, j: x + F.get(xs, j)))
        firsts = F.aggregate(sums, F.array(zero), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return let(firsts, lambda fs: F.flatten(F.transform(blocks, lambda b: F.aggregate(
            F.filter(places(xs, b), lambda j: j > b * block), F.array(F.get(fs, b)), lambda acc, j: F.concat(acc, F.array(F.element_at(acc, -1) + F.get(xs, j - 1)))))))

    return let(F.concat(values, F.array(zero)), by_block)


def free(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(docs: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """Rows of ``docs`` whose ``key`` (never NULL) is not in the one column of ``keys``.

    Up to a million keys (8 MB) are sent to the rows; more are joined by a shuffle.
    """
    gone, own = free(docs, "_gone"), free(docs, "_key")
    found = saved(keys.toDF(gone).distinct(), "gone")
    if found.count() <= 1_000_000:
        found = F.broadcast(found)
    return docs.withColumn(own, key).join(found, F.col(own) == F.col(gone), "left_anti").drop(own)


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart also where ids are missing or repeated: rows alike in id and text share it."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL ids: fold of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def chunks(sizes, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit``; a larger item is a range of its own."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
