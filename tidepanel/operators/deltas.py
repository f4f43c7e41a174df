"""Incremental aggregates: one stored delta per input file, merged when read.

Sums, counts, minima and maxima over a table are merged from those over its
files. A file's delta is kept under a digest of its path, size and time of
change, so after files were added, replaced or removed only the new ones are
read, and the merged result equals one made from all files anew.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.session import data_files, file_system

OF = "__of"


class Deltas(NamedTuple):
    """The deltas of all present files, and the files that had to be read for them."""

    rows: DataFrame
    read: list[str]


def stored_parts(spark: SparkSession, store: str) -> dict[str, str]:
    """Part -> folder, of the parts that ``add_parts`` has written to its end.

    Where two sessions wrote the same part, one of them counts.
    """
    out, whole = {}, {}
    for f in data_files(spark, store):
        batch, part = f.rsplit("/", 3)[1:3]
        if not (batch.startswith("batch=") and part.startswith(f"{OF}=")):
            continue
        if batch not in whole:
            fs, mark = file_system(spark, f"{store.rstrip('/')}/{batch}/_SUCCESS")
            whole[batch] = fs.exists(mark)
        if whole[batch]:
            out.setdefault(part.split("=", 1)[1], f.rsplit("/", 1)[0])
    return out


def add_parts(df: DataFrame, store: str) -> None:
    """Write the rows of ``df`` as parts named by its column ``OF``: a batch of its own, of which all parts or none count."""
    df.write.partitionBy(OF).parquet(f"{store.rstrip('/')}/batch={uuid.uuid4().hex}")


def drop_parts(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        fs, old = file_system(spark, folder)
        fs.delete(old, True)


def _listed(path: Column) -> Column:
    """A file's path as the reader tells it (a URI), in the form Hadoop's file systems list it."""
    return _slashes(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def _slashes(path: Column) -> Column:
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def refresh_deltas(spark: SparkSession, path: str, store: str, partial: Callable[[DataFrame, list[str]], DataFrame]) -> Deltas:
    """The deltas of the Parquet files in ``path`` (a file or a folder of them), kept in ``store``.

    ``partial(rows, by)`` aggregates rows grouped by the columns ``by`` (one
    that tells files apart) and keys of its own. Files without a delta are
    read in one job, the others not at all; deltas of files that are gone or
    replaced are removed. A file without rows has no delta and costs a look.
    """
    fs, top = file_system(spark, path)
    if not fs.exists(top):
        raise FileNotFoundError(path)
    found, now = fs.listFiles(top, True), {}
    seen = set(data_files(spark, path))
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString()
        if name in seen:
            now[name] = hashlib.sha256(f"{name} {f.getLen()} {f.getModificationTime()}".encode()).hexdigest()[:24]
    there = stored_parts(spark, store)
    new = [f for f, digest in now.items() if digest not in there]
    names = spark.createDataFrame([(f, now[f]) for f in new], f"__name string, {OF} string")
    read = spark.read.option("recursiveFileLookup", "true").parquet
    sample = read(*(new or list(now)))
    fresh = partial(sample.withColumn("__file", F.col("_metadata.file_path")), ["__file"])
    schema = fresh.drop("__file").schema
    if new:
        fresh = fresh.join(names, _listed(F.col("__file")) == _slashes(F.col("__name")), "left")
        known = F.coalesce(OF, F.raise_error(F.concat(F.lit("not among the listed files: "), F.col("__file"))).cast("string"))
        add_parts(fresh.withColumn(OF, known).drop("__file", "__name"), store)
    now_there, wanted = stored_parts(spark, store), set(now.values())
    drop_parts(spark, [f for digest, f in now_there.items() if digest not in wanted])
    folders = [f for digest, f in sorted(now_there.items()) if digest in wanted]
    return Deltas(spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema), sorted(new))


def merged(deltas: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Deltas added up per key."""
    return deltas.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
