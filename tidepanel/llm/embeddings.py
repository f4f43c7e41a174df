"""Near-duplicate vectors: sign hashing in several tables, exact cosine, connected components.

Equal vectors count once, with their number. A table's key is the signs of a
vector's products with ``bits`` random hyperplanes; the number of tables
follows from the wanted recall at the threshold. Vectors with a common key
are compared exactly, in double precision, as blocks of matrix products. A
pair that meets in several tables counts in the first only, so links are
counted without writing pairs down; a block gives the edges of a spanning
forest of its links.

A key with very many vectors is split in blocks of entries that all vectors
of the key pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, saved
from .components import connected_components
from .simhash import Forest

BLOCK = 2048


def plan_tables(n: int, threshold: float, recall: float, per_key: int = 512) -> tuple[int, int]:
    """(bits, tables): about ``per_key`` vectors a key if they are spread evenly, and the recall at the threshold."""
    bits = max(4, math.ceil(math.log2(max(1, n) / per_key)) if n > per_key else 4)
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def _usable(vectors: DataFrame, id_col: str, vec_col: str, kind: str, *flags: str) -> DataFrame:
    """(vec_id, vec, flags): bytes of numbers of ``kind``; NULL for vectors that cannot link. ``flags`` are boolean columns."""
    width = "float" if kind == "<f4" else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(1):
                values = np.array(v.values.to_numpy(zero_copy_only=False), dtype=kind) if v.is_valid and v.values.null_count == 0 else np.zeros(0)
                out.append(values.tobytes() if len(values) and np.isfinite(values).all() and values.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), *batch.columns[2:]], names=["vec_id", "vec", *flags])

    return map_arrow(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{width}>").alias("v"), *flags), run, "vec_id long, vec binary" + "".join(f", {c} boolean" for c in flags))


def _signed(distinct: DataFrame, kind: str, bits: int, tables: int, seed: int) -> DataFrame:
    """(uid, n, vec, signs): a key per table, packed as little-endian uint32 each (bits <= 32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = (1 << np.arange(bits, dtype=np.int64))
        for batch in batches:
            signs = []
            for raw in batch.column("vec").to_pylist():
                v = np.frombuffer(raw, kind).astype(np.float64)
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng([seed, len(v)]).standard_normal((tables * bits, len(v)))
                signs.append((((planes[len(v)] @ v) >= 0).reshape(tables, bits) @ weight).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.binary())], names=["uid", "n", "vec", "signs"])

    return map_arrow(distinct.select("uid", "n", "vec"), run, "uid long, n long, vec binary, signs binary")


def _compare(threshold: float, kind: str, tables: int):
    """Rows sorted by (tab, key, block), entries first -> (a, b) edges and (a, links) counts."""

    class Rows:
        def __init__(self, batch: pa.RecordBatch):
            self.uid, self.n = batch.column("uid").to_numpy(), batch.column("n").to_numpy()
            self.signs = np.array([np.frombuffer(s, "<u4") for s in batch.column("signs").to_pylist()]).reshape(-1, tables)
            self.vec = np.array([np.frombuffer(v, kind) for v in batch.column("vec").to_pylist()], dtype=np.float64)
            with np.errstate(over="ignore"):
                scale = np.abs(self.vec).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
            self.vec = self.vec / scale
            self.vec /= np.sqrt((self.vec * self.vec).sum(axis=1, keepdims=True))

    def meet(e: Rows, v: Rows, tab: int, same: bool) -> Iterator[tuple]:
        links, forest = np.zeros(len(e.uid), dtype=np.int64), Forest(len(e.uid) + (0 if same else len(v.uid)))
        for a in range(0, len(e.uid), 512):
            i, j = np.nonzero(e.vec[a:a + 512] @ v.vec.T >= threshold)
            i = i + a
            new = e.uid[i] != v.uid[j]
            if tab:
                new &= ~(e.signs[i, :tab] == v.signs[j, :tab]).any(axis=1)
            i, j = i[new], j[new]
            np.add.at(links, i, v.n[j])
            forest.link(i, j if same else j + len(e.uid))
        ids = e.uid if same else np.concatenate([e.uid, v.uid])
        child = np.flatnonzero(forest.label != np.arange(len(ids)))
        if len(child):
            yield ids[child], ids[forest.label[child]], np.zeros(len(child), dtype=np.int64)
        some = np.flatnonzero(links)
        if len(some):
            yield e.uid[some], e.uid[some], links[some]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, entries, full = None, [], None

        def close() -> Iterator[tuple]:
            """All entries of the group are here: among themselves."""
            nonlocal full
            if full is None and entries:
                full = Rows(pa.Table.from_batches(entries).combine_chunks().to_batches()[0])
                yield from meet(full, full, group[0], True)

        def emit(found) -> Iterator[pa.RecordBatch]:
            for a, b, n in found:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "links"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("tab", "dim", "key", "block", "entry")]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                own = tuple(int(c[a]) for c in cols[:4])
                if own != group:
                    yield from emit(close())
                    group, entries, full = own, [], None
                part = batch.slice(a, b - a)
                if cols[4][a]:
                    entries.append(part)
                else:
                    yield from emit(close())
                    if full is not None:
                        yield from emit(meet(full, Rows(part), group[0], False))
        yield from emit(close())

    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.999, seed: int = 11, block: int = BLOCK,
                           id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``.

    Vectors that are NULL, empty, zero or hold NULL or non-finite numbers link
    with nothing, nor do vectors of different length. Each row is a vector of
    its own, also if rows repeat; a component's id is its smallest non-NULL id.
    An empty table gives an empty result; other columns are not read.
    """
    # floats travel as floats and are compared as doubles
    kind = "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    base = saved(_usable(vectors, id_col, vec_col, kind), "vectors")
    distinct = saved(base.filter("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
                     .select(F.monotonically_increasing_id().alias("uid"), "vec", "least", "n"), "vectors-distinct")
    bits, tables = plan_tables(distinct.count(), threshold, recall)
    signed = saved(_signed(distinct, kind, bits, tables, seed), "vectors-signed")
    dim, word = F.length("vec"), lambda t: F.reverse(F.substring("signs", 1 + 4 * t, 4))
    keys = F.array(*[F.struct(F.lit(t).alias("tab"), F.conv(F.hex(word(t)), 16, 10).cast("long").alias("key")) for t in range(tables)])
    dealt = signed.select("*", dim.alias("dim"), F.explode(keys).alias("k")).select("uid", "n", "vec", "signs", "dim", "k.tab", "k.key")
    hot = saved(dealt.groupBy("tab", "dim", "key").count().filter(F.col("count") > block)
                .select("tab", "dim", "key", F.ceil(F.col("count") / F.lit(block)).cast("int").alias("blocks")), "vectors-hot")
    blocks = F.coalesce("blocks", F.lit(1))
    rows = (dealt.join(hot, ["tab", "dim", "key"], "left").withColumn("home", F.pmod(F.xxhash64("uid"), blocks).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("entry", F.col("home") == F.col("block"))
            .select("tab", "dim", "key", "block", "entry", "uid", "n", "vec", "signs"))
    order = ["tab", "dim", "key", "block"]
    met = rows.repartition(*order).sortWithinPartitions(*order, F.desc("entry"))
    found = saved(map_arrow(met, _compare(threshold, kind, tables), "a long, b long, links long"), "vectors-found")
    roots = connected_components(found.filter("links = 0"))
    links = found.filter("links > 0").groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    known = saved(distinct.join(links, "uid", "left").join(roots.select(F.col("id").alias("uid"), F.col("component_id").alias("root")), "uid", "left")
                  .select("vec", "least", F.coalesce("root", "uid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "vectors-known")
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    told = saved(known.join(ids, "root").select("vec", "n_links", "component_id"), "vectors-told")
    linked = base.filter("vec is not null").join(told, "vec").select("vec_id", "n_links", "component_id")
    alone = base.filter("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
