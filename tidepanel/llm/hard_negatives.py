"""Hard negatives by a BOND scan: branch and bound on vertically decomposed vectors.

Rows are dealt into blocks, whatever they hold. A block keeps its vectors by
dimension, with the least and the largest value of each. An anchor reads the
dimensions in descending order of its own magnitudes. What the dimensions not
yet read may still add lies between the sums of their least and largest
contributions, so each candidate's score has bounds that tighten; candidates
whose bounds rule them out leave the bitmap, and only those left are read on.

Two scans: the first finds an anchor's positives (the bound is the k-th best
lower bound), the second the negatives in the window below each positive.
Scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, met_by_block, saved

STEP = 8  # dimensions between two looks at the bounds
BLOCK = "block int, dim int, ids binary, labels binary, columns binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, dim, vec_id, label, vec) sorted by block and dim -> a row for each, vectors by dimension."""
    held: list[pa.RecordBatch] = []

    def row() -> Iterator[pa.RecordBatch]:
        if held:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            vec = rows["vec"].flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
            if np.abs(vec).max(initial=0) >= 1 << 31:
                raise OverflowError("a scaled component is 2^31 or more; choose a smaller scale")
            values = [pa.array([rows["block"][0].as_py()], pa.int32()), pa.array([vec.shape[1]], pa.int32())]
            cells = [rows["vec_id"].to_numpy().astype("<i8"), rows["label"].to_numpy().astype("<i8"), np.ascontiguousarray(vec.T.astype("<i4"))]
            yield pa.RecordBatch.from_arrays([*values, *[pa.array([c.tobytes()], pa.binary()) for c in cells]], names=["block", "dim", "ids", "labels", "columns"])
            held.clear()

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        block, dim = batch["block"].to_numpy(), batch["dim"].to_numpy()
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (dim[1:] != dim[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if (block[a], dim[a]) != last:
                yield from row()
                last = (block[a], dim[a])
            held.append(batch.slice(a, b - a))
    yield from row()


class Columns:
    """A block: ``vec[d]`` is dimension d of all rows."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, columns: bytes):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.whole = np.frombuffer(columns, "<i4").reshape(dim, -1)
        self.vec = self.whole.astype(np.float64)
        self.low, self.high = self.whole.min(axis=1).astype(np.int64), self.whole.max(axis=1).astype(np.int64)

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of the rows of ``bitmap`` that ``keep(lower, upper bounds)`` never ruled out."""
        reach = float((np.abs(anchor).astype(object) * np.maximum(np.abs(self.low), np.abs(self.high)).astype(object)).sum())
        if reach >= 2.0 ** 62:
            raise OverflowError("an inner product may pass 2^62; choose a smaller scale")
        exact = reach < 2.0 ** 53  # sums of doubles are then exact integers
        vec, q = (self.vec, anchor.astype(np.float64)) if exact else (self.whole, anchor.astype(np.int64))
        order = np.argsort(-np.abs(anchor), kind="stable")
        least, most = np.minimum(anchor * self.low, anchor * self.high)[order], np.maximum(anchor * self.low, anchor * self.high)[order]
        least, most = np.append(np.cumsum(least[::-1])[::-1], 0), np.append(np.cumsum(most[::-1])[::-1], 0)  # of what is left from each place on
        rows = np.flatnonzero(bitmap)
        score = np.zeros(len(rows), dtype=q.dtype)
        for k, d in enumerate(order.tolist(), 1):
            if not q[d]:
                break  # nor has any later dimension
            score += q[d] * (vec[d] if len(rows) == len(self.ids) else vec[d, rows])
            if k % STEP == 0 and k < len(order) and len(rows):
                left = keep(score + least[k], score + most[k])
                if not left.all():
                    rows, score = rows[left], score[left]
        return rows, score.astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    if len(score) > 4 * k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def _kth(values: np.ndarray, k: int):
    """The ``k``-th highest of ``values``; None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _scan(find):
    """Stream of ``met_by_block`` -> what ``find(block, row, anchor)`` yields for each block and anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, own = None, {}
        for batch in batches:
            out = []
            for i, first in enumerate(batch["first"].to_pylist()):
                if first:
                    if batch["block"][i].as_py() != block:
                        block, own = batch["block"][i].as_py(), {}
                    own[batch["dim"][i].as_py()] = Columns(*[batch[c][i].as_py() for c in ("dim", "ids", "labels", "columns")])
                elif batch["block"][i].as_py() == block:
                    anchor = batch["vec"][i].values.to_numpy(zero_copy_only=False)
                    if len(anchor) in own:
                        out += find(own[len(anchor)], {c: batch[c][i].as_py() for c in batch.schema.names if c in ("uid", "vec_id", "label", "scores")}, anchor)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["uid", "score", "found_id", "found_score"])

    return run


def _positives(k: int):
    def find(block: Columns, row: dict, anchor: np.ndarray) -> list[tuple]:
        def keep(low, high):
            bound = _kth(low, k)
            return np.ones(len(low), dtype=bool) if bound is None else high >= bound

        rows, score = block.scan(anchor, (block.labels == row["label"]) & (block.ids != row["vec_id"]), keep)
        return [(row["uid"], None, int(block.ids[rows[j]]), int(score[j])) for j in _best(score, block.ids[rows], k)]

    return find


def _negatives(k: int, low_pct: int, high_pct: int):
    def find(block: Columns, row: dict, anchor: np.ndarray) -> list[tuple]:
        # scores from low to high, both included, in whole numbers
        windows = [(p, -(-low_pct * p // 100), high_pct * p // 100) for p in row["scores"]]
        windows = [w for w in windows if w[1] <= w[2]]
        if not windows:
            return []

        def keep(low, high):
            left = np.zeros(len(low), dtype=bool)
            for _, least, most in windows:
                may = (high >= least) & (low <= most)
                bound = _kth(low[(low >= least) & (high <= most)], k)
                left |= may if bound is None else may & (high >= bound)
            return left

        rows, score = block.scan(anchor, (block.labels != row["label"]) & (block.ids != row["vec_id"]), keep)
        out = []
        for p, least, most in windows:
            inside = np.flatnonzero((score >= least) & (score <= most))
            out += [(row["uid"], p, int(block.ids[rows[inside[j]]]), int(score[inside[j]])) for j in _best(score[inside], block.ids[rows[inside]], k)]
        return out

    return find


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low_pct: int = 80, high_pct: int = 100, scale: int = 256,
                   block_rows: int = 8192, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x), a score is an inner product of
    these integers. For each row that meets the condition ``anchors``, its
    ``positives`` best other rows of its label; for each of them the
    ``negatives`` best rows of another label whose score is between
    ``low_pct`` and ``high_pct`` per cent of the positive's, ranked from 1.
    Ties go to the smaller id.

    Rows with a NULL id or label, or a vector that is NULL, empty or holds
    NULL or non-finite numbers, take no part; vectors of different length do
    not meet. Each row counts for itself, also if rows repeat, but never meets
    rows of its own id. An empty table, and an anchor without a positive or
    without a negative in any window, gives no rows. Scaled components of 2^31
    and scores of 2^62 or more fail the job, as they would not be exact.
    """
    numbers = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    fit = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), numbers.alias("vec"), anchors.alias("is_anchor"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & fit)
            .select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", F.transform("vec", lambda x: F.floor(x)).alias("vec"), F.coalesce("is_anchor", F.lit(False)).alias("is_anchor")))
    rows = saved(rows, "bond-rows")
    n_blocks = -(-rows.count() // block_rows)
    found = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_blocks:
        return vectors.sparkSession.createDataFrame([], found)
    # dealt by the row's own number: a block's size does not depend on what rows hold
    dealt = rows.select(F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int").alias("block"), F.size("vec").alias("dim"), "vec_id", "label", "vec")
    blocks = saved(map_arrow(dealt.repartition("block").sortWithinPartitions("block", "dim"), _blocks, BLOCK), "bond-blocks", rows_at_once=8)
    asked = rows.filter("is_anchor").select("uid", "vec_id", "label", "vec")

    def scan(asking: DataFrame, find, by: list[str], k: int) -> DataFrame:
        """The ``k`` best found in all blocks."""
        met = met_by_block(blocks, asking.select("uid", "vec_id", F.col("label"), "vec", *[c for c in asking.columns if c == "scores"]), n_blocks, _scan(find), "uid long, score long, found_id long, found_score long")
        best = Window.partitionBy(*by).orderBy(F.desc("found_score"), "found_id")
        return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)

    near = saved(scan(asked, _positives(positives), ["uid"], positives).select("uid", F.col("found_id").alias("positive_id"), F.col("found_score").alias("positive_score")), "bond-positives")
    scores = near.groupBy("uid").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))  # at most ``positives``
    hard = scan(asked.join(scores, "uid"), _negatives(negatives, low_pct, high_pct), ["uid", "score"], negatives)
    return (near.join(hard.withColumnRenamed("score", "positive_score"), ["uid", "positive_score"]).join(asked.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
            .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("found_score").alias("negative_score")))


def hard_negatives_sql() -> str:
    """The registered query's rows in DuckDB SQL."""
    return """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
         CAST(list_dot_product(a.vec, r.vec) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.vec) = len(r.vec)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.alike
 AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5
"""
