"""Quality score of whole texts: histogram gradient-boosted trees over document statistics.

The statistics of every text are computed once and written (some twenty
floats a row); the labelled ones are joined to them, never the texts. Trees
are grown on a bounded sample of the labelled rows and flattened into arrays,
so a batch of rows goes down a tree with one numpy step per level.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, map_arrow, saved

STATISTICS = ("log_bytes", "log_words", "word_length", "distinct_words", "top_word", "repeated_neighbours", "upper", "digits", "blank", "line_feeds",
              "stops", "commas", "marks", "bars", "symbols", "other_ascii", "beyond_ascii", "distinct_lines", "sentence_words", "short_words", "capitalised", "odd_ends")
_CAPITAL, _ODD_END = re.compile(rb"(?:^|\s)[A-Z][a-z]"), re.compile(rb"[^A-Za-z0-9.,;:)\"'\x80-\xff\s](?=\s|$)")


def statistics(text: bytes) -> list[float]:
    """The values of ``STATISTICS`` for a UTF-8 text; an empty text has zeros."""
    size = len(text)
    if not size:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    n = max(1, len(words))
    tally = Counter(words)
    of = lambda chars: float(count[list(chars)].sum()) / size
    stops = float(count[list(b".!?")].sum())
    return [
        float(np.log1p(size)), float(np.log1p(len(words))), (size - float(count[list(b" \n\t\r")].sum())) / n, len(tally) / n, max(tally.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, float(count[65:91].sum()) / size, float(count[48:58].sum()) / size, of(b" \t"), float(count[10]) / size,
        of(b"."), of(b",;:"), of(b"!?"), of(b"|"), of(b"#$%&*@^~"), of(b"<>{}[]()=/\\_+-\"'`"), float(count[128:].sum()) / size, len(set(lines)) / len(lines),
        n / (stops + 1), sum(len(w) <= 3 for w in words) / n, len(_CAPITAL.findall(text)) / n, len(_ODD_END.findall(text)) / n]


def document_statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``stats``: array of floats. NULL texts count as empty."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t.as_py() or b"") for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values, pa.list_(pa.float32()))], names=[*keep, "stats"])

    rows = docs.select(*keep, F.col(text_col).cast("string").cast("binary").alias("_text"))
    return map_arrow(rows, run, kinds + ", stats array<float>")


class Forest:
    """Boosted trees of one depth, each level by level in arrays."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, leaf: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.leaf = trees, depth, rate, bins, leaf

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Forest:
        n, width = x.shape
        weight = np.ones(n) if weight is None else weight
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)
        inner = (1 << self.depth) - 1
        self.feature = np.zeros((self.trees, inner), dtype=np.int32)
        self.split = np.full((self.trees, inner), np.inf)
        self.value = np.zeros((self.trees, 1 << self.depth))
        p = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        f = np.full(n, self.start)
        for t in range(self.trees):
            prob = 1 / (1 + np.exp(-f))
            grad, hess = weight * (prob - y), weight * prob * (1 - prob)
            node = np.zeros(n, dtype=np.int64)
            for level in range(self.depth):
                base, wide = (1 << level) - 1, 1 << level
                gain, best_j, best_b = np.full(wide, 1e-6), np.full(wide, -1), np.zeros(wide, dtype=np.int64)
                for j in range(width):
                    k = len(self.edges[j]) + 1
                    if k < 2:
                        continue
                    at = node * k + binned[:, j]
                    g = np.bincount(at, grad, wide * k).reshape(wide, k).cumsum(1)
                    h = np.bincount(at, hess, wide * k).reshape(wide, k).cumsum(1)
                    gl, hl, g_all, h_all = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                    won = gl ** 2 / (hl + self.leaf) + (g_all - gl) ** 2 / (h_all - hl + self.leaf) - g_all ** 2 / (h_all + self.leaf)
                    b = won.argmax(1)
                    top = won[np.arange(wide), b]
                    better = top > gain
                    gain[better], best_j[better], best_b[better] = top[better], j, b[better]
                right = np.zeros(n, dtype=bool)
                for i in np.flatnonzero(best_j >= 0):
                    self.feature[t, base + i], self.split[t, base + i] = best_j[i], self.edges[best_j[i]][best_b[i]]
                    own = node == i
                    right[own] = binned[own, best_j[i]] > best_b[i]
                node = 2 * node + right
            g, h = np.bincount(node, grad, 1 << self.depth), np.bincount(node, hess, 1 << self.depth)
            self.value[t] = -self.rate * g / (h + self.leaf)
            f += self.value[t][node]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f, rows = np.full(len(x), self.start), np.arange(len(x))
        for t in range(self.trees):
            node = np.zeros(len(x), dtype=np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, self.feature[t, at]] > self.split[t, at])
            f += self.value[t, node]
        return 1 / (1 + np.exp(-f))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", sample: int = 20_000, threshold: float = 0.3,
                   keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` columns (default: the id) of all ``docs``, with score and predicted.

    Learns from labelled documents for which ``learn`` (over the columns of
    ``docs``) holds: about ``sample`` of them, chosen by a hash of the id.
    Several labels of an id are averaged; NULL labels and ids teach nothing.
    Without labels the score is 0.5. The score of an empty text is that of a
    text with all statistics zero. Each row is scored, also if rows repeat;
    an empty table gives an empty result. Columns of ``keep`` named like the
    new ones are left out.
    """
    keep = [c for c in keep or [id_col] if c.lower() not in ("score", "predicted", "stats")]
    own = list(dict.fromkeys([id_col, *keep]))
    marker = free(docs, "_learn")
    stats = saved(document_statistics(docs.withColumn(marker, learn), [*own, marker], text_col), "quality-stats")
    marked = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(label_col).cast("double")).alias("_y"))
    taught = saved(stats.filter(F.col(marker)).select(F.col(id_col).alias("_id"), F.col("stats").alias("_x")).join(marked, "_id"), "quality-taught")
    total = taught.count()
    limit = 1 << 32
    rows = taught.filter(F.pmod(F.xxhash64("_id"), F.lit(limit)) < F.lit(int(limit * min(1.0, sample / max(1, total))))).select("_id", "_x", "_y").toArrow()
    forest = None
    if rows.num_rows:
        order = np.argsort(rows.column("_id").to_numpy(), kind="stable")
        x = np.array(rows.column("_x").to_pylist(), dtype=np.float32)[order].astype(np.float64)
        forest = Forest().fit(x, rows.column("_y").to_numpy()[order])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.select(*keep).schema.fields)
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # 60 trees of 31 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            flat = batch.column(batch.num_columns - 1)
            x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), len(STATISTICS)).astype(np.float64)
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    return map_arrow(stats.select(*keep, "stats"), run, kinds + ", score double, predicted int")
