"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one node, with as many of their smallest ids as a query can
need; every row is so indexed. Nodes are dealt into shards of bounded size by
a hash of the vector. A shard's graph is built in one task and kept as flat
arrays: per level the nodes and a matrix of their neighbours. Queries go to
every shard, and what the shards find is merged.

A node's highest level is drawn from a geometric distribution. Levels are
built from the top down: the nodes of the level above come first and are
linked among themselves, the others enter in batches. A batch descends
greedily to its level and searches there with a beam, all its members in step,
so that one numpy operation serves many. Of the nodes found, and of those
entering with it, a node links with the near ones that are not nearer to one
already chosen; the links back take places of their own, the nearest stay, so
that a group of near copies never displaces the links that lead away from it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free, map_arrow, met_by_block, saved
from .embeddings import _usable

OWN, BACK = 20, 28  # a node's links of its own choice, and links back to it
INDEX = "block int, dim int, vectors binary, ids array<array<long>>, sizes array<int>, nodes binary, links binary"


class Level:
    """``nodes[i]`` has the neighbours ``links[i]``; -1 is none."""

    def __init__(self, n: int, nodes: np.ndarray, links: np.ndarray):
        self.nodes, self.links = nodes, links
        self.row = np.full(n, -1, dtype=np.int32)
        self.row[nodes] = np.arange(len(nodes), dtype=np.int32)


def search(vec: np.ndarray, level: Level, queries: np.ndarray, entry: np.ndarray, width: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, cosines) of the ``width`` best found for each query, best first; -1 and -inf where there are fewer.

    Every step expands the ``at_once`` best unexpanded nodes of each query's
    beam; a query ends when its beam has none.
    """
    n, count = len(vec), len(queries)
    seen = np.zeros((count, n + 1), dtype=bool)  # the last column stands for no neighbour
    seen[:, n] = True
    order = np.zeros((count, n + 1), dtype=np.int32)
    ids = np.full((count, width), -1, dtype=np.int32)
    cos = np.full((count, width), -np.inf, dtype=np.float32)
    done = np.zeros((count, width), dtype=bool)
    ids[:, 0], cos[:, 0] = entry, np.einsum("qd,qd->q", vec[entry], queries)
    seen[np.arange(count), entry] = True
    rows = np.arange(count)
    while len(rows):
        open_cos = np.where(done[rows] | (ids[rows] < 0), -np.inf, cos[rows])
        take = np.argsort(-open_cos, axis=1, kind="stable")[:, :at_once]
        has = np.take_along_axis(open_cos, take, axis=1) > -np.inf
        going = has[:, 0]
        rows, take, has = rows[going], take[going], has[going]
        if not len(rows):
            break
        at = rows[:, None]
        done[at, take] |= has
        next_to = level.links[level.row[ids[at, take]]]
        next_to = np.where(has[:, :, None] & (next_to >= 0), next_to, n).reshape(len(rows), -1)
        order[at, next_to] = np.arange(next_to.shape[1], dtype=np.int32)  # of a node met twice, the last stays
        new = ~seen[at, next_to] & (order[at, next_to] == np.arange(next_to.shape[1]))
        seen[at, next_to] = True
        met = np.matmul(vec[np.where(new, next_to, 0)], queries[rows][:, :, None])[:, :, 0]
        met[~new] = -np.inf
        all_cos = np.concatenate([cos[rows], met], axis=1)
        best = np.argsort(-all_cos, axis=1, kind="stable")[:, :width]
        cos[rows] = np.take_along_axis(all_cos, best, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(new, next_to, -1)], axis=1), best, axis=1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], np.zeros_like(new)], axis=1), best, axis=1)
    return ids, cos


def choose(vec: np.ndarray, ids: np.ndarray, cos: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's candidates (best first), the first ``most`` that are not nearer to one chosen before; then the nearest others."""
    count, width = ids.shape
    own = vec[np.maximum(ids, 0)]
    between = np.matmul(own, own.transpose(0, 2, 1))
    shut, chosen = ids < 0, np.zeros(ids.shape, dtype=bool)
    for i in range(width):
        take = ~shut[:, i] & (chosen.sum(axis=1) < most)
        chosen[:, i] = take
        shut |= take[:, None] & (between[:, i, :] > cos)
    rank = np.argsort(np.where(chosen, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
    ids, cos = np.take_along_axis(ids, rank, axis=1), np.take_along_axis(cos, rank, axis=1)
    if width < most:
        ids = np.pad(ids, ((0, 0), (0, most - width)), constant_values=-1)
        cos = np.pad(cos, ((0, 0), (0, most - width)), constant_values=-np.inf)
    return ids, cos


def _link_back(level: Level, back_cos: np.ndarray, nodes: np.ndarray, ids: np.ndarray, cos: np.ndarray) -> None:
    """Each of ``ids`` gets a link back to its node, if there is room or a farther one to replace."""
    new, place = np.nonzero(ids >= 0)
    to, source, near = level.row[ids[new, place]], nodes[new], cos[new, place]
    order = np.lexsort((-near, to))
    to, source, near = to[order], source[order], near[order]
    turn = np.arange(len(to)) - np.searchsorted(to, to, side="left")  # the first of each, then the second, ...
    for t in range(min(int(turn.max(initial=-1)) + 1, BACK)):
        some = turn == t
        x, s, c = to[some], source[some], near[some]
        worst = np.argmin(back_cos[x], axis=1)
        better = c > back_cos[x, worst]
        x, worst = x[better], worst[better]
        back_cos[x, worst] = c[better]
        level.links[x, OWN + worst] = s[better]


def descend(vec: np.ndarray, levels: list[Level], queries: np.ndarray) -> np.ndarray:
    """The node each query reaches greedily through ``levels``, the highest first."""
    entry = np.zeros(len(queries), dtype=np.int32)
    for k, level in enumerate(levels):
        entry = search(vec, level, queries, np.full(len(queries), level.nodes[0], dtype=np.int32) if k == 0 else entry, 1, 1)[0][:, 0]
    return entry


def build(vec: np.ndarray, beam: int = 64, batch: int = 256, seed: int = 3) -> list[Level]:
    """The levels of the graph of ``vec`` (unit vectors), the highest first."""
    n = len(vec)
    rng = np.random.default_rng([seed, n])
    highest = np.floor(-np.log(1 - rng.random(n)) / math.log(OWN)).astype(int)
    levels: list[Level] = []
    for height in range(int(highest.max()), -1, -1):
        nodes = np.flatnonzero(highest >= height).astype(np.int32)
        nodes = np.concatenate([nodes[highest[nodes] > height], nodes[highest[nodes] == height]])
        above = int((highest > height).sum())
        level = Level(n, nodes, np.full((len(nodes), OWN + BACK), -1, dtype=np.int32))
        back_cos = np.full((len(nodes), BACK), -np.inf, dtype=np.float32)
        first = above or min(len(nodes), batch)  # a part of about 1 in OWN, or the whole top level
        for a in [*range(0, first, batch), *range(first, len(nodes), batch)]:
            some = nodes[a:min(a + batch, first if a < first else len(nodes))]
            found, near = np.zeros((len(some), 0), dtype=np.int32), np.zeros((len(some), 0), dtype=np.float32)
            if a >= first:
                entry = descend(vec, levels, vec[some]) if levels else np.full(len(some), nodes[0], dtype=np.int32)
                found, near = search(vec, level, vec[some], entry, beam)
            # those that enter together see each other; the first of a level see all of them
            peers = some if a >= first else nodes[:first]
            cos = vec[some] @ vec[peers].T
            cos[peers[None, :] == some[:, None]] = -np.inf
            best = np.argsort(-cos, axis=1, kind="stable")[:, :beam]
            cos = np.take_along_axis(cos, best, axis=1)
            found, near = np.concatenate([found, np.where(cos > -np.inf, peers[best], -1)], axis=1), np.concatenate([near, cos], axis=1)
            best = np.argsort(-near, axis=1, kind="stable")[:, :beam]
            ids, cos = choose(vec, np.take_along_axis(found, best, axis=1), np.take_along_axis(near, best, axis=1), OWN)
            level.links[level.row[some], :OWN] = ids
            _link_back(level, back_cos, some, ids, cos)
        levels.append(level)
    return levels


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    """Vectors as doubles of length 1, scaled first so that squares neither overflow nor vanish."""
    vec = np.array([np.frombuffer(r, kind) for r in raw], dtype=np.float64)
    vec /= np.abs(vec).max(axis=1, keepdims=True)
    return vec / np.sqrt((vec * vec).sum(axis=1, keepdims=True))


def _index(kind: str):
    """Rows (block, dim, vec, ids) sorted by block and dim -> an index row for each."""

    def row(key: tuple[int, int], raw: list[bytes], ids: list) -> pa.RecordBatch:
        levels = build(_unit(raw, kind).astype(np.float32))
        cells = {"vectors": b"".join(raw), "nodes": np.concatenate([x.nodes for x in levels]).astype("<i4").tobytes(), "links": np.concatenate([x.links for x in levels]).astype("<i4").tobytes()}
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([cells["vectors"]], pa.binary()), pa.array([ids], pa.list_(pa.list_(pa.int64()))),
                                           pa.array([[len(x.nodes) for x in levels]], pa.list_(pa.int32())), pa.array([cells["nodes"]], pa.binary()), pa.array([cells["links"]], pa.binary())],
                                          names=["block", "dim", "vectors", "ids", "sizes", "nodes", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, raw, ids = None, [], []
        for batch in batches:
            for key, v, own in zip(zip(batch["block"].to_pylist(), batch["dim"].to_pylist()), batch["vec"].to_pylist(), batch["ids"].to_pylist()):
                if key != last and raw:
                    yield row(last, raw, ids)
                    raw, ids = [], []
                last = key
                raw.append(v)
                ids.append([x["vec_id"] for x in own])
        if raw:
            yield row(last, raw, ids)

    return run


class Shard:
    """An index row, ready to answer."""

    def __init__(self, row: dict, kind: str):
        self.ids, n = row["ids"], len(row["ids"])
        self.exact = _unit([row["vectors"][a:a + len(row["vectors"]) // n] for a in range(0, len(row["vectors"]), len(row["vectors"]) // n)], kind)
        self.vec = self.exact.astype(np.float32)
        nodes, links, at, self.levels = np.frombuffer(row["nodes"], "<i4"), np.frombuffer(row["links"], "<i4").reshape(-1, OWN + BACK), 0, []
        for size in row["sizes"]:
            self.levels.append(Level(n, nodes[at:at + size], links[at:at + size]))
            at += size

    def nearest(self, queries: np.ndarray, own_ids: list[int], k: int, width: int) -> list[list[tuple]]:
        """(cosine, id) of up to ``k`` rows for each query, without its own."""
        entry = descend(self.vec, self.levels[:-1], queries.astype(np.float32)) if len(self.levels) > 1 else np.full(len(queries), self.levels[0].nodes[0], dtype=np.int32)
        found, _ = search(self.vec, self.levels[-1], queries.astype(np.float32), entry, width)
        out = []
        for q, ids, own in zip(queries, found, own_ids):
            ids = ids[ids >= 0]
            cos = self.exact[ids] @ q
            rows = []
            for j in np.argsort(-cos, kind="stable").tolist():
                if len(rows) > k and cos[j] < rows[k][0]:
                    break  # k rows and perhaps its own are nearer
                mine = self.ids[ids[j]]
                if own in mine and (self.exact[ids[j]] == q).all():
                    mine = list(mine)
                    mine.remove(own)
                    own = None
                rows += [(float(cos[j]), x) for x in mine]
            out.append(sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:k])
        return out


def _answer(kind: str, k: int, width: int, at_once: int = 128):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, own = None, {}
        for batch in batches:
            asked: dict[int, list[tuple]] = {}
            out: list[tuple] = []

            def answer(dim: int) -> None:
                some = asked.pop(dim)
                for (uid, vec_id, _), rows in zip(some, own[dim].nearest(_unit([s[2] for s in some], kind), [s[1] for s in some], k, width)):
                    out.extend((uid, vec_id, x, cos) for cos, x in rows)

            for i, (first, at, dim) in enumerate(zip(batch["first"].to_pylist(), batch["block"].to_pylist(), batch["dim"].to_pylist())):
                if at != block:
                    for d in list(asked):
                        answer(d)
                    block, own = at, {}
                if first:
                    own[dim] = Shard({c: batch[c][i].as_py() for c in ("vectors", "ids", "sizes", "nodes", "links")}, kind)
                elif dim in own:
                    asked.setdefault(dim, []).append((batch["uid"][i].as_py(), batch["vec_id"][i].as_py(), batch["vec"][i].as_py()))
                    if len(asked[dim]) == at_once:
                        answer(dim)
            for d in list(asked):
                answer(d)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], names=["uid", "query_id", "vec_id", "score"])

    return run


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 5, width: int = 192, shard_rows: int = 16_384, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found by cosine, for each row that meets the condition ``queries``.

    Candidates are all rows but the query's own. Nearest first, ties by
    smaller id (NULL ids last); the score is the cosine of the original
    vectors in double precision. ``width`` is the beam of a search in a shard
    of about ``shard_rows`` different vectors.

    Vectors that are NULL, empty, zero or hold NULL or non-finite numbers take
    no part; vectors of different length do not meet. Each row is a candidate
    of its own, also if rows repeat; repeated query rows are each answered.
    Queries without an id, and an empty table, give no rows.
    """
    kind = "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    asks = free(vectors, "_asks")
    marked = vectors.withColumn(asks, F.coalesce(queries, F.lit(False)))
    rows = saved(_usable(marked.filter(vectors[vec_col].isNotNull()), id_col, vec_col, kind, asks).filter("vec is not null"), "graph-rows")
    # k + 1 ids are enough for any query: k and perhaps its own
    same = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last())
    nodes = rows.select("vec", "vec_id").withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1).groupBy("vec").agg(F.collect_list(F.struct("vec_id")).alias("ids"))
    nodes = saved(nodes, "graph-nodes")
    shards = -(-nodes.count() // shard_rows)
    found = "query_id long, rank int, vec_id long, score double"
    if not shards:
        return vectors.sparkSession.createDataFrame([], found)
    dealt = nodes.select(F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int").alias("block"), F.length("vec").alias("dim"), "vec", "ids")
    index = saved(map_arrow(dealt.repartition(2 * shards, "block").sortWithinPartitions("block", "dim"), _index(kind), INDEX), "graph-index", rows_at_once=8)
    asked = rows.filter(F.col(asks) & F.col("vec_id").isNotNull()).select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.length("vec").alias("dim"), "vec")
    met = met_by_block(index, asked, shards, _answer(kind, k, width), "uid long, query_id long, vec_id long, score double")
    best = Window.partitionBy("uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
