"""Nearest neighbours against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.llm.graph_search import BACK, OWN, build, descend, nearest_neighbours, search

from .test_hard_negatives import rows_of, table


def plain(rows, modulus, k=5):
    """[(query_id, [(cosine, id)])] of every query row, in doubles."""
    own = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v, _ in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (i, q) in enumerate(own):
        if i is None or i % modulus:
            continue
        near = [(-float(v @ q / math.sqrt(float(v @ v) * float(q @ q))), j is None, j or 0) for b, (j, v) in enumerate(own) if b != at and len(v) == len(q)]
        out.append((i, [(-c, None if no else j) for c, no, j in sorted((round(c, 12), no, j) for c, no, j in near)[:k]]))
    return out


def found(df):
    by = {}
    for r in df.collect():
        by.setdefault((r.query_id, r.rank), []).append((round(r.score, 12), r.vec_id))
    return by


def as_ranks(want):
    by = {}
    for i, near in want:
        for rank, x in enumerate(near, 1):
            by.setdefault((i, rank), []).append((round(x[0], 12), x[1]))
    return {k: sorted(v, key=str) for k, v in by.items()}


@pytest.mark.parametrize("shard_rows", [40, 16_384])
def test_odd_rows_against_brute_force(spark, shard_rows):
    rows = rows_of(1, 120)
    copies = [(200 + i, rows[10][1], 0) for i in range(30)] + [(300, rows[10][1], 0), (300, rows[10][1], 0)]
    odd = [(None, rows[3][1], 1), (None, [0.5] * 24, 1), (400, None, 1), (410, rows[1][1], None), (420, [], 1), (430, [None, 1.0], 0), (440, [math.nan] * 24, 0), (450, [math.inf] * 24, 1),
           (460, [0.0] * 24, 1), (470, [1.0, 2.0], 2), (471, [1.0, 1.9], 2), (472, [2.0, 4.0], 1), (480, [1.0, 2.0, 3.0], 0)]
    want = plain(rows + copies + odd, 10)
    got = nearest_neighbours(table(spark, rows + copies + odd), F.col("vec_id") % 10 == 0, shard_rows=shard_rows)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert {k: sorted(v, key=str) for k, v in found(got).items()} == as_ranks(want)


def test_recall_with_groups_of_near_copies(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)], 0) for i in range(2000)]
    rows += [(2000 + i, [x + rng.gauss(0, 0.01) for x in rows[7][1]], 0) for i in range(1000)]  # a third of all rows
    rows = [(i, [float(np.float32(x)) for x in v], c) for i, v, c in rows]
    want = plain(rows, 20)
    got = found(nearest_neighbours(table(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=1000))
    hits = sum(len({j for _, j in near} & {x[1] for r in range(1, 6) for x in got[(i, r)]}) for i, near in want)
    assert hits >= 0.95 * 5 * len(want)
    assert all(got[(i, r)][0][0] >= got[(i, r + 1)][0][0] for i, _ in want for r in range(1, 5))


def test_empty_and_single(spark):
    assert nearest_neighbours(table(spark, [(1, [1.0], 1)]).limit(0), F.lit(True)).count() == 0
    assert nearest_neighbours(table(spark, [(1, [1.0], 1), (2, None, 1)]), F.lit(True)).count() == 0
    got = nearest_neighbours(table(spark, [(1, [1.0, 1.0], 1), (2, [1.0, 0.0], 1)]), F.col("vec_id") == 1).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(1, 1, 2)] and got[0].score == pytest.approx(math.sqrt(0.5), abs=1e-15)


def test_graph_is_hierarchical_and_bounded():
    rng = np.random.default_rng(4)
    vec = rng.standard_normal((3000, 16)).astype(np.float32)
    vec /= np.linalg.norm(vec, axis=1, keepdims=True)
    levels = build(vec)
    sizes = [len(x.nodes) for x in levels]
    assert sizes == sorted(sizes) and sizes[-1] == 3000 and len(sizes) > 1
    for upper, level in zip([None, *levels], levels):
        assert level.links.shape == (len(level.nodes), OWN + BACK) and set(level.links[level.links >= 0]) <= set(level.nodes)
        assert upper is None or set(upper.nodes) <= set(level.nodes)
        assert not (level.links == level.nodes[:, None]).any()
    ids, cos = search(vec, levels[-1], vec[:50], descend(vec, levels[:-1], vec[:50]), 64)
    true = np.argsort(-(vec[:50] @ vec.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b[:5].tolist())) for a, b in zip(true, ids)]) >= 4.75
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in ids) and (np.diff(cos, axis=1)[ids[:, 1:] >= 0] <= 0).all()
