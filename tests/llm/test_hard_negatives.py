"""Hard negatives against all pairs, and the scan's bounds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.llm.hard_negatives import Columns, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, block int, score double, vec string, first boolean"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 7, 7, 7.0, "seven", True) for r in rows], SCHEMA).repartition(parts)


def plain(rows, k=5):
    """All pairs, in whole numbers."""
    own = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
           if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q, lab in own:
        if i % 10:
            continue
        score = [(-sum(a * b for a, b in zip(q, v)), j, other) for j, v, other in own if j != i and len(v) == len(q)]
        for p, j in sorted((s, j) for s, j, other in score if other == lab)[:k]:
            hard = sorted((s, x) for s, x, other in score if other != lab and 80 * -p <= 100 * -s <= 100 * -p)[:k]
            out += [(i, j, r, x, -p, -s) for r, (s, x) in enumerate(hard, 1)]
    return sorted(out)


def rows_of(seed, n, dim=24, kinds=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, [float(np.float32(x + rng.gauss(0, 0.3))) / 4 for x in c], rng.randrange(kinds)))
    return out


@pytest.mark.parametrize("block_rows", [16, 100_000])
def test_against_all_pairs(spark, block_rows):
    rows = rows_of(1, 150)
    copies = [(200 + i, rows[10][1], i % 3) for i in range(40)]  # ties, and a group of copies
    odd = [(None, rows[0][1], 1), (400, None, 1), (410, rows[1][1], None), (420, [], 1), (430, [None, 1.0], 0), (440, [math.nan] * 24, 0), (450, [math.inf] * 24, 1),
           (460, [0.0] * 24, 1), (470, [1.0, 2.0], 2), (471, [1.0, 1.9], 2), (472, [1.0, 1.8], 1), (480, [-x for x in rows[10][1]], 0)]
    want = plain(rows + copies + odd)
    got = hard_negatives(table(spark, rows + copies + odd), F.col("vec_id") % 10 == 0, block_rows=block_rows)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_repeated_rows_and_empty_table(spark):
    rows = rows_of(2, 40)
    got = sorted(map(tuple, hard_negatives(table(spark, rows + rows), F.col("vec_id") % 10 == 0).collect()))
    assert got == plain(rows + rows)
    assert hard_negatives(table(spark, rows).limit(0), F.lit(True)).count() == 0
    assert hard_negatives(table(spark, [(10, [1.0], 1)]), F.lit(True)).count() == 0


def test_large_components(spark):
    rows = [(i, [float(3e5 + i), 2e5], i % 2) for i in range(30)]  # scores beyond 2^53
    assert sorted(map(tuple, hard_negatives(table(spark, rows), F.col("vec_id") % 10 == 0).collect())) == plain(rows)
    with pytest.raises(Exception, match="2\\^31"):
        hard_negatives(table(spark, [(10, [1e9], 1), (11, [1.0], 1)]), F.lit(True)).collect()


def test_scan_reads_ever_fewer_rows():
    rng = np.random.default_rng(3)
    vec = rng.integers(-20, 20, (64, 4000))
    anchor = np.round(300 / np.arange(1, 65)).astype(np.int64)
    block = Columns(64, np.arange(4000, dtype="<i8").tobytes(), np.zeros(4000, "<i8").tobytes(), vec.astype("<i4").tobytes())
    seen = []

    def keep(low, high):
        seen.append(len(low))
        exact = np.sort(anchor @ vec)[-5]
        assert (high >= np.sort(low)[-5]).sum() >= 5 and np.sort(low)[-5] <= exact
        return high >= np.sort(low)[-5]

    rows, score = block.scan(anchor, np.ones(4000, dtype=bool), keep)
    assert (score == (anchor @ vec)[rows]).all() and seen == sorted(seen, reverse=True) and seen[-1] < 1000
    assert set(np.argsort(-(anchor @ vec), kind="stable")[:5]) <= set(rows)
