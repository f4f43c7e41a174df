"""SimHash, vectors and components against all pairs."""

import re

import numpy as np
import pandas as pd
import xxhash

from tidepanel.llm.components import connected_components
from tidepanel.llm.embeddings import near_duplicate_vectors, plan_tables
from tidepanel.llm.simhash import fingerprint, fingerprint_links, golay_table, simhash_components

from .helpers import ODD, frame, prose


def components(n, pairs):
    par = list(range(n))

    def find(i):
        while par[i] != i:
            par[i] = par[par[i]]
            i = par[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        par[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def plain_print(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if not w:
        return 0
    h = [xxhash.xxh64(b" ".join(w[i:i + 3]), seed=42).intdigest() for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_golay_table_is_the_perfect_code():
    table = golay_table()
    assert (np.bincount(table, minlength=4096) == 2048).all()


def test_simhash_against_all_pairs(spark):
    rows = ODD + [(20 + i, prose(i // 4, 300).replace("the", "the" if i % 4 else "thy", 1) + (" tail" * (i % 3))) for i in range(40)] + [(90, prose(0, 300)), (91, prose(0, 300))]
    fp = [plain_print(t) for _, t in rows]
    assert [fingerprint((t or "").encode(), 3) for _, t in rows] == fp
    comp = components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= 3])
    least = {}
    for (d, _), c in zip(rows, comp):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    want = sorted(str((d, f"{f:016x}", least.get(c))) for (d, _), f, c in zip(rows, fp, comp))
    got = simhash_components(frame(spark, rows)).collect()
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want


def test_links_within_three_bits_are_found_also_in_hot_keys(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, size=150, dtype=np.uint64)
    alike = [base]
    for _ in range(5):
        x = base.copy()
        for _ in range(rng.integers(1, 4)):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        alike.append(x)
    clump = np.array([base[0] ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for i in range(0, 64, 2) for j in range(64)], dtype=np.uint64)
    fp = np.unique(np.concatenate([*alike, clump]))
    pairs = [(i, i + 1 + int(j)) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= 3)]
    want = {}
    for v, c in zip(fp.view(np.int64).tolist(), components(len(fp), pairs)):
        want.setdefault(c, set()).add(v)
    links = fingerprint_links(spark.createDataFrame(pd.DataFrame({"print": fp.view(np.int64)})), 3, block=128)
    assert links.count() < 60 * len(fp)  # forests, not pairs
    got = connected_components(links).toPandas()
    assert {frozenset(x.id) for _, x in got.groupby("component_id")} == {frozenset(x) for x in want.values() if len(x) > 1}


def test_components_of_chains_stars_loops_and_nulls(spark):
    edges = [(i, i + 1) for i in range(100, 220)] + [(300, 300 + i) for i in range(1, 80)] + [(500, 500), (None, 3), (4, None), (101, 100), (600, 601), (601, 602), (602, 600)]
    got = {r.id: r.component_id for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 221)} | {i: 300 for i in range(300, 380)} | {500: 500, 600: 600, 601: 600, 602: 600}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((12, 16))
    near = [c + rng.standard_normal(16) * s for c in centre for s in (0.05, 0.1, 0.2, 0.3) for _ in range(6)]
    vecs = [*centre, *near, *(centre[:3] * 7), centre[0], centre[0], centre[0] * 1e200, np.zeros(16)]
    rows = [(i, [float(x) for x in v], 1, 9) for i, v in enumerate(vecs)]
    rows += [(900, None, 1, 9), (901, [], 1, 9), (902, [float("nan")] * 16, 1, 9), (903, [None] * 16, 1, 9), (904, [1.0, float("inf")], 1, 9), (905, [1.0, 2.0], 1, 9), (906, [1.0, 2.0], 1, 9),
             (None, [1.0, 2.0], 1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n long").repartition(3)
    got = {r.vec_id: r for r in near_duplicate_vectors(df, recall=0.99999, block=16).collect()}
    with np.errstate(over="ignore"):
        x = np.array(vecs[:-1]) / np.abs(np.array(vecs[:-1])).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    comp = components(len(x), [(i, j) for i, j in zip(*np.nonzero(link)) if j < i])
    for i in range(len(x)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[i].sum(), comp[i], comp[i] == i)
    for i in (len(x), 900, 901, 902, 903, 904):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[905].n_links, got[906].component_id, got[906].kept, got[None].component_id, got[None].kept) == (2, 905, False, 905, False)
    assert near_duplicate_vectors(df.limit(0)).count() == 0


def test_recall_of_the_plan():
    for n in (10, 50_000, 10 ** 9):
        bits, tables = plan_tables(n, 0.95, 0.999)
        same = 1 - np.arccos(0.95) / np.pi
        assert 1 - (1 - same ** bits) ** tables >= 0.999 and n / 2 ** bits <= 1024
