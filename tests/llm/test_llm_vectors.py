from __future__ import annotations

import math

import __spark_entry__ as contract
import numpy as np
import pytest
from llm_helpers import SMALL, table
from pyspark.sql import functions as F
from reviewlens.llm import covertree, permindex

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, cell int, score double, row long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab,
                                   "r", 1, 0.5, 3) for i, v, lab in rows], SCHEMA)


def usable(v) -> bool:
    return bool(v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v))


def brute_links(rows):
    """Links per row and the smallest id of each component. Rows are (id, vector, label)."""
    n, links, top = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    unit = [np.array(v, dtype=np.float64) if usable(v) and lab is not None else None for _, v, lab in rows]
    for a in range(n):
        for b in range(a):
            u, v = unit[a], unit[b]
            if u is None or v is None or rows[a][2] != rows[b][2] or len(u) != len(v):
                continue
            if (u * v).sum() / math.sqrt((u * u).sum() * (v * v).sum()) >= 0.98:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    least: dict = {}
    for k in range(n):
        least[find(k)] = min(least.get(find(k), rows[k][0]), rows[k][0])
    return [(rows[k][0], links[k], least[find(k)], rows[k][0] == least[find(k)]) for k in range(n)]


def check_links(spark, rows, cfg=covertree.CoverConfig()):
    got = covertree.near_vectors(frame(spark, rows), cfg=cfg).collect()
    assert sorted(map(tuple, got)) == sorted(brute_links(rows))


def test_cover_query_equals_brute_force(spark):
    e = table("embeddings")
    rows = list(zip(e.vec_id.tolist(), e.embedding.tolist(), e.label.tolist()))
    got = contract.queries()["op7_cover_tree"](spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(brute_links(rows))


def clustered(n: int, dim: int, seed: int, spread: float):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    v = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * spread
    v *= rng.choice([0.001, 1, 1000], size=(n, 1))
    return [(int(i), v[i].astype(np.float32).tolist(), int(rng.integers(0, 2))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.02, 0.1, 0.25])
def test_clusters_and_blocks(spark, spread):
    check_links(spark, clustered(220, 6, 1, spread), covertree.CoverConfig(block=32, centres=5))


def test_copies_bad_vectors_and_null_labels(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0], 0), (2, [1, 0], 0), (3, [2, 0], 0), (4, [1, 0], 1), (5, [1, 0], None), (6, [0, 0], 0),
            (7, [nan, 1], 0), (8, [inf, 1], 0), (9, [None, 1], 0), (10, None, 0), (11, [], 0), (12, [1, 0, 0], 0),
            (13, [0.98, math.sqrt(1 - 0.98**2)], 0), (14, [0, 1], 0)] + [(20 + k, [5, 5], 1) for k in range(30)]
    check_links(spark, rows)
    repeated = covertree.near_vectors(frame(spark, [(1, [1, 0], 0), (1, [1, 0], 0), (None, [1, 0], 0)])).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in repeated) == [
        (-1, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True)]
    assert covertree.near_vectors(frame(spark, [])).collect() == []


def test_trees_are_nested_covers():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    root = covertree.cover_tree(x, np.arange(300), 4)
    waiting = [root]
    while waiting:
        node = waiting.pop()
        away = np.sqrt(((x[node.members] - x[node.centre]) ** 2).sum(1))
        assert away.max() <= node.radius + 1e-12 and node.centre in node.members
        if node.children:
            assert node.children[0].centre == node.centre
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
            assert all(c.radius <= node.radius / 2 + 1e-12 for c in node.children)
            centres = x[[c.centre for c in node.children]]
            apart = np.sqrt(((centres[:, None] - centres) ** 2).sum(-1)) + np.eye(len(centres)) * 9
            assert apart.min() > node.radius / 2
        waiting += node.children


# ---------------------------------------------------------------- nearest neighbours


def brute_nearest(rows, is_query, k=10):
    good = [(i, np.array(v, dtype=np.float64)) for i, v, _ in rows if i is not None and usable(v)]
    out = {}
    for i, q in good:
        if is_query(i):
            near = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = near[:k]
    return out


def as_lists(found):
    out: dict = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_recall_of_the_query(spark, folder):
    e = table("embeddings", folder)
    rows = list(zip(e.vec_id.tolist(), e.embedding.tolist(), e.label.tolist()))
    want = brute_nearest(rows, lambda i: i % 100 == 0)
    got = as_lists(contract.queries()["op8_permutation_index"](spark, folder))
    assert got.keys() == want.keys()
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    true = {(q, j): s for q in want for s, j in want[q]}
    assert all(abs(s - true[q, j]) < 1e-12 for q in got for s, j in got[q] if (q, j) in true)


def test_copies_ties_and_bad_vectors(spark):
    nan = float("nan")
    rows = [(k, [1, 0], 0) for k in range(40)] + [(100, [1, 1], 0), (101, [1, 1], 0), (102, [-1, 3], 0), (103, [0, 0], 0),
            (104, [nan, 1], 0), (105, None, 0), (106, [None, 1], 0), (107, [1, 2, 3], 0), (None, [1, 0], 0)]
    search = lambda rows, **c: as_lists(permindex.search(
        frame(spark, rows), F.col("vec_id") % 25 == 0, cfg=permindex.IndexConfig(**c)))
    two = [r for r in rows if r[0] != 107]
    assert search(rows) == search(two) == brute_nearest(two, lambda i: i % 25 == 0)
    assert search(rows, shard=2, query_block=1) == search(rows)
    few = [(0, [1, 0], 0), (1, [0, 1], 0)]
    assert search(few) == brute_nearest(few, lambda i: i == 0)
    assert search([(0, [1, 0], 0)]) == {} and search([]) == {} and search([(0, None, 0)]) == {}


def test_footrule_gain_is_the_footrule_distance():
    rng = np.random.default_rng(1)
    pivots, k = 12, 5
    near = np.stack([rng.permutation(pivots)[:k] for _ in range(30)])
    files = permindex.inverted_files(near, pivots)

    def places(p):
        out = np.full(pivots, k)
        out[p] = np.arange(k)
        return out

    for own in near:
        gain = permindex.footrule_gain(files, own, 30)
        true = np.array([np.abs(places(own) - places(v)).sum() for v in near])
        assert (k * (k + 1) - 2 * gain == true).all()


def _nearest(rows, query, k=10):
    """Brute force over distinct (key, vector) rows."""
    own = [(float(np.sqrt(((np.array(v, dtype=np.float64) - np.array(query[1], dtype=np.float64)) ** 2).sum())), key)
           for key, v in rows if key != query[0]]
    return sorted(own)[:k]


def test_repeated_queries_lose_nothing(spark):
    rng = np.random.default_rng(3)
    rows = [(k, tuple(rng.normal(size=8).astype(np.float32).tolist())) for k in range(300)]
    repeated = rows + [rows[0]] * 11 + [rows[100]] * 2 + [(200, rows[201][1])] + [rows[7]] * 5
    frame = spark.createDataFrame(repeated, "vec_id long, embedding array<float>")
    got = permindex.search(frame, F.col("vec_id") % 100 == 0).collect()
    distinct = sorted(set(repeated))
    want = sorted((q[0], rank, key, round(away, 9)) for q in distinct if q[0] % 100 == 0
                  for rank, (away, key) in enumerate(_nearest(distinct, q), 1))
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == want


def test_recall_inside_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(9000, 32))
    x[::3] = x[0] + rng.normal(size=(3000, 32)) * 1e-3
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in permindex.search(frame, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = {True: [], False: []}
    for q in range(0, 9000, 100):
        away = ((x - x[q]) ** 2).sum(1)
        away[q] = np.inf
        recall[q % 3 == 0].append(len(got[q] & set(np.argsort(away)[:10].tolist())) / 10)
    assert np.mean(recall[True]) >= 0.9 and np.mean(recall[False]) >= 0.9
