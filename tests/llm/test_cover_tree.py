from math import floor, isfinite

import numpy as np
import pytest

from tessera.llm.cover_tree import BASE, LEAF, NONE, Best, CoverTree, Points, dual_search, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, row string, node int, score double"


def brute(rows, k=5, every=50, scale=256):
    """Every query against every other row."""
    kept = [(i, [floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    out = []
    for at, (i, v) in enumerate(kept):
        if i is not None and i % every == 0:
            hits = [(-sum(x * y for x, y in zip(v, w, strict=False)), j is None, j or 0, j) for other, (j, w) in enumerate(kept) if other != at]
            out += [(i, rank, j, -s) for rank, (s, _, _, j) in enumerate(sorted(hits)[:k], 1)]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "x", 2, 0.5) for i, v in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in top_k(df, **kw).collect()), key=str)


def clustered(n, dim, rng):
    centres = rng.normal(size=(6, dim))
    return [[float(np.float32(x)) for x in centres[rng.integers(6)] * 2 + rng.normal(size=dim) * 0.1] for _ in range(n)]


def test_whole_table_of_awkward_rows(spark):
    rng = np.random.default_rng(1)
    vectors = clustered(700, 6, rng)
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(1000 + i, vectors[3]) for i in range(250)]  # copies: ties by the dozen, a hot node
    rows += [(5000, None), (5050, [1.0, None]), (5100, [float("nan")] * 6), (5150, [float("inf")] * 6), (5200, []), (5250, [0.5, 0.5]), (-50, [0.1] * 6)]
    rows += [(100, vectors[100]), (100, vectors[7]), (None, vectors[8]), (None, vectors[3])]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, chunk_rows=40, chunks=2, nodes=5, sample=200, block_rows=4) == want
    assert run(spark, rows, k=1, every=1, chunks=3) == brute(rows, k=1, every=1)


def test_few_rows_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, None)]) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(0, [1.0]), (1, [-1.0]), (50, [1.0])]) == brute([(0, [1.0]), (1, [-1.0]), (50, [1.0])])


def test_scores_beyond_doubles_are_exact_or_refused(spark):
    rows = [(0, [300_001.0, 300_007.0]), (1, [300_000.0, 300_007.0]), (2, [300_001.0, 300_006.0]), (3, [300_000.5, 300_006.5])]
    assert run(spark, rows) == brute(rows)
    with pytest.raises(ValueError, match="too large"):
        run(spark, [(0, [1e30]), (1, [1.0])])


def test_nodes_cover_their_points_and_children_stand_apart():
    rng = np.random.default_rng(3)
    points = np.floor(256 * np.array(clustered(3000, 4, rng)))
    tree = CoverTree(points)
    assert len(tree.radius) > 50
    assert sorted(tree.order.tolist()) == list(range(3000))
    for n in range(len(tree.radius)):
        own = points[tree.order[tree.start[n] : tree.end[n]]]
        assert np.sqrt(((own - tree.centre[n]) ** 2).sum(axis=1)).max() <= tree.radius[n] + 1e-9
        kids = range(tree.first[n], tree.last[n])
        if kids:
            assert (tree.centre[kids[0]] == tree.centre[n]).all()
            assert all(tree.radius[k] <= tree.radius[n] / BASE + 1e-6 for k in kids)
            apart = np.sqrt(((tree.centre[kids][:, None] - tree.centre[kids][None]) ** 2).sum(axis=2)) + np.eye(len(kids)) * 1e9
            assert apart.min() > tree.radius[n] / BASE - 1e-6
            assert sum(tree.end[k] - tree.start[k] for k in kids) == tree.end[n] - tree.start[n]
        else:
            assert len(own) <= max(LEAF, 3000)


def test_pruned_search_is_exact_and_saves_pairs():
    rng = np.random.default_rng(4)
    x = np.floor(256 * np.array(clustered(2000, 5, rng)))
    data = Points(np.arange(2000), np.arange(2000), np.zeros(2000, bool), x)
    of = np.arange(0, 2000, 20)
    best = Best(Points(of, of, np.zeros(100, bool), x[of]), np.full(100, NONE), 5)
    seen = []
    offer = best.offer
    best.offer = lambda q, s, d, own: (seen.append(s.size), offer(q, s, d, own))
    dual_search(CoverTree(x[of]), best, CoverTree(x), data, True)
    scores = x[of] @ x.T
    scores[np.arange(100), of] = -1e18
    assert (np.sort(scores, axis=1)[:, :-6:-1] == best.score).all()
    assert sum(seen) < 0.6 * scores.size
