import numpy as np
from pyspark.sql import functions as F

from perptide.llm import cover_tree as ct

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int"


def brute(rows, k):
    whole = [(i, np.floor(1024 * np.array(v, np.float32).astype(float))) for i, v in rows
             if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    asking = {}
    for i, v in whole:
        if i % 10 == 0 and (i not in asking or list(v) < list(asking[i])):
            asking[i] = v
    out = []
    for i, q in asking.items():
        found = sorted((-int(q @ v), j) for j, v in whole if j != i and len(v) == len(q))[:k]
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(found)]
    return sorted(out)


def test_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4) / 2]) for i in range(300)]
    rows += [(301, None), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan")] * 4), (304, [float("inf")] * 4)]
    rows += [(None, [1.0] * 4), (20, [1.0, 1.0, 1.0, 1.0]), (77, [1.0] * 4), (77, [1.0] * 4), (310, [1.0, 2.0]), (311, [])]
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    for size in (1000, 7):
        got = ct.search(frame, F.col("vec_id") % 10 == 0, query_block=size)
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10)


def test_fewer_candidates_and_empty_table(spark):
    frame = spark.createDataFrame([(0, [1.0], 0, "x", 1), (1, [0.5], 0, "x", 1)], SCHEMA)
    assert [tuple(r) for r in ct.search(frame, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 512)]
    assert ct.search(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_trees_cover_and_prune():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(40, 8)) * 4000
    x = np.floor(centers[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 30)
    tree = ct.cover_tree(x)

    def walk(node):
        away = np.sqrt(((x[node.points] - node.center) ** 2).sum(axis=1))
        assert away.max() <= node.radius + 1e-6
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
        for child in node.children:
            walk(child)

    walk(tree)
    ids, best = np.arange(len(x)), ct.Best(np.full(100, -np.inf), 10)
    scored = ct.dual_search(ct.cover_tree(x[:100], ct.QUERY_LEAF), x[:100], ids[:100], tree, x, ids, best)
    scores = x[:100] @ x.T
    scores[np.arange(100), np.arange(100)] = -np.inf
    assert (np.sort(scores, axis=1)[:, ::-1][:, :10] == best.scores).all()
    assert scored < scores.size / 2


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(11)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=64) * (3e4 if i % 3 else 1e5)]) for i in range(200)]
    rows += [(i, [2.0**20, *[0.0] * 62, i / 1024]) for i in range(200, 230)]
    rows += [(230, [2.0**21, *[0.0] * 62, 1.0])]
    exact = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    expected = []
    for i in range(0, 231, 10):
        found = sorted((-sum(a * b for a, b in zip(exact[i], exact[j], strict=True)), j) for j in exact if j != i)[:10]
        expected += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(found)]
    frame = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    got = ct.search(frame, F.col("vec_id") % 10 == 0).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)
    assert max(s for *_, s in expected) > 2**53
