import math

import numpy as np
import pytest

from plexlake.llm import vectors

from .helpers import groups


def _check(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS links", "2 AS block")
    got = {r.vec_id: r for r in vectors.near_vectors(frame.repartition(3)).collect()}
    usable = [
        (i, np.array(v), k) for i, v, k in rows
        if v and k is not None and all(x is not None and math.isfinite(x) for x in v) and np.linalg.norm(v) > 0
    ]
    linked = [
        (i, j) for n, (i, v, k) in enumerate(usable) for j, w, m in usable[:n]
        if k == m and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.98
    ]
    counts = {i: 0 for i, _, _ in rows}
    for pair in linked:
        for i in pair:
            counts[i] += 1
    assert {i: r.n_links for i, r in got.items()} == counts
    assert {i: r.component_id for i, r in got.items()} == groups(counts, linked)
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize("dims", [2, 8, 64])
def test_against_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_NUMBERS", 64)  # many blocks
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(60, dims))
    near = base[rng.integers(0, 60, 90)] + rng.normal(scale=0.1 * rng.random((90, 1)), size=(90, dims))
    points = np.concatenate([base, near, base[:10] * 3, base[:12], base[5:6].repeat(9, axis=0)])
    _check(spark, [(i, v.tolist(), int(rng.integers(0, 2))) for i, v in enumerate(points)])


def test_unusable_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0], 1),
    ]
    _check(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(empty).count() == 0


def test_trees_lose_no_pair():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    x = np.concatenate([x, x[:100] + rng.normal(scale=0.02, size=(100, 5))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = vectors.Tree(x)
    reach = 0.2
    found = set()
    for i, j in vectors.near_pairs(tree, tree, reach):
        found.update(zip(i.tolist(), j.tolist()))
    gaps = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert {tuple(p) for p in np.argwhere(gaps <= reach).tolist()} <= found
    assert len(found) < 400 * 400 / 4
