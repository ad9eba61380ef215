import hashlib
import math

import numpy as np
import pytest

from plexlake.llm import clusters, codes, matrices

SCHEMA = "vec_id long, embedding array<double>, label string, cluster int, v int"


def _whole(rows, dims):
    good = [(i, v, k) for i, v, k in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    return [r[0] for r in good], np.array([[math.floor(256 * x) for x in r[1]] for r in good], np.int64).reshape(-1, dims), [r[2] for r in good]


def _nearest(x, points):
    d = ((x[:, None] - points[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def _means(x, at, points):
    out = points.copy()
    for k in range(len(points)):
        if (at == k).any():
            out[k] = [int(s) // int((at == k).sum()) for s in x[at == k].sum(axis=0)]
    return out


def _plain_clusters(rows, s):
    ids, x, _ = _whole(rows, s.dims)
    order = sorted(range(len(ids)), key=lambda n: (ids[n] is None, hashlib.sha256(f"{s.seed}{ids[n]}".encode()).hexdigest(), x[n].tolist()))
    points = x[order[: s.centroids]]
    for _ in range(s.rounds):
        points = _means(x, _nearest(x, points)[0], points)
    at, d = _nearest(x, points)
    return ids, at, d, points


def _rows(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(max(2, n // 20), dims)) * spread
    x = base[rng.integers(0, len(base), n)] + rng.normal(scale=0.1 * spread, size=(n, dims))
    x[n // 2 : n // 2 + n // 3] = x[0]  # one vector is a third of all
    return [(int(i), v.tolist(), [None, "a", "b"][int(rng.integers(3))]) for i, v in zip(rng.permutation(n), x)]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("dims,spread,k", [(2, 0.05, 40), (2, 1.0, 7), (8, 0.3, 12), (64, 0.1, 40), (3, 0.01, 1)])
def test_clusters_against_brute_force(spark, dims, spread, k):
    s = clusters.Settings(dims=dims, centroids=k)
    rows = _rows(dims, 300, dims, spread)
    got = clusters.cluster(_frame(spark, rows), s)
    ids, at, d, points = _plain_clusters(rows, s)
    assert got.centroids.tolist() == points.tolist()
    assert {r.vec_id: (r.cluster, r.distance) for r in got.members.collect()} == dict(zip(ids, zip(at.tolist(), d.tolist())))


def test_described_clusters(spark):
    s = clusters.Settings(dims=4, centroids=5)
    rows = _rows(1, 80, 4, 1.0)
    ids, at, d, points = _plain_clusters(rows, s)
    for r in clusters.cluster(_frame(spark, rows), s).described().collect():
        n = ids.index(r.vec_id)
        assert (r.cluster, r.cluster_inertia, r.inertia) == (at[n], d[at == at[n]].sum(), d.sum())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, points[at[n]])).encode()).hexdigest()


BAD = [(90, None, "a"), (91, [], "a"), (92, [1.0], "a"), (93, [1.0, None], None), (94, [math.nan, 1.0], "a"), (95, [math.inf, 1.0], "b")]


def test_unusable_and_few_vectors(spark):
    rows = [*BAD, (1, [0.1, 0.2], "a"), (2, [0.1, 0.2], "a"), (2, [0.1, 0.2], None), (None, [5.0, -1e300], None)]
    got = clusters.cluster(_frame(spark, rows), clusters.Settings(dims=2)).members.collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 0, 0), (2, 0, 0), (2, 0, 0), (None, 3, 0)], key=str)
    coded = codes.compress(_frame(spark, rows), codes.Settings(dims=2, parts=2)).described().collect()
    assert sorted((r.vec_id or 0, r.code, r.error, r.label_error) for r in coded) == [(0, "0303", 0, 0), (1, "0000", 0, 0), (2, "0000", 0, 0), (2, "0000", 0, 0)]
    for empty in (_frame(spark, rows).limit(0), _frame(spark, BAD)):
        assert clusters.cluster(empty, clusters.Settings(dims=2)).described().count() == 0
        assert codes.compress(empty, codes.Settings(dims=2, parts=2)).described().count() == 0


def _plain_codes(rows, s):
    ids, x, labels = _whole(rows, s.dims)
    order = sorted(range(len(ids)), key=lambda n: (ids[n], x[n].tolist()))[: s.entries]
    out, errors, books = [], 0, []
    for p in range(s.parts):
        part = x[:, p * s.width : (p + 1) * s.width]
        book = part[order]
        for _ in range(s.rounds):
            book = _means(part, _nearest(part, book)[0], book)
        at, d = _nearest(part, book)
        out.append(at)
        errors = errors + d
        books.append(book)
    return ids, labels, np.stack(out, axis=1), errors, np.stack(books)


@pytest.mark.parametrize("dims,parts,entries,rounds,spread", [(8, 2, 16, 2, 1.0), (64, 16, 64, 2, 0.1), (4, 4, 30, 6, 0.05), (6, 3, 1, 2, 1.0)])
def test_codes_against_brute_force(spark, dims, parts, entries, rounds, spread):
    s = codes.Settings(dims=dims, parts=parts, entries=entries, rounds=rounds)
    rows = _rows(dims + 1, 300, dims, spread)
    got = codes.compress(_frame(spark, rows), s)
    ids, labels, code, errors, books = _plain_codes(rows, s)
    assert got.codebooks.entries.tolist() == books.tolist()
    want = {}
    for n, label in enumerate(labels):
        want[ids[n]] = (bytes(code[n].tolist()).hex(), errors[n], sum(e for e, k in zip(errors, labels) if k == label))
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got.described().collect()} == want
    for r in got.decoded().limit(20).collect():
        n = ids.index(r.vec_id)
        assert r.embedding == [x / 256 for p in range(parts) for x in books[p][code[n, p]].tolist()]


def test_searches_compare_less(monkeypatch):
    """Bounds, rings and cores: far fewer comparisons than rows times centroids where vectors cluster."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-2000, 2000, (40, 8))
    x = centres[rng.integers(0, 40, 4000)] + rng.integers(-20, 20, (4000, 8))
    compared, real = [0], matrices.square

    def counted(a, b):
        compared[0] += max(len(a), len(b))
        return real(a, b)

    monkeypatch.setattr(matrices, "square", counted)
    state = np.zeros(4000, np.int64), np.ones(4000, np.int64), np.full(4000, np.inf), np.zeros(4000)
    found = clusters.search(x, state, clusters.Centres(centres))
    moved = clusters.Centres(centres + 1, centres)
    compared[0] = 0
    again = clusters.search(x, found, moved)
    assert compared[0] < 8000 and (again[0] == _nearest(x, centres + 1)[0]).all()
    own = found[0]
    radii = np.sqrt(real(x, centres[own]))
    ball = np.zeros(40)
    np.maximum.at(ball, own, radii)
    compared[0] = 0
    assert (codes.Balls(centres, ball, np.ones(40, bool)).nearest(x, own) == own).all()
    assert compared[0] < 12_000  # 40 * 40 gaps, and each part with its own entry
