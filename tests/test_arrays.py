"""Features as arrays against the operators on long tables, and projections at sizes the old form refused."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plexlake.operators import arrays, batch, clean, model, normalize, project, reshape
from plexlake.plans import workflows as w
from plexlake.plans.session import materialise

SAMPLES = [f"plex{p}_t_{c}" for p in (1, 2) for c in range(6)]
PLEX = [s.split("_")[0] for s in SAMPLES]
POOL = [s.endswith("_5") for s in SAMPLES]
GROUP = ["ABC"[int(s[-1]) % 3] for s in SAMPLES]


def wide_frame(spark, repeats, missing=0.15, n=40, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(n):
        base = rng.normal(20, 2)
        for _ in range(1 + (f % 3 if repeats else 0)):
            v = base + rng.normal(size=12) + np.array([float(p == "plex2") for p in PLEX])
            rows.append((f"f{f:02d}", *[None if rng.random() < missing else float(x) for x in v]))
    rows.append(("empty", *[None] * 12))
    rows.append(("flat", *[3.0] * 12))
    return spark.createDataFrame(rows, ", ".join(["protein_group string", *[f"{s} double" for s in SAMPLES]])).repartition(3)


def long_frame(wide):
    long = reshape.to_long(wide, SAMPLES, "normalized_intensity")
    about = pd.DataFrame({"sample_name": SAMPLES, "plex": PLEX, "exp_group": GROUP, "sample_or_pool": ["POOL" if p else "sample" for p in POOL]})
    return long.join(wide.sparkSession.createDataFrame(about), "sample_name")


def rows_of(df, *columns):
    """Rows in order; doubles to eight decimals, plus 0.0 against signed zeros."""
    rounded = [(F.round(c, 8) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.select(*columns).dtypes]
    return [tuple(r) for r in df.select(*rounded).orderBy(*columns).collect()]


@pytest.mark.parametrize("repeats", [False, True])
@pytest.mark.parametrize("share", [0.0, 0.2, 1.0])
def test_filter_and_imputation(spark, repeats, share):
    wide = wide_frame(spark, repeats)
    raw, hot = arrays.gather(wide, SAMPLES)
    assert hot is None
    long = long_frame(wide)
    for groups, how in ((None, "no"), (GROUP, "group_median")):
        table = arrays.normalise(raw, 12, range(12), [0.0] * 12, share, groups)
        got = arrays.to_long(table, SAMPLES, {"v": "normalized_intensity"})
        want = normalize.impute(clean.filter_missing(long, share, "normalized_intensity"), "normalized_intensity", how)
        names = ["protein_group", "sample_name", "normalized_intensity"]
        assert rows_of(got, *names) == rows_of(want, *names)


@pytest.mark.parametrize("repeats", [False, True])
@pytest.mark.parametrize("missing", [0.0, 0.15])
def test_batch_correction_cells_and_fit(spark, repeats, missing):
    wide = wide_frame(spark, repeats, missing)
    raw, _ = arrays.gather(wide, SAMPLES)
    table = materialise(arrays.normalise(raw, 12, range(12), [0.0] * 12, 1.0))
    long = materialise(long_frame(wide))
    batches = spark.createDataFrame(list(zip(SAMPLES, PLEX)), "sample_name string, batch string")
    names = ["protein_group", "sample_name", "unbatched_intensity"]
    pairs = [
        (arrays.pool_reference(table, PLEX, POOL), batch.pool_reference(long)),
        (arrays.combat(table, PLEX)[0], batch.combat(long, batches)),
    ]
    for got, want in pairs:
        assert rows_of(arrays.to_long(got, SAMPLES, {"u": "unbatched_intensity"}), *names) == rows_of(want, *names)
        cells = arrays.cells(got, 12, "u")
        medians = reshape.cells(want, "unbatched_intensity")
        assert rows_of(arrays.cells_to_long(cells, SAMPLES, "unbatched_intensity"), *names) == rows_of(medians, *names)
        groups = spark.createDataFrame(list(zip(SAMPLES, GROUP)), "sample_name string, exp_group string").where("exp_group <> 'B'")
        fitted = model.fit_groups(medians.join(groups, "sample_name"), "unbatched_intensity")
        mine = arrays.fit_groups(cells, [g if g != "B" else None for g in GROUP])
        columns = ["protein_group", "n_obs", "df", "sigma2", "ave_expr"]
        assert rows_of(mine, *columns) == rows_of(fitted, *columns)
        per = lambda d: {(r.protein_group, g): (c.n, round(c.mean, 8)) for r in d.collect() for g, c in r.groups.items()}
        assert per(mine) == per(fitted)


def _quantify(spark, wide, monkeypatch, most, **settings):
    monkeypatch.setattr(arrays, "MOST_ROWS", most)
    numbers = [("POOL" if p else "sample_") + str(i) for i, p in enumerate(POOL)]
    rows = [(n, s, "POOL" if p else g, g) for n, s, p, g in zip(numbers, SAMPLES, POOL, GROUP)]
    meta = spark.createDataFrame(rows, "sample_number string, sample_name string, group_number string, exp_group string")
    notes = wide.select("protein_group").distinct()
    return w.quantify(w.Features(wide, SAMPLES, notes), meta, w.Settings(**settings))


@pytest.mark.parametrize("settings", [
    {"batch": "none", "imputation": "sample_floor", "max_missing": 0.3}, {"batch": "pool", "renormalise": True, "max_missing": 0.0, "removed_samples": [SAMPLES[1]]},
    {"batch": "combat", "imputation": "group_median"},
])
def test_features_with_many_rows_go_the_long_way(spark, monkeypatch, settings):
    """Splitting off every repeated feature changes no table."""
    wide = wide_frame(spark, True, 0.02)
    wide = wide.select("protein_group", *[F.pow(F.lit(2.0), F.col(s)).alias(s) for s in SAMPLES])
    tables = [_quantify(spark, wide, monkeypatch, most, **settings) for most in (1_000, 1)]
    assert any(int(r.protein_group[1:]) % 3 for r in tables[0]["expression_matrix"].where("protein_group LIKE 'f0%'").collect())
    for name in ("processed", "expression_matrix", "overall", "by_contrast", "boxes_unbatched", "missing_histogram"):
        a, b = (t[name] for t in tables)
        columns = [c for c, t in a.dtypes if not t.startswith("array")]
        assert rows_of(a, *columns) == rows_of(b, *columns), name


@pytest.mark.parametrize("repeats,shuffles", [(False, 0), (True, 1)])
def test_one_shuffle_by_feature_from_input_to_fit(spark, tmp_path, repeats, shuffles):
    wide_frame(spark, repeats).write.parquet(str(tmp_path / "wide"))
    raw, _ = arrays.gather(spark.read.parquet(str(tmp_path / "wide")), SAMPLES)
    table = arrays.pool_reference(arrays.normalise(raw, 12, range(12), [0.0] * 12, 1.0), PLEX, POOL)
    fit = arrays.fit_groups(arrays.cells(table, 12, "u"), GROUP)
    plan = fit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("AQEShuffleRead") == shuffles
    matrix = arrays.matrix(arrays.cells(table, 12, "u"), SAMPLES)
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == shuffles and "pivot" not in plan.lower()


def test_repeated_cells_are_refused(spark):
    rows = spark.createDataFrame([("a", "s", 1.0), ("a", "s", 2.0)], "protein_group string, sample_name string, v double")
    with pytest.raises(Exception, match="several rows"):
        arrays.from_cells(rows, ["s"], "v").collect()


# --- projections ----------------------------------------------------------------------------


def _cells(spark, x):
    rows = [(f"f{i}", [None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "protein_group string, c array<double>").repartition(3)


def test_leading_components_equal_the_svd(spark):
    """400 samples, so that blocks do not span them at once; 12 planted directions over noise."""
    rng = np.random.default_rng(5)
    n, p = 400, 600
    x = rng.normal(size=(p, n)) + (rng.normal(size=(p, 12)) * np.linspace(3, 1.5, 12)) @ rng.normal(size=(12, n))
    z = x.T - x.T.mean(axis=0)
    z /= z.std(axis=0, ddof=1)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    values, vectors, seen = project.principal_axes(materialise(_cells(spark, x)), n, 12)
    assert seen == p and values == pytest.approx(s[:12] ** 2 / (n - 1), rel=1e-9)
    assert np.abs((vectors * u[:, :12]).sum(axis=0)) == pytest.approx(np.ones(12), abs=1e-6)


def test_unsettled_components_are_an_error(spark):
    x = np.random.default_rng(6).normal(size=(80, 60))
    with pytest.raises(ArithmeticError):
        project.principal_axes(_cells(spark, x), 60, 3, most_passes=1)
    values, _, _ = project.principal_axes(_cells(spark, x), 60, 3)  # noise: the blocks go on until they span enough
    assert values == pytest.approx(np.linalg.eigvalsh(_gram(x))[::-1][:3], rel=1e-8)


def _gram(x):
    z = (x - x.mean(axis=1, keepdims=True)) / x.std(axis=1, ddof=1, keepdims=True)
    return z.T @ z / (x.shape[1] - 1)


def test_rows_of_products_in_tiles_and_strips(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(30, 25))
    x[3, 4] = np.nan
    x[5] = 1.0
    rows = project.gram_rows(_cells(spark, x), 25, tile=8, most_bytes=8 * 32 * 2 * 7)  # four strips
    good = x[[i for i in range(30) if i != 3]]
    scaled = np.delete(x, [3, 5], axis=0)
    for kind, want, count in (("raw", good.T @ good, 29), ("scaled", _gram(scaled) * 24, 28)):
        got = project.gram_long(rows, 25, kind, 8).toPandas()
        assert len(got) == 625 and set(got.n_features) == {count}
        assert got.pivot(index="i", columns="j", values="g").to_numpy() == pytest.approx(want)


def test_six_thousand_samples(spark):
    """More samples than the matrix columns of old: products, neighbours and components."""
    rng = np.random.default_rng(8)
    n, p = 6_000, 40
    x = rng.normal(size=(p, n)) + 4 * rng.normal(size=(p, 3)) @ rng.normal(size=(3, n))
    cells = materialise(_cells(spark, x))
    names = [f"s{(i * 7919) % n:05d}" for i in range(n)]
    rows = materialise(project.gram_rows(cells, n, ["raw"]))
    near = project.nearest_neighbours(rows, names, 3)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    got = near.where(F.col("sample_a").isin(names[:5])).toPandas()
    assert near.count() == 3 * n
    for i in range(5):
        d = np.linalg.norm(x - x[:, [i]], axis=0)
        want = [names[j] for j in np.argsort(d)[:3]]
        assert got[got.sample_a == names[i]].sort_values("neighbour").sample_b.tolist() == want
    values, _, seen = project.principal_axes(cells, n, 5)
    z = (x - x.mean(axis=1, keepdims=True)) / x.std(axis=1, ddof=1, keepdims=True)
    assert seen == p and values == pytest.approx(np.linalg.svd(z, compute_uv=False)[:5] ** 2 / (n - 1), rel=1e-8)


def test_neighbours_at_equal_distance_go_by_name(spark):
    x = np.zeros((3, 5))
    x[0] = [0, 1, -1, 0, 5]
    names = ["m", "z", "a", "b", "q"]
    rows = project.gram_rows(_cells(spark, x), 5, ["raw"], tile=2)
    got = project.nearest_neighbours(rows, names, 3, tile=2).where("sample_a = 'm'").orderBy("neighbour").collect()
    assert [r.sample_b for r in got] == ["m", "b", "a"]
