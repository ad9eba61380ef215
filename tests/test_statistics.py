"""Distributed statistics against plain numpy on small random data."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plexlake.functions import special
from plexlake.functions.quantiles import cell_median, exact_quantiles, quantiles_by_counts
from plexlake.operators import arrays, batch, clean, model, project, results
from plexlake.plans import sizing
from plexlake.plans.session import materialise

GROUPS = {f"plex{p}_t_{c}": "ABC"[c % 3] for p in (1, 2) for c in range(6)}


def long_frame(seed=0, n=60, effect=None, missing=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(n):
        base, sd = rng.normal(20, 2), math.sqrt(rng.chisquare(6) / 6)
        for s, g in GROUPS.items():
            shift = effect if effect and f < 5 and g == "A" else 0.0
            v = None if rng.random() < missing else base + shift + rng.normal(0, sd)
            rows.append((f"p{f:03d}", s, g, s.split("_")[0], v))
    return pd.DataFrame(rows, columns=["protein_group", "sample_name", "exp_group", "plex", "v"])


@pytest.fixture(scope="module")
def pdf():
    return long_frame(effect=4.0)


@pytest.fixture(scope="module")
def long(spark, pdf):
    return spark.createDataFrame(pdf)


# --- special functions -----------------------------------------------------------------


@pytest.mark.parametrize("t,df,p", [(12.7062047362, 1, 0.05), (2.2281388520, 10, 0.05), (2.5706, 5, 0.05), (1.959963985, 1e12, 0.05)])
def test_t_tail_known_points(t, df, p):
    assert special.t_two_sided([t], [df])[0] == pytest.approx(p, abs=2e-6)


def test_t_tail_is_continuous_in_large_df():
    tails = special.t_two_sided(np.full(4, 3.0), np.array([1e8, 9e9, 1.1e10, 1e15]))
    assert np.ptp(tails) < 1e-9


def test_f_with_two_numerator_df_has_closed_form():
    f, v = np.array([0.1, 1.0, 7.5]), np.array([4.0, 33.0, 500.0])
    assert special.f_upper(f, 2, v) == pytest.approx((1 + 2 * f / v) ** (-v / 2), rel=1e-10)


def test_f_with_one_numerator_df_is_t_squared():
    t, v = np.array([0.3, 2.0, 5.0]), np.array([3.0, 12.0, 80.0])
    assert special.f_upper(t * t, 1, v) == pytest.approx(special.t_two_sided(t, v), rel=1e-12)


def test_quantile_inverts_tail():
    p, v = np.array([0.4, 0.01, 1e-9]), np.array([2.0, 20.0, 300.0])
    assert special.t_two_sided(special.t_upper_quantile(p, v), v) / 2 == pytest.approx(p, rel=1e-9)


def test_gamma_derivatives(spark):
    assert special.digamma_value(1.0) == pytest.approx(-0.5772156649015329, abs=1e-12)
    assert special.trigamma_value(0.5) == pytest.approx(math.pi**2 / 2, rel=1e-11)
    assert special.trigamma_inverse(math.pi**2 / 6) == pytest.approx(1.0, rel=1e-9)
    row = spark.range(1).select(special.digamma(F.lit(2.5)).alias("d"), special.trigamma(F.lit(2.5)).alias("t")).first()
    assert row["d"] == pytest.approx(special.digamma_value(2.5), abs=1e-14)
    assert row["t"] == pytest.approx(special.trigamma_value(2.5), abs=1e-14)


# --- quantiles -------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["normal", "ties", "outlier", "tiny"])
def test_counted_quantiles_are_exact(spark, shape):
    rng = np.random.default_rng(1)
    frames = []
    for key, n in (("a", 7001), ("b", 2500), ("c", 3)):
        n = min(n, 4) if shape == "tiny" else n
        v = {
            "normal": rng.normal(size=n), "ties": rng.integers(0, 4, n).astype(float),
            "outlier": np.concatenate([rng.normal(size=n - 1), [1e12]]), "tiny": rng.normal(size=n),
        }[shape]
        frames.append(pd.DataFrame({"k": key, "v": v}))
    data = pd.concat([*frames, pd.DataFrame({"k": ["z", "z", "a"], "v": [np.nan] * 3})])
    df = spark.createDataFrame(data).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    probs = [0.0, 0.005, 0.25, 0.5, 0.75, 1.0]
    got = {r["k"]: r for r in quantiles_by_counts(df, ["k"], "v", probs, 4).collect()}
    built_in = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    for frame in frames:
        key = frame["k"].iloc[0]
        assert list(got[key]["q"]) == pytest.approx(list(np.quantile(frame["v"], probs)), rel=1e-12)
        assert list(built_in[key]["q"]) == pytest.approx(list(got[key]["q"]), rel=1e-12)
        assert got[key]["n"] == len(frame)
    assert got["z"]["n"] == 0 and got["z"]["q"] == [None] * 6


def test_hot_cells_give_the_same_median(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame({"f": rng.choice(["x", "y", "z"], 600, p=[0.8, 0.15, 0.05]), "v": rng.normal(size=600)})
    df = spark.createDataFrame(data).unionByName(spark.createDataFrame([("y", None)], "f string, v double"))
    plain = {r["f"]: r["m"] for r in cell_median(df, ["f"], "v", "m").collect()}
    split = {r["f"]: r["m"] for r in cell_median(df, ["f"], "v", "m", hot_rows=80).collect()}
    assert plain["y"] is None
    assert split == pytest.approx(plain)
    skipping = {r["f"]: r["m"] for r in cell_median(df, ["f"], "v", "m", False, hot_rows=80).collect()}
    assert skipping == pytest.approx(data.groupby("f")["v"].median().to_dict())


# --- model -----------------------------------------------------------------------------

CONTRASTS = {"A_vs_B": {"A": 1.0, "B": -1.0}, "A_vs_C": {"A": 1.0, "C": -1.0}, "B_vs_C": {"B": 1.0, "C": -1.0}}


def reference_fit(pdf):
    rows = {}
    for f, g in pdf.dropna(subset=["v"]).groupby("protein_group"):
        means, sizes = g.groupby("exp_group")["v"].mean(), g.groupby("exp_group")["v"].size()
        rss = ((g["v"] - g["exp_group"].map(means)) ** 2).sum()
        rows[f] = {"means": means, "sizes": sizes, "df": len(g) - len(means), "rss": rss, "ave": g["v"].mean()}
    return rows


@pytest.mark.parametrize("missing", [0.0, 0.25])
def test_moderated_model_matches_direct_computation(spark, missing):
    pdf = long_frame(3, effect=3.0, missing=missing)
    long = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    fit = materialise(model.fit_groups(long, "v"))
    prior = model.variance_prior(fit)
    got = {(r["protein_group"], r["contrast"]): r for r in
           model.moderated_t(model.moderate(model.apply_contrasts(fit, CONTRASTS), prior)).collect()}

    ref = reference_fit(pdf)
    s2 = np.array([r["rss"] / r["df"] for r in ref.values() if r["df"] > 0])
    df = np.array([r["df"] for r in ref.values() if r["df"] > 0], float)
    s2 = np.maximum(s2, 1e-5 * np.median(s2))
    e = np.log(s2) - np.array([special.digamma_value(d / 2) for d in df]) + np.log(df / 2)
    excess = e.var(ddof=1) - np.mean([special.trigamma_value(d / 2) for d in df])
    assert excess > 0
    d0 = 2 * special.trigamma_inverse(excess)
    s02 = math.exp(e.mean() + special.digamma_value(d0 / 2) - math.log(d0 / 2))
    assert (prior.df0, prior.s02, prior.n_features) == (pytest.approx(d0), pytest.approx(s02), len(s2))
    for f, r in ref.items():
        post = (d0 * s02 + r["rss"]) / (d0 + r["df"])
        for name, w in CONTRASTS.items():
            row = got[f, name]
            if not set(w) <= set(r["means"].index):
                assert row["log_fc"] is None and row["t"] is None and row["p_value"] is None
                continue
            fc = sum(c * r["means"][g] for g, c in w.items())
            t = fc / math.sqrt(post * sum(c * c / r["sizes"][g] for g, c in w.items()))
            assert row["log_fc"] == pytest.approx(fc) and row["t"] == pytest.approx(t)
            assert row["ave_expr"] == pytest.approx(r["ave"])
            assert row["p_value"] == pytest.approx(special.t_two_sided([t], [min(d0 + r["df"], df.sum())])[0])


def test_planted_effect_is_found_and_null_is_uniform(spark, long):
    fit = materialise(model.fit_groups(long, "v"))
    table = results.contrast_results(fit, CONTRASTS).toPandas()
    hits = table[(table.contrast == "A_vs_B") & (table.adj_p_value < 0.05)].protein_group
    assert {f"p{i:03d}" for i in range(5)} <= set(hits)
    null = table[table.contrast == "B_vs_C"].p_value
    assert 0.3 < null.mean() < 0.7
    best = table[table.contrast == "A_vs_B"].sort_values("p_value")
    assert best.b.iloc[0] == best.b.max()


@pytest.mark.parametrize("missing", [0.0, 0.3])
def test_log_odds_match_direct_computation(spark, missing):
    pdf = long_frame(5, n=500, effect=5.0, missing=missing)
    long = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    fit = materialise(model.fit_groups(long, "v"))
    prior = model.variance_prior(fit)
    one = {"A_vs_B": CONTRASTS["A_vs_B"]}
    rows = model.moderated_t(model.moderate(model.apply_contrasts(fit, one), prior))
    table = model.log_odds(rows, prior, 1).toPandas().dropna(subset=["t"])
    t, df, u = table.t.abs().to_numpy(), table.df_total.to_numpy(), table.unscaled.to_numpy()
    n, top = len(t), math.ceil(0.005 * len(t))
    p0, max_df = special.t_two_sided(t, df), df.max()
    order = np.argsort(p0, kind="stable")[:top]
    t_same = special.t_upper_quantile(p0[order] / 2, np.full(top, max_df))
    share = max(top / n, 0.01)
    target = ((np.arange(1, top + 1) - 0.5) / n - (1 - share) * p0[order]) / share
    v0 = np.zeros(top)
    pos = target > p0[order]
    v0[pos] = u[order][pos] * ((t_same[pos] / special.t_upper_quantile(target[pos] / 2, np.full(pos.sum(), max_df))) ** 2 - 1)
    v0 = np.clip(v0, 0.01 / prior.s02, 16 / prior.s02).mean()
    r = (u + v0) / u
    expected = math.log(0.01 / 0.99) - np.log(r) / 2 + (1 + df) / 2 * np.log((t**2 + df) / (t**2 / r + df))
    assert table.b.to_numpy() == pytest.approx(expected, rel=1e-6)


def test_f_of_one_contrast_is_t_squared_and_rank_is_detected(spark, long):
    sizes = {"A": 4, "B": 4, "C": 4}
    fit = materialise(model.fit_groups(long, "v"))
    prior = model.variance_prior(fit)
    one = {"A_vs_B": CONTRASTS["A_vs_B"]}
    moderated = model.moderate(model.apply_contrasts(fit, one), prior)
    t = {r["protein_group"]: r for r in model.moderated_t(moderated).collect()}
    for r in model.f_statistics(fit, one, sizes, prior).collect():
        assert r["f"] == pytest.approx(t[r["protein_group"]]["t"] ** 2)
        assert r["p_value"] == pytest.approx(t[r["protein_group"]]["p_value"])
    assert model.GroupSpace.of(CONTRASTS, sizes).rank == 2
    full = {r["protein_group"]: r["f"] for r in model.f_statistics(fit, CONTRASTS, sizes, prior).collect()}
    two = {k: CONTRASTS[k] for k in ("A_vs_B", "A_vs_C")}
    for r in model.f_statistics(fit, two, sizes, prior).collect():
        assert full[r["protein_group"]] == pytest.approx(r["f"])


@pytest.mark.parametrize("contrasts", [
    model.pairwise_contrasts(list("ABCDE")), {**model.versus_rest("B", list("ABCDE")), "D_vs_E": {"D": 1.0, "E": -1.0}}, {"A_vs_B": {"A": 2.0, "B": -2.0}},
])
def test_f_in_group_space_equals_the_contrast_space(contrasts):
    """With and without missing measurements, against the eigenvectors of the contrasts' correlations."""
    rng = np.random.default_rng(9)
    sizes = dict(zip("ABCDE", (3, 4, 4, 2, 6)))
    full = np.array(list(sizes.values()), float)
    n = np.where(rng.random((30, 5)) < 0.3, np.maximum(full - 1, 0), full)
    n[:10] = full
    n[10] = [0, 4, 4, 2, 6]
    mean = np.where(n > 0, rng.normal(size=(30, 5)), np.nan)
    s2 = rng.chisquare(5, 30)
    c = np.array([[w.get(g, 0.0) for g in sizes] for w in contrasts.values()])
    cov = c / full @ c.T
    values, vectors = np.linalg.eigh(cov / np.sqrt(np.outer(np.diag(cov), np.diag(cov))))
    keep = values > 1e-8 * values.max()
    with np.errstate(all="ignore"):
        t = np.stack([np.where(c != 0, mean[i] * c, 0.0).sum(axis=1) / np.sqrt(np.where(c != 0, c**2 / n[i], 0.0).sum(axis=1) * s2[i]) for i in range(30)])
    want = ((t @ vectors[:, keep] / np.sqrt(values[keep])) ** 2).sum(axis=1) / keep.sum()
    got = model.GroupSpace.of(contrasts, sizes).f(mean, n, s2)
    assert got == pytest.approx(want, nan_ok=True) and np.isnan(got[10]) == any("A" in w for w in contrasts.values())


def test_three_hundred_groups_all_pairs(spark, monkeypatch):
    """44,850 contrasts as a table, in several broadcasts; F without a table of contrasts by contrasts."""
    groups = [f"g{i:03d}" for i in range(300)]
    rng = np.random.default_rng(10)
    rows = [(f"f{k}", g, float(v)) for k in range(4) for g in groups for v in rng.normal(size=2)]
    frame = pd.DataFrame(rows, columns=["protein_group", "exp_group", "v"])
    long = spark.createDataFrame(frame)
    fit = materialise(model.fit_groups(long.where("NOT (protein_group = 'f3' AND exp_group = 'g007')"), "v"))
    table = model.pairwise_table(spark, groups)
    model.check_contrast_table(table, groups)
    with pytest.raises(ValueError, match="unknown groups"):
        model.check_contrast_table(table, groups[1:])
    monkeypatch.setattr(model, "BROADCAST_ROWS", 20_000)
    out = model.apply_contrasts(fit, model.reverse_table(table, ["g003_vs_g250"]))
    assert out.count() == 4 * 44_850
    means = frame.groupby(["protein_group", "exp_group"]).v.mean()
    some = {(r["protein_group"], r["contrast"]): r for r in out.where("contrast IN ('g250_vs_g003', 'g001_vs_g002', 'g007_vs_g008')").collect()}
    assert len(some) == 12
    assert some["f1", "g250_vs_g003"]["log_fc"] == pytest.approx(means["f1", "g250"] - means["f1", "g003"])
    assert some["f1", "g250_vs_g003"]["unscaled"] == pytest.approx(1.0)
    assert some["f3", "g007_vs_g008"]["log_fc"] is None and some["f2", "g007_vs_g008"]["log_fc"] is not None
    prior = model.variance_prior(fit)
    f = model.f_statistics(fit, model.pairwise_contrasts(groups), {g: 2 for g in groups}, prior, fold_changes=False)
    found = {r["protein_group"]: r["f"] for r in f.collect()}
    post = {r["protein_group"]: r["s2_post"] for r in model.moderate(fit, prior).collect()}
    x = means["f0"].to_numpy()
    assert found["f0"] == pytest.approx(2 * ((x - x.mean()) ** 2).sum() / 299 / post["f0"]) and found["f3"] is None


def test_no_contrast_gives_no_row(spark, long):
    fit = model.fit_groups(long, "v")
    assert model.apply_contrasts(fit, {}).count() == 0 and model.apply_contrasts(fit, {"none": {"A": 0.0}}).count() == 0


def test_effect_prior_of_large_contrasts(spark, long, monkeypatch):
    """The quantile cut of large tables changes nothing."""
    fit = materialise(model.fit_groups(long, "v"))
    prior = model.variance_prior(fit)
    rows = materialise(model.moderated_t(model.moderate(model.apply_contrasts(fit, CONTRASTS), prior)))
    few = {r["contrast"]: r["v0"] for r in model.effect_prior(rows, prior, 3).collect()}
    monkeypatch.setattr(model, "LARGE_GROUP_ROWS", 1)
    assert {r["contrast"]: r["v0"] for r in model.effect_prior(rows, prior, 3).collect()} == pytest.approx(few)


def test_reversed_contrast_negates(spark, long):
    reversed_ = model.reverse_contrasts(CONTRASTS, ["A_vs_C"])
    assert list(reversed_) == ["A_vs_B", "C_vs_A", "B_vs_C"]
    coefs = model.apply_contrasts(model.fit_groups(long, "v"), {**CONTRASTS, **reversed_})
    rows = {(r["protein_group"], r["contrast"]): r for r in model.ordinary_t(coefs).collect()}
    for (f, c), r in rows.items():
        if c == "C_vs_A":
            assert r["log_fc"] == pytest.approx(-rows[f, "A_vs_C"]["log_fc"])
            assert r["p_value"] == pytest.approx(rows[f, "A_vs_C"]["p_value"])


def test_contrast_checks_and_rest():
    rest = model.versus_rest("A", ["A", "B", "C"])
    assert rest == {"A vs. rest": {"A": 1.0, "B": -0.5, "C": -0.5}}
    with pytest.raises(ValueError, match="unknown groups"):
        model.check_contrasts({"x": {"A": 1.0, "Q": -1.0}}, ["A", "B"])


# --- adjusted p-values -----------------------------------------------------------------


def bh(p):
    p = np.asarray(p)
    order = np.argsort(p)
    raw = p[order] * len(p) / np.arange(1, len(p) + 1)
    adj = np.empty(len(p))
    adj[order] = np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1)
    return adj


@pytest.mark.parametrize("small_rows", [10**6, 10])
def test_bh_in_one_window_and_in_bins(spark, small_rows):
    rng = np.random.default_rng(4)
    frames = []
    for c, n in (("x", 900), ("y", 400)):
        p = np.concatenate([rng.random(n) ** 3, np.full(n // 2, 0.7)])
        frames.append(pd.DataFrame({"contrast": c, "id": [f"{c}{i}" for i in range(len(p))], "p_value": p, "want": bh(p)}))
    df = spark.createDataFrame(pd.concat(frames)).unionByName(
        spark.createDataFrame([("x", "none", None, None)], "contrast string, id string, p_value double, want double"))
    out = results.adjust_bh(df, by=["contrast"], small_rows=small_rows).toPandas()
    assert len(out) == len(pd.concat(frames)) + 1
    known = out[out.id != "none"]
    assert known.adj_p_value.to_numpy() == pytest.approx(known.want.to_numpy(), rel=1e-12)
    assert out[out.id == "none"].adj_p_value.isna().all()
    whole = results.adjust_bh(df.where("contrast = 'x'").drop("want"), small_rows=small_rows).toPandas()
    assert whole.dropna().adj_p_value.to_numpy() == pytest.approx(bh(whole.dropna().p_value), rel=1e-12)


def test_bh_with_one_value_in_a_third_of_the_rows(spark):
    """Equal p-values are spread over tasks as any others."""
    rng = np.random.default_rng(11)
    p = np.concatenate([rng.random(20_000), np.full(10_000, 0.25)])
    df = materialise(spark.createDataFrame(pd.DataFrame({"id": np.arange(len(p)), "p_value": p})).repartition(4))
    sizes = results._in_order(df, "p_value", []).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.max() < 2 * sizes.median()
    out = results.adjust_bh(df, small_rows=100).toPandas().sort_values("id")
    assert out.adj_p_value.to_numpy() == pytest.approx(bh(p), rel=1e-12)


def test_bh_of_small_and_large_groups_with_null_keys(spark):
    rng = np.random.default_rng(12)
    frames = [pd.DataFrame({"contrast": c, "p_value": rng.random(n) ** 2}) for c, n in (("x", 300), (None, 200), ("y", 20), ("z", 1))]
    for f in frames:
        f["want"] = bh(f.p_value)
    df = spark.createDataFrame(pd.concat(frames), "contrast string, p_value double, want double")
    out = results.adjust_bh(df, by=["contrast"], small_rows=50).toPandas()
    assert len(out) == 521 and out.adj_p_value.to_numpy() == pytest.approx(out.want.to_numpy(), rel=1e-12)
    assert results.adjust_bh(df.limit(0), by=["contrast"], small_rows=50).count() == 0


# --- batch and projection --------------------------------------------------------------


def combat_numpy(x, batches):
    labels = np.unique(batches)
    sizes = np.array([(batches == b).sum() for b in labels])
    means = np.stack([x[:, batches == b].mean(1) for b in labels], 1)
    grand = means @ sizes / sizes.sum()
    resid = x - means[:, np.searchsorted(labels, batches)]
    pooled = (resid**2).mean(1)
    z = (x - grand[:, None]) / np.sqrt(pooled)[:, None]
    out = np.empty_like(x)
    for b in labels:
        zb = z[:, batches == b]
        n, gh, dh = zb.shape[1], zb.mean(1), zb.var(1, ddof=1)
        gb, t2, m, s2 = gh.mean(), gh.var(ddof=1), dh.mean(), dh.var(ddof=1)
        a, bb = (2 * s2 + m * m) / s2, (m * s2 + m**3) / s2
        g, d = gh.copy(), dh.copy()
        for _ in range(500):
            g = (t2 * n * gh + d * gb) / (t2 * n + d)
            d = (0.5 * ((zb - g[:, None]) ** 2).sum(1) + bb) / (n / 2 + a - 1)
        out[:, batches == b] = (zb - g[:, None]) / np.sqrt(d)[:, None] * np.sqrt(pooled)[:, None] + grand[:, None]
    return out


def test_combat_matches_row_level_algorithm(spark, pdf):
    shifted = pdf.copy()
    shifted.loc[shifted.plex == "plex2", "v"] = shifted.v * 1.05 + 1.5
    wide = shifted.pivot(index="protein_group", columns="sample_name", values="v")
    labels = np.array([s.split("_")[0] for s in wide.columns])
    expected = pd.DataFrame(combat_numpy(wide.to_numpy(), labels), wide.index, wide.columns).stack()
    batches = spark.createDataFrame([(s, s.split("_")[0]) for s in GROUPS], "sample_name string, batch string")
    got = batch.combat(spark.createDataFrame(shifted), batches, "v").toPandas()
    got = got.set_index(["protein_group", "sample_name"]).unbatched_intensity
    assert got.sort_index().to_numpy() == pytest.approx(expected.sort_index().to_numpy(), rel=1e-7)
    gap = got.reset_index().assign(plex=lambda d: d.sample_name.str[:5]).groupby("plex").unbatched_intensity.mean()
    assert abs(gap["plex1"] - gap["plex2"]) < 0.2


def test_combat_passes_constant_features(spark, pdf):
    flat = pd.concat([pdf, pdf[pdf.protein_group == "p000"].assign(protein_group="flat", v=7.0)])
    batches = spark.createDataFrame([(s, s.split("_")[0]) for s in GROUPS], "sample_name string, batch string")
    out = batch.combat(spark.createDataFrame(flat), batches, "v").where("protein_group = 'flat'").toPandas()
    assert len(out) == len(GROUPS) and (out.unbatched_intensity == 7.0).all()


def test_pool_reference_removes_planted_plex_shift(spark, pdf):
    moved = pdf.assign(v=pdf.v.where(pdf.plex == "plex1", pdf.v + 3), sample_or_pool=np.where(pdf.sample_name.str.endswith("_5"), "POOL", "sample"))
    out = batch.pool_reference(spark.createDataFrame(moved), "v").toPandas()
    pools = out[out.sample_or_pool == "POOL"].pivot(index="protein_group", columns="plex", values="unbatched_intensity")
    assert pools["plex1"].to_numpy() == pytest.approx(pools["plex2"].to_numpy())


def test_pca_equals_svd(spark, pdf, long):
    samples = sorted(GROUPS)
    flat = long.where("protein_group = 'p000'").withColumn("protein_group", F.lit("flat")).withColumn("v", F.lit(1.0))
    holed = long.where("protein_group = 'p001'").withColumn("protein_group", F.lit("holed")).withColumn(
        "v", F.when(F.col("sample_name") != samples[0], F.col("v")))
    scores, components = project.pca(long.unionByName(flat).unionByName(holed), samples, "v")
    x = pdf.pivot(index="sample_name", columns="protein_group", values="v").loc[samples].to_numpy()
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    comp = components.toPandas().sort_values("component")
    assert comp.n_features.iloc[0] == 60
    assert comp.eigenvalue.sum() == pytest.approx(60)
    assert comp.eigenvalue.to_numpy() == pytest.approx(s[:11] ** 2 / 11)
    got = scores.toPandas().pivot(index="sample_name", columns="component", values="score").loc[samples].to_numpy()
    assert np.abs(got) == pytest.approx(np.abs(u[:, :11] * s[:11]), abs=1e-8)
    assert (got[np.abs(got).argmax(0), np.arange(11)] > 0).all()
    loadings = project.pca_loadings(project.standardise(long, "v", 12), scores, components, 12).toPandas()
    wide = loadings.pivot(index="protein_group", columns="component", values="loading")
    assert np.abs(wide.to_numpy()) == pytest.approx(np.abs(vt[:11].T), abs=1e-8)


def test_distances_and_neighbours(spark, pdf, long):
    samples = sorted(GROUPS)
    d = project.sample_distances(project.gram(long, samples, "v", scale=False), samples)
    x = pdf.pivot(index="sample_name", columns="protein_group", values="v").loc[samples].to_numpy()
    want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    got = d.toPandas().pivot(index="sample_a", columns="sample_b", values="distance").loc[samples, samples].to_numpy()
    assert got == pytest.approx(want, abs=1e-5)
    rows = project.gram_rows(arrays.from_cells(long, samples, "v"), len(samples))
    nearest = project.nearest_neighbours(rows, samples, 3).toPandas()
    assert len(nearest) == 36
    assert (nearest[nearest.neighbour == 1].sample_a == nearest[nearest.neighbour == 1].sample_b).all()


def test_row_order_does_not_matter(spark, pdf):
    a = results.contrast_results(model.fit_groups(spark.createDataFrame(pdf), "v"), CONTRASTS)
    b = results.contrast_results(model.fit_groups(spark.createDataFrame(pdf.sample(frac=1, random_state=1)), "v"), CONTRASTS)
    key = ["protein_group", "contrast"]
    a, b = (t.toPandas().sort_values(key).drop(columns=key).to_numpy(float) for t in (a, b))
    assert a == pytest.approx(b)


def _many_small_groups():
    rng = random.Random(11)
    rows = [(rng.choice([f"f{i}" for i in range(300)] + [None]), f"s{rng.randrange(4)}", rng.choice([None, 0.5, rng.random()])) for _ in range(3_000)]
    return [*rows, ("none", "s0", None), ("none", "s0", None)]


def test_cells_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(sizing, "TASK_ROWS", 100)
    rows, groups = _many_small_groups(), {}
    for f, s, v in rows:
        groups.setdefault((f, s), []).append(v)
    out = cell_median(spark.createDataFrame(rows, "f string, s string, v double"), ["f", "s"], "v", "m")
    assert out.rdd.getNumPartitions() >= 30  # more than spark.sql.shuffle.partitions, and not coalesced
    got = {(r["f"], r["s"]): r["m"] for r in out.collect()}
    assert got == {k: None if None in v else pytest.approx(float(np.median(v))) for k, v in groups.items()}


def test_rows_of_keys_with_values_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(sizing, "TASK_ROWS", 100)
    rows = _many_small_groups()
    seen = {(f, s) for f, s, v in rows if v is not None and f is not None}
    out = clean.drop_all_missing_long(spark.createDataFrame(rows, "f string, s string, v double"), ["f", "s"], "v")
    assert out.rdd.getNumPartitions() >= 30
    assert sorted(map(tuple, out.collect()), key=str) == sorted([r for r in rows if r[:2] in seen], key=str)
