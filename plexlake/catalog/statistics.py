"""Projection, linear model, contrasts and result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexlake.catalog import bindings as b
from plexlake.catalog.registry import ANNOTATED, DENSE, query, r6, with_ctes
from plexlake.operators import annotate, arrays, clean, meta, model, project, results
from plexlake.plans.session import materialise

PAIRS = model.pairwise_contrasts(b.GROUPS)

# --- SQL for the checks: gamma derivatives, t tails and the model ------------------------


def _digamma_sql(x: str) -> str:
    y = f"({x} + 10)"
    steps = " - ".join(f"1 / ({x} + {i})" for i in range(10))
    return (f"(ln{y} - 1 / (2 * {y}) - 1 / (12 * {y} ** 2) + 1 / (120 * {y} ** 4) - 1 / (252 * {y} ** 6) + 1 / (240 * {y} ** 8) - {steps})")


def _trigamma_sql(x: str) -> str:
    y = f"({x} + 10)"
    steps = " + ".join(f"1 / ({x} + {i}) ** 2" for i in range(10))
    return f"(1 / {y} + 1 / (2 * {y} ** 2) + 1 / (6 * {y} ** 3) - 1 / (30 * {y} ** 5) + 1 / (42 * {y} ** 7) - 1 / (30 * {y} ** 9) + {steps})"


def _t_tail_sql(t: str, v: str) -> str:
    """P(|T| > |t|) by Simpson's rule on cos^(v-1), cut where nothing is left to add."""
    start = f"atan(abs({t}) / sqrt({v}))"
    step = f"(least(pi() / 2 - {start}, 12 / sqrt({v})) / 2000)"
    weight = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    terms = f"list_sum(list_transform(range(0, 2001), lambda i: ({weight}) * pow(greatest(cos({start} + i * {step}), 0), {v} - 1)))"
    return f"(2 * exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt(pi()) * {step} / 3 * {terms})"


_FIT = f"""{ANNOTATED},
gm AS (SELECT protein_group, grp, count(*) AS n, avg(intens) AS mean, var_pop(intens) * count(*) AS ss FROM model_rows GROUP BY 1, 2),
fit AS (SELECT protein_group, CAST(sum(n) AS BIGINT) AS n_obs, CAST(sum(n) - count(*) AS DOUBLE) AS df,
  sum(ss) / (sum(n) - count(*)) AS sigma2, sum(n * mean) / sum(n) AS ave_expr FROM gm GROUP BY 1)"""


def _contrast_rows(contrasts: model.Contrasts) -> str:
    rows = ", ".join(f"('{c}', '{g}', CAST({w!r} AS DOUBLE))" for c, ws in contrasts.items() for g, w in ws.items())
    return f"contrasts AS (SELECT * FROM (VALUES {rows}) AS x(contrast, grp, weight))"


def _coefs(contrasts: model.Contrasts) -> str:
    return f"""{_FIT},
{_contrast_rows(contrasts)},
coefs AS (SELECT protein_group, contrast, sum(weight * mean) AS log_fc, sum(weight * weight / n) AS unscaled
  FROM gm JOIN contrasts USING (grp) GROUP BY 1, 2)"""


_PRIOR = f"""logs AS (SELECT df, ln(greatest(sigma2, 1e-5 * (SELECT median(sigma2) FROM fit))) - {_digamma_sql('(df / 2)')} + ln(df / 2) AS e,
    {_trigamma_sql('(df / 2)')} AS tri FROM fit),
moments AS (SELECT avg(e) AS mean, var_samp(e) - avg(tri) AS excess, sum(df) AS pooled, count(*) AS n FROM logs),
halving AS (
  SELECT 0 AS step, -20e0 AS lo, 20e0 AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN {_trigamma_sql('exp((lo + hi) / 2)')} > (SELECT excess FROM moments) THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {_trigamma_sql('exp((lo + hi) / 2)')} > (SELECT excess FROM moments) THEN hi ELSE (lo + hi) / 2 END
  FROM halving WHERE step < 80),
prior AS (SELECT CASE WHEN excess > 0 THEN 2 * exp(lo) END AS d0,
    CASE WHEN excess > 0 THEN exp(mean + {_digamma_sql('exp(lo)')} - lo) ELSE exp(mean) END AS s02, pooled, n
  FROM moments, halving WHERE step = 80),
post AS (SELECT protein_group, ave_expr, CASE WHEN d0 IS NULL THEN s02 ELSE (d0 * s02 + df * sigma2) / (d0 + df) END AS s2,
    CASE WHEN d0 IS NULL THEN pooled ELSE least(df + d0, pooled) END AS df_total FROM fit, prior)"""
_MODERATED = f"""{_PRIOR},
tested AS (SELECT protein_group, contrast, log_fc, unscaled, ave_expr, df_total, log_fc / sqrt(unscaled * s2) AS t FROM coefs JOIN post USING (protein_group)),
pvals AS (SELECT *, {_t_tail_sql('t', 'df_total')} AS p_value FROM tested)"""


def _bh_sql(source: str, by: str) -> str:
    return f"""ranked AS (SELECT *, p_value * count(*) OVER ({by}) / row_number() OVER ({by} ORDER BY p_value) AS raw FROM {source}),
adjusted AS (SELECT *, least(1, min(raw) OVER ({by} ORDER BY p_value ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS adj_p_value FROM ranked)"""


_F = f"""{_PRIOR},
ftab AS (SELECT protein_group, ave_expr, any_value(df_total) AS df_total,
    (sum(n * mean * mean) - sum(n * mean) ** 2 / sum(n)) / 2 / any_value(s2) AS f
  FROM gm JOIN post USING (protein_group) GROUP BY 1, 2),
fp AS (SELECT *, pow(1 + 2 * f / df_total, -df_total / 2) AS p_value FROM ftab)"""


# --- projection -------------------------------------------------------------------------

_Z = f"""{DENSE},
mom AS (SELECT protein_group, avg(intens) AS m, stddev_samp(intens) AS sd FROM dense GROUP BY 1 HAVING count(intens) = 42 AND stddev_samp(intens) > 0),
zs AS (SELECT d.protein_group, sample_name, (intens - m) / sd AS z, intens FROM dense d JOIN mom USING (protein_group))"""


def _names(spark, sf_dir):
    return meta.sample_names(b.metadata(spark, sf_dir))


def _cells(spark, sf_dir):
    """The dense table already has one row per feature and sample."""
    return b.dense(spark, sf_dir)


@query(with_ctes(_Z) + "SELECT protein_group, sample_name, round(z, 6) AS z FROM zs")
def standardised_features(spark, sf_dir):
    out = project.standardise(_cells(spark, sf_dir), "intens", b.extent(spark, sf_dir).samples)
    return out.select("protein_group", "sample_name", r6("z"))


@query(with_ctes(_Z) + """SELECT a.sample_name AS sample_a, b.sample_name AS sample_b, round(sum(a.z * b.z), 4) AS g
FROM zs a JOIN zs b USING (protein_group) GROUP BY 1, 2""")
def gram_matrix(spark, sf_dir):
    names = _names(spark, sf_dir)
    label = F.array(*[F.lit(n) for n in names])
    g = project.gram(_cells(spark, sf_dir), names, "intens")
    return g.select(F.get(label, F.col("i")).alias("sample_a"), F.get(label, F.col("j")).alias("sample_b"), F.round("g", 4).alias("g"))


@query()
def pca_scores(spark, sf_dir):
    scores, _ = project.pca(_cells(spark, sf_dir), _names(spark, sf_dir), "intens")
    return scores.select("sample_name", "component", r6("score"))


@query(with_ctes(_Z) + """SELECT a.sample_name AS sample_a, b.sample_name AS sample_b, round(sum(a.z * b.z), 4) AS g
FROM zs a JOIN zs b USING (protein_group) GROUP BY 1, 2""")
def pca_scores_give_back_the_gram_matrix(spark, sf_dir):
    """Over all components, products of scores add up to the products of the standardised samples."""
    scores, _ = project.pca(_cells(spark, sf_dir), _names(spark, sf_dir), "intens")
    a = scores.select(F.col("sample_name").alias("sample_a"), "component", F.col("score").alias("x"))
    other = scores.select(F.col("sample_name").alias("sample_b"), "component", F.col("score").alias("y"))
    return a.join(other, "component").groupBy("sample_a", "sample_b").agg(F.round(F.sum(F.col("x") * F.col("y")), 4).alias("g"))


@query(with_ctes(_Z) + "SELECT protein_group, sample_name, round(z, 4) AS z FROM zs")
def pca_loadings_give_back_the_values(spark, sf_dir):
    """Over all components, score times loading adds up to the standardised value."""
    names = _names(spark, sf_dir)
    rows = _cells(spark, sf_dir)
    scores, components = project.pca(rows, names, "intens")
    loadings = project.pca_loadings(project.standardise(rows, "intens", len(names)), scores, components, len(names))
    product = scores.join(loadings, "component").groupBy("protein_group", "sample_name")
    return product.agg(F.round(F.sum(F.col("score") * F.col("loading")), 4).alias("z"))


@query()
def pca_components(spark, sf_dir):
    _, components = project.pca(_cells(spark, sf_dir), _names(spark, sf_dir), "intens")
    return components.withColumn("eigenvalue", r6("eigenvalue"))


@query(with_ctes(_Z) + """, g AS (SELECT sum(a.z * b.z) / 41 AS c FROM zs a JOIN zs b USING (protein_group) GROUP BY a.sample_name, b.sample_name)
SELECT (SELECT CAST(count(*) AS DOUBLE) FROM mom) AS total_variance, (SELECT round(sum(c * c), 4) FROM g) AS sum_of_squares""")
def pca_variance_identities(spark, sf_dir):
    """Eigenvalues add up to the number of features, their squares to the squared matrix norm."""
    _, components = project.pca(_cells(spark, sf_dir), _names(spark, sf_dir), "intens")
    e = F.col("eigenvalue")
    return components.agg(F.round(F.sum(e), 4).alias("total_variance"), F.round(F.sum(e * e), 4).alias("sum_of_squares"))


@query(with_ctes(_Z) + """, one AS (SELECT sample_name, intens, protein_group FROM dense JOIN mom USING (protein_group))
SELECT a.sample_name AS sample_a, b.sample_name AS sample_b, round(sqrt(sum((a.intens - b.intens) ** 2)), 4) AS distance
FROM one a JOIN one b USING (protein_group) GROUP BY 1, 2""")
def sample_distances(spark, sf_dir):
    names = _names(spark, sf_dir)
    out = project.sample_distances(project.gram(_cells(spark, sf_dir), names, "intens", scale=False), names)
    return out.withColumn("distance", F.round("distance", 4))


@query(with_ctes(DENSE) + """, d AS (SELECT a.sample_name AS sample_a, b.sample_name AS sample_b, sqrt(sum((a.intens - b.intens) ** 2)) AS distance
  FROM dense a JOIN dense b USING (protein_group) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY sample_a ORDER BY distance) AS neighbour FROM d)
SELECT sample_a, sample_b, neighbour FROM r WHERE neighbour <= 3""")
def nearest_neighbours(spark, sf_dir):
    names = _names(spark, sf_dir)
    rows = materialise(project.gram_rows(arrays.from_cells(_cells(spark, sf_dir), names, "intens"), len(names), ["raw"]), "gram")
    return project.nearest_neighbours(rows, names, 3).select("sample_a", "sample_b", "neighbour")


# --- model ------------------------------------------------------------------------------


@query(with_ctes(_FIT) + "SELECT protein_group, grp AS exp_group, n, round(mean, 6) AS mean, round(ss, 6) AS ss FROM gm")
def group_means(spark, sf_dir):
    out = model.group_means(b.model_rows(spark, sf_dir), "intens")
    return out.select("protein_group", "exp_group", "n", r6("mean"), r6("ss"))


@query(with_ctes(_FIT) + """SELECT protein_group, n_obs, CAST(df AS BIGINT) AS df, round(sigma2, 6) AS sigma2, round(ave_expr, 6) AS ave_expr FROM fit""")
def group_model_fit(spark, sf_dir):
    out = model.fit_groups(b.model_rows(spark, sf_dir), "intens")
    return out.select("protein_group", "n_obs", "df", r6("sigma2"), r6("ave_expr"))


@query(with_ctes(ANNOTATED) + """, g AS (SELECT DISTINCT grp FROM model_rows)
SELECT a.grp || '_vs_' || b.grp AS contrast, x.grp AS exp_group, CASE WHEN x.grp = a.grp THEN 1e0 ELSE -1e0 END AS weight
FROM g a JOIN g b ON a.grp < b.grp JOIN g x ON x.grp IN (a.grp, b.grp)""")
def pairwise_contrasts(spark, sf_dir):
    groups = model.group_names(b.metadata(spark, sf_dir).where("group_number <> 'POOL'"))
    return model.pairwise_table(spark, groups)


@query(with_ctes(ANNOTATED) + """, g AS (SELECT DISTINCT grp FROM model_rows)
SELECT CASE WHEN a.grp = 'Group_A' AND b.grp = 'Group_R' THEN 'Group_R_vs_Group_A' ELSE a.grp || '_vs_' || b.grp END AS contrast, x.grp AS exp_group,
  CASE WHEN x.grp = a.grp THEN 1e0 ELSE -1e0 END * CASE WHEN a.grp = 'Group_A' AND b.grp = 'Group_R' THEN -1 ELSE 1 END AS weight
FROM g a JOIN g b ON a.grp < b.grp JOIN g x ON x.grp IN (a.grp, b.grp)""")
def reversed_contrasts(spark, sf_dir):
    groups = model.group_names(b.metadata(spark, sf_dir).where("group_number <> 'POOL'"))
    return model.reverse_table(model.pairwise_table(spark, groups), ["Group_A_vs_Group_R"])


EXPLICIT = {**model.versus_rest("Group_A", b.GROUPS), "N minus R": {"Group_N": 1.0, "Group_R": -1.0}}


@query(with_ctes(_coefs(EXPLICIT)) + """SELECT protein_group, contrast, round(log_fc, 6) AS log_fc, round(unscaled, 6) AS unscaled FROM coefs""")
def explicit_contrasts(spark, sf_dir):
    model.check_contrasts(EXPLICIT, b.GROUPS)
    out = model.apply_contrasts(model.fit_groups(b.model_rows(spark, sf_dir), "intens"), EXPLICIT)
    return out.select("protein_group", "contrast", r6("log_fc"), r6("unscaled"))


@query(with_ctes(_coefs(PAIRS)) + f"""SELECT protein_group, contrast, round(log_fc / sqrt(unscaled * sigma2), 6) AS t,
  round({_t_tail_sql('(log_fc / sqrt(unscaled * sigma2))', 'df')}, 6) AS p_value FROM coefs JOIN fit USING (protein_group)""")
def ordinary_t(spark, sf_dir):
    coefficients = model.apply_contrasts(model.fit_groups(b.model_rows(spark, sf_dir), "intens"), PAIRS)
    return model.ordinary_t(coefficients).select("protein_group", "contrast", r6("t"), r6("p_value"))


def _fit(spark, sf_dir):
    return materialise(model.fit_groups(b.model_rows(spark, sf_dir), "intens"), "fit")


@query(with_ctes(_FIT, _PRIOR) + """SELECT coalesce(round(d0, 4), -1e0) AS d0, round(s02, 6) AS s02, pooled AS df_pooled, n AS n_features FROM prior""")
def variance_prior(spark, sf_dir):
    """Degrees of freedom of the prior (-1 for infinity), its variance, and what it rests on."""
    p = model.variance_prior(_fit(spark, sf_dir))
    d0 = -1.0 if p.df0 == float("inf") else round(p.df0, 4)
    return spark.createDataFrame([(d0, round(p.s02, 6), p.df_pooled, p.n_features)], "d0 double, s02 double, df_pooled double, n_features long")


@query(with_ctes(_coefs(PAIRS), _MODERATED) + """SELECT protein_group, contrast, round(log_fc, 6) AS log_fc, round(t, 6) AS t,
  round(df_total, 4) AS df_total, round(p_value, 6) AS p_value FROM pvals""")
def moderated_t(spark, sf_dir):
    fit = _fit(spark, sf_dir)
    rows = model.moderated_t(model.moderate(model.apply_contrasts(fit, PAIRS), model.variance_prior(fit)))
    return rows.select("protein_group", "contrast", r6("log_fc"), r6("t"), F.round("df_total", 4).alias("df_total"), r6("p_value"))


_LOG_ODDS = f"""{_MODERATED},
sized AS (SELECT *, row_number() OVER (PARTITION BY contrast ORDER BY p_value) AS r, count(*) OVER (PARTITION BY contrast) AS m,
  max(df_total) OVER () AS v FROM pvals),
best AS (SELECT *, greatest(ceil(0.005 * m) / m, 0.01) AS share FROM sized WHERE r <= ceil(0.005 * m)),
aimed AS (SELECT *, ((r - 0.5) / m - (1 - share) * p_value) / share AS aim FROM best),
quant AS (
  SELECT 0 AS step, contrast, protein_group, t, unscaled, p_value, aim, v, -10e0 AS lo, 10e0 AS hi FROM aimed
  UNION ALL
  SELECT step + 1, contrast, protein_group, t, unscaled, p_value, aim, v,
    CASE WHEN {_t_tail_sql('exp((lo + hi) / 2)', 'v')} > aim THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN {_t_tail_sql('exp((lo + hi) / 2)', 'v')} > aim THEN hi ELSE (lo + hi) / 2 END
  FROM quant WHERE step < 60),
v0s AS (SELECT contrast, avg(least(greatest(CASE WHEN aim > p_value THEN unscaled * ((t / exp(lo)) ** 2 - 1) ELSE 0 END,
    0.01 / s02), 16 / s02)) AS v0 FROM quant, prior WHERE step = 60 GROUP BY 1)"""


@query(with_ctes(_coefs(PAIRS), _LOG_ODDS) + """SELECT protein_group, contrast, round(ln(0.01 / 0.99) - ln((unscaled + v0) / unscaled) / 2
  + CASE WHEN d0 IS NULL OR d0 > 1e6 THEN t * t * (1 - unscaled / (unscaled + v0)) / 2
    ELSE (1 + df_total) / 2 * ln((t * t + df_total) / (t * t * unscaled / (unscaled + v0) + df_total)) END, 5) AS b
FROM pvals JOIN v0s USING (contrast), prior""")
def log_odds(spark, sf_dir):
    fit = _fit(spark, sf_dir)
    prior = model.variance_prior(fit)
    rows = model.moderated_t(model.moderate(model.apply_contrasts(fit, PAIRS), prior))
    return model.log_odds(rows, prior, len(PAIRS)).select("protein_group", "contrast", F.round("b", 5).alias("b"))


@query(with_ctes(_coefs(PAIRS), _MODERATED, _bh_sql("pvals", "PARTITION BY contrast")) + """
SELECT protein_group, contrast, round(log_fc, 6) AS log_fc, round(adjusted.ave_expr, 6) AS ave_expr, round(t, 6) AS t, round(p_value, 6) AS p_value,
  round(adj_p_value, 6) AS adj_p_value, s_name AS protein_names, s_nationkey AS gene_names
FROM adjusted JOIN supplier ON CAST(s_suppkey AS VARCHAR) = protein_group""")
def contrast_results(spark, sf_dir):
    table = results.contrast_results(_fit(spark, sf_dir), PAIRS, b.supplier_annotation(spark, sf_dir))
    numbers = [r6(c) for c in ("log_fc", "ave_expr", "t", "p_value", "adj_p_value")]
    return table.select("protein_group", "protein_names", "gene_names", "contrast", *numbers)


_OVERALL = with_ctes(_coefs(PAIRS), _F, _bh_sql("fp", "")) + """, wide AS (SELECT protein_group,
  max(log_fc) FILTER (contrast = 'Group_A_vs_Group_N') AS an, max(log_fc) FILTER (contrast = 'Group_A_vs_Group_R') AS ar,
  max(log_fc) FILTER (contrast = 'Group_N_vs_Group_R') AS nr FROM coefs GROUP BY 1)"""


def _overall(spark, sf_dir):
    sizes = model.group_sizes(b.metadata(spark, sf_dir).where("group_number <> 'POOL'"))
    return results.overall_results(_fit(spark, sf_dir), PAIRS, sizes)


@query(_OVERALL + """SELECT protein_group, round(ave_expr, 6) AS ave_expr, round(f, 6) AS f, round(p_value, 6) AS p_value,
  round(adj_p_value, 6) AS adj_p_value, round(an, 6) AS Group_A_vs_Group_N, round(ar, 6) AS Group_A_vs_Group_R, round(nr, 6) AS Group_N_vs_Group_R
FROM adjusted JOIN wide USING (protein_group)""")
def overall_f_table(spark, sf_dir):
    out = _overall(spark, sf_dir)
    return out.select("protein_group", *[r6(c) for c in ("ave_expr", "f", "p_value", "adj_p_value", *PAIRS)])


@query(_OVERALL + "SELECT protein_group, round(p_value, 6) AS p_value FROM adjusted ORDER BY adjusted.p_value LIMIT 10")
def top_features(spark, sf_dir):
    return results.ranked(_overall(spark, sf_dir), top=10).select("protein_group", r6("p_value"))


@query(_OVERALL + "SELECT protein_group, round(p_value, 6) AS p_value FROM adjusted WHERE adjusted.p_value < 0.2")
def significant_features(spark, sf_dir):
    return clean.significant(_overall(spark, sf_dir), below=0.2).select("protein_group", r6("p_value"))


@query(_OVERALL + """SELECT protein_group, sample_name, round(p_value, 6) AS p_value, round(intens, 6) AS intens
FROM adjusted JOIN dense USING (protein_group) WHERE adjusted.p_value < 0.2""")
def significant_sample_values(spark, sf_dir):
    hits = clean.significant(_overall(spark, sf_dir), below=0.2).select("protein_group", r6("p_value"))
    return annotate.results_with_values(hits, b.dense(spark, sf_dir), "intens").withColumn("intens", r6("intens"))


@query(_OVERALL + """, hits AS (SELECT m.* FROM model_rows m JOIN adjusted USING (protein_group) WHERE p_value < 0.2)
SELECT protein_group, exp_group || '.' || replace(sample_number, 'sample_', '') AS label,
  round((intens - avg(intens) OVER (PARTITION BY protein_group)) / stddev_samp(intens) OVER (PARTITION BY protein_group), 6) AS z FROM hits""")
def heat_map(spark, sf_dir):
    rows = b.model_rows(spark, sf_dir).select("protein_group", "sample_name", "intens")
    size = b.extent(spark, sf_dir).samples
    out = results.heat_map(_overall(spark, sf_dir), rows, b.metadata(spark, sf_dir), "intens", 0.2, n_samples=size)
    return out.select("protein_group", "label", r6("z"))


def _price_fraction(spark, sf_dir):
    price = F.col("l_extendedprice")
    return b.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("contrast"), "l_orderkey", "l_linenumber", "l_partkey", (F.round((price - F.floor(price)) * 100) / 100).alias("p_value"))


_BH_LINES = """WITH pv AS (SELECT l_returnflag AS contrast, l_orderkey, l_linenumber, l_partkey,
  round((l_extendedprice - floor(l_extendedprice)) * 100) / 100 AS p_value FROM lineitem),
steps AS (SELECT contrast, p_value, count(*) AS c FROM pv GROUP BY 1, 2),
raws AS (SELECT contrast, p_value, p_value * sum(c) OVER (PARTITION BY contrast) / sum(c) OVER (PARTITION BY contrast ORDER BY p_value) AS raw FROM steps),
adj AS (SELECT contrast, p_value, least(1, min(raw) OVER (PARTITION BY contrast ORDER BY p_value
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS a FROM raws)
SELECT contrast, l_orderkey, l_linenumber, l_partkey, p_value, round(a, 6) AS adj_p_value FROM pv JOIN adj USING (contrast, p_value)"""


@query(_BH_LINES)
def adjusted_p_values(spark, sf_dir):
    return results.adjust_bh(_price_fraction(spark, sf_dir), by=["contrast"]).withColumn("adj_p_value", r6("adj_p_value"))


@query(_BH_LINES)
def adjusted_p_values_in_bins(spark, sf_dir):
    """The path for groups too large for one window, heavy ties included."""
    out = results.adjust_bh(_price_fraction(spark, sf_dir), by=["contrast"], small_rows=0)
    return out.withColumn("adj_p_value", r6("adj_p_value"))
