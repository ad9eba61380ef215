"""The steps on one row per feature, against the SQL of the long tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexlake.catalog import bindings as b
from plexlake.catalog.quality import _COMBAT, _POOL
from plexlake.catalog.registry import DENSE, NORMALISED, SAMPLES, SPARSE, query, r6, with_ctes
from plexlake.catalog.statistics import _FIT, _LOG_ODDS, _OVERALL, PAIRS, _bh_sql, _coefs, _overall
from plexlake.functions.scalars import syntactic_name
from plexlake.operators import arrays, meta, model, qc, reshape, results
from plexlake.plans.session import materialise

NAMES = [f"plex{p}_tmt_{r}{n}" for p in (1, 2) for r in "anr" for n in range(1, 8)]  # the samples of the bindings


def _wide(spark, sf_dir, source=b.dense):
    """One row per feature and a column per sample, as an export file has it."""
    return materialise(reshape.expression_matrix(source(spark, sf_dir), NAMES, "intens"), "wide")


def _raw(spark, sf_dir, source=b.dense):
    table, hot = arrays.gather(_wide(spark, sf_dir, source), NAMES)
    if hot is not None:
        raise ValueError("features repeat")
    return table


def _normalised(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    long = arrays.to_long(raw, NAMES, {"raw": "intens"})
    size = b.extent(spark, sf_dir)
    medians = {r["sample_name"]: r["MED"] for r in qc.sample_medians(long, "intens", size).collect()}
    total = qc.global_median(long, "intens", size).first()["median_all"]
    return arrays.normalise(raw, len(NAMES), range(len(NAMES)), [total - medians[s] for s in NAMES], 1.0)


def _long(table, column, name):
    return arrays.to_long(table, NAMES, {column: name}).select("protein_group", "sample_name", r6(name))


@query(with_ctes(DENSE) + "SELECT protein_group, sample_name, round(intens, 6) AS intens FROM dense")
def feature_arrays_gathered(spark, sf_dir):
    """Rows of single samples, many a feature, meet in one exchange; cells of the array are what was there."""
    cells = arrays.from_cells(b.dense(spark, sf_dir), NAMES, "intens")
    return arrays.cells_to_long(cells, NAMES, "intens").select("protein_group", "sample_name", r6("intens"))


@query(with_ctes(NORMALISED) + "SELECT protein_group, sample_name, round(normalized_intensity, 6) AS normalized_intensity FROM normalised")
def feature_arrays_normalised(spark, sf_dir):
    return _long(_normalised(spark, sf_dir), "v", "normalized_intensity")


@query(with_ctes(SPARSE, SAMPLES) + """, kept AS (
  SELECT protein_group FROM sparse GROUP BY 1 HAVING 1 - count(intens) / (SELECT CAST(count(*) AS DOUBLE) FROM sample_list) <= 0.5)
SELECT k.protein_group, s.sample_name, round(intens, 6) AS intens FROM kept k CROSS JOIN sample_list s
LEFT JOIN sparse x ON x.protein_group = k.protein_group AND x.sample_name = s.sample_name""")
def feature_arrays_missing_share(spark, sf_dir):
    raw = _raw(spark, sf_dir, b.sparse)
    return _long(arrays.normalise(raw, len(NAMES), range(len(NAMES)), [0.0] * len(NAMES), 0.5), "v", "intens")


@query(with_ctes(_POOL) + "SELECT protein_group, sample_name, round(unbatched_intensity, 6) AS unbatched_intensity FROM unbatched")
def feature_arrays_pool_reference(spark, sf_dir):
    pools = [name.endswith("7") for name in NAMES]
    out = arrays.pool_reference(_normalised(spark, sf_dir), [name.split("_")[0] for name in NAMES], pools)
    return _long(out, "u", "unbatched_intensity")


@query(with_ctes(_COMBAT) + """SELECT x.protein_group, x.sample_name,
  round(((normalized_intensity - grand) / sqrt(pooled) - g) / sqrt(d) * sqrt(pooled) + grand, 6) AS unbatched_intensity
FROM normalised x JOIN solved s ON s.protein_group = x.protein_group AND s.batch = x.plex WHERE step = 100""")
def feature_arrays_combat(spark, sf_dir):
    table = materialise(_normalised(spark, sf_dir), "normalised")
    out, _ = arrays.combat(table, [name.split("_")[0] for name in NAMES])
    return _long(out, "u", "unbatched_intensity")


def _cells(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return arrays.cells(raw, len(NAMES), "raw")


@query(with_ctes(_FIT) + """SELECT protein_group, n_obs, CAST(df AS BIGINT) AS df, round(sigma2, 6) AS sigma2, round(ave_expr, 6) AS ave_expr FROM fit""")
def feature_arrays_fit(spark, sf_dir):
    rows = b.metadata(spark, sf_dir).where("group_number <> 'POOL'").select("sample_name", syntactic_name(F.col("exp_group")).alias("g")).collect()
    group = {r["sample_name"]: r["g"] for r in rows}
    fit = arrays.fit_groups(_cells(spark, sf_dir), [group.get(s) for s in NAMES])
    return fit.select("protein_group", "n_obs", "df", r6("sigma2"), r6("ave_expr"))


@query(_OVERALL + """, hits AS (SELECT d.protein_group, d.sample_name, intens FROM dense d JOIN adjusted USING (protein_group) WHERE p_value < 0.2),
zs AS (SELECT *, (intens - avg(intens) OVER (PARTITION BY protein_group)) / stddev_samp(intens) OVER (PARTITION BY protein_group) AS z FROM hits)
SELECT protein_group, exp_group || '.' || replace(sample_number, 'sample_', '') AS label, round(z, 6) AS z
FROM zs JOIN meta USING (sample_name) WHERE group_number <> 'POOL'""")
def feature_arrays_heat_map(spark, sf_dir):
    """Scored over all samples of the table, shown for those that are no pools."""
    labels = meta.readable_names(b.metadata(spark, sf_dir).where("group_number <> 'POOL'"), sep=".")
    out = results.heat_map_of_cells(_overall(spark, sf_dir), _cells(spark, sf_dir), NAMES, labels, 0.2)
    return out.select("protein_group", "label", r6("z"))


_VALUES = ", ".join(f"max(intens) FILTER (sample_name = '{s}') AS {s}" for s in NAMES)


@query(with_ctes(_coefs(PAIRS), _LOG_ODDS, _bh_sql("pvals", "PARTITION BY contrast")) + f""", vals AS (
  SELECT protein_group, {_VALUES} FROM dense GROUP BY 1),
odds AS (SELECT protein_group, contrast, ln(0.01 / 0.99) - ln((unscaled + v0) / unscaled) / 2
  + CASE WHEN d0 IS NULL OR d0 > 1e6 THEN t * t * (1 - unscaled / (unscaled + v0)) / 2
    ELSE (1 + df_total) / 2 * ln((t * t + df_total) / (t * t * unscaled / (unscaled + v0) + df_total)) END AS b
  FROM pvals JOIN v0s USING (contrast), prior)
SELECT protein_group, contrast, round(log_fc, 6) AS log_fc, round(adjusted.ave_expr, 6) AS ave_expr, round(t, 6) AS t, round(p_value, 6) AS p_value,
  round(adj_p_value, 6) AS adj_p_value, round(b, 5) AS b, {", ".join(f"round({s}, 6) AS {s}" for s in NAMES)}
FROM adjusted JOIN odds USING (protein_group, contrast) JOIN vals USING (protein_group)""")
def contrast_results_with_values(spark, sf_dir):
    """Per contrast: effects, tests, log odds, and the values of all samples."""
    fit = materialise(model.fit_groups(b.model_rows(spark, sf_dir), "intens"), "fit")
    table = results.contrast_results(fit, PAIRS).join(arrays.matrix(_cells(spark, sf_dir), NAMES), "protein_group")
    numbers = [r6(c) for c in ("log_fc", "ave_expr", "t", "p_value", "adj_p_value")]
    return table.select("protein_group", "contrast", *numbers, F.round("b", 5).alias("b"), *[r6(s) for s in NAMES])
