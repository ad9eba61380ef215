"""Quality metrics, normalisation and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from plexlake.catalog import bindings as b
from plexlake.catalog.registry import DENSE, MEDIANS, NORMALISED, SAMPLES, SPARSE, query, r6, with_ctes
from plexlake.functions.quantiles import quantiles_by_counts
from plexlake.operators import batch, meta, normalize, qc, reshape
from plexlake.plans.session import materialise


@query(with_ctes(DENSE) + "SELECT round(median(intens), 6) AS median_all FROM dense")
def global_median(spark, sf_dir):
    return qc.global_median(b.dense(spark, sf_dir), "intens", b.extent(spark, sf_dir)).select(r6("median_all"))


@query("SELECT round(median(l_extendedprice), 6) AS median_all, count(*) AS n FROM lineitem")
def global_median_by_counts(spark, sf_dir):
    """The path for groups of any size, on every line."""
    out = quantiles_by_counts(b.table(spark, sf_dir, "lineitem"), [], "l_extendedprice", [0.5])
    return out.select(r6(F.col("q")[0], "median_all"), "n")


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(median(l_extendedprice), 6) AS q2,
  round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem GROUP BY 1""")
def group_quartiles_by_counts(spark, sf_dir):
    out = quantiles_by_counts(b.table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.75], 3)
    return out.select("l_returnflag", *[r6(F.col("q")[i], f"q{i + 1}") for i in range(3)])


@query(with_ctes(DENSE, SAMPLES) + """SELECT round(median(intens), 6) AS median_all FROM dense
JOIN meta USING (sample_name) WHERE group_number <> 'POOL'""")
def global_median_of_mapped_samples(spark, sf_dir):
    from plexlake.operators.clean import keep_common_samples

    size = b.extent(spark, sf_dir)
    mapped = b.metadata(spark, sf_dir).where("group_number <> 'POOL'")
    kept = keep_common_samples(b.dense(spark, sf_dir), mapped, size.samples)
    return qc.global_median(kept, "intens", size).select(r6("median_all"))


@query(with_ctes(SPARSE, DENSE) + """SELECT 'with gaps' AS source, CASE WHEN count(intens) = count(*) THEN round(median(intens), 6) END AS median_all FROM sparse
UNION ALL SELECT 'complete', CASE WHEN count(intens) = count(*) THEN round(median(intens), 6) END FROM dense""")
def global_median_null_propagating(spark, sf_dir):
    size = b.extent(spark, sf_dir)
    gaps, complete = (qc.global_median(long, "intens", size, null_propagating=True).select(r6("median_all"))
                      for long in (b.sparse(spark, sf_dir), b.dense(spark, sf_dir)))
    return gaps.select(F.lit("with gaps").alias("source"), "median_all").unionByName(
        complete.select(F.lit("complete").alias("source"), "median_all"))


@query(with_ctes(SPARSE) + "SELECT sample_name, round(median(intens), 6) AS MED FROM sparse GROUP BY 1")
def sample_medians(spark, sf_dir):
    return qc.sample_medians(b.sparse(spark, sf_dir), "intens", b.extent(spark, sf_dir)).select("sample_name", r6("MED"))


@query(with_ctes(DENSE, MEDIANS) + """SELECT sample_name, round(MED, 6) AS MED,
  CASE WHEN abs(MED - (SELECT avg(MED) FROM medians)) >= 0.02 THEN 'YES' ELSE 'NO' END AS high FROM medians""")
def high_median_flags(spark, sf_dir):
    medians = qc.sample_medians(b.dense(spark, sf_dir), "intens", b.extent(spark, sf_dir))
    return qc.flag_high_medians(medians, 0.02).withColumn("MED", r6("MED"))


@query(with_ctes(SPARSE) + """SELECT protein_group, sample_name, round(intens, 6) AS intens,
  CASE WHEN intens IS NULL THEN NULL WHEN intens = max(intens) OVER (PARTITION BY sample_name) THEN 'YES' ELSE 'NO' END AS is_max
FROM (SELECT protein_group, sample_name, round(intens, 6) AS intens FROM sparse)""")
def sample_maximum_flags(spark, sf_dir):
    """Rounded first: equal sums added in another order then tie on both sides."""
    long = b.sparse(spark, sf_dir).withColumn("intens", r6("intens"))
    return qc.flag_maximum(long, "intens", b.extent(spark, sf_dir)).select("protein_group", "sample_name", "intens", "is_max")


@query(with_ctes(SPARSE) + """SELECT sample_name,
  round(100.0 * count(intens) / (SELECT count(DISTINCT protein_group) FROM sparse), 6) AS completeness FROM sparse GROUP BY 1""")
def completeness_per_sample(spark, sf_dir):
    long = b.sparse(spark, sf_dir)
    features = b.table(spark, sf_dir, "lineitem").agg(F.count_distinct("l_partkey").alias("n")).scalar()
    sparse = qc.completeness(long, "intens", features)
    return sparse.select("sample_name", r6("completeness"))


@query(with_ctes(SPARSE, SAMPLES) + """SELECT s.sample_name, round(100.0 * count(intens) / count(*), 6) AS completeness
FROM (SELECT DISTINCT protein_group FROM sparse) f CROSS JOIN sample_list s
LEFT JOIN sparse x ON x.protein_group = f.protein_group AND x.sample_name = s.sample_name GROUP BY 1""")
def completeness_of_dense_grid(spark, sf_dir):
    names = meta.sample_names(b.metadata(spark, sf_dir))
    grid = reshape.densify(b.sparse(spark, sf_dir), names, "intens")
    return qc.completeness(grid).select("sample_name", r6("completeness"))


@query(with_ctes(SPARSE, SAMPLES) + """SELECT sample_name, count(intens) AS n_detected, any_value(exp_group) AS exp_group
FROM sparse JOIN meta USING (sample_name) GROUP BY 1""")
def detected_features(spark, sf_dir):
    counts = qc.detected_features(b.sparse(spark, sf_dir))
    return counts.join(F.broadcast(b.metadata(spark, sf_dir).select("sample_name", "exp_group")), "sample_name")


@query(with_ctes(SPARSE) + "SELECT protein_group, count_if(intens IS NULL) AS n_missing FROM sparse GROUP BY 1")
def missing_per_feature(spark, sf_dir):
    return qc.missing_per_feature(b.sparse(spark, sf_dir))


@query(with_ctes(SPARSE) + """SELECT n_missing, count(*) AS n_features FROM (
  SELECT protein_group, count_if(intens IS NULL) AS n_missing FROM sparse GROUP BY 1) GROUP BY 1""")
def missing_histogram(spark, sf_dir):
    return qc.missing_histogram(qc.missing_per_feature(b.sparse(spark, sf_dir)))


_BOXES = """quartiles AS (SELECT sample_name, quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3
  FROM boxed GROUP BY 1)
SELECT sample_name, round(q1, 6) AS q1, round(any_value(median), 6) AS median, round(q3, 6) AS q3,
  round(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low, round(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count_if(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM boxed JOIN quartiles USING (sample_name) GROUP BY sample_name, q1, q3"""


def _rounded_boxes(boxes):
    return boxes.select("sample_name", *[r6(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "n_outliers")


@query(with_ctes(DENSE, "boxed AS (SELECT sample_name, intens AS v FROM dense)", _BOXES))
def box_statistics_raw(spark, sf_dir):
    return _rounded_boxes(qc.box_statistics(b.dense(spark, sf_dir), "intens", b.extent(spark, sf_dir)))


def _normalised(spark, sf_dir):
    return normalize.median_normalise(b.annotated(spark, sf_dir), extent=b.extent(spark, sf_dir))


@query(with_ctes(NORMALISED, "boxed AS (SELECT sample_name, normalized_intensity AS v FROM normalised)", _BOXES))
def box_statistics_normalised(spark, sf_dir):
    return _rounded_boxes(qc.box_statistics(_normalised(spark, sf_dir), "normalized_intensity", b.extent(spark, sf_dir)))


@query(with_ctes(SPARSE) + """SELECT round(avg(n), 6) AS mean_n_detected FROM (SELECT count(intens) AS n FROM sparse GROUP BY sample_name)""")
def mean_detected_line(spark, sf_dir):
    return qc.mean_line(qc.detected_features(b.sparse(spark, sf_dir)), "n_detected").select(r6("mean_n_detected"))


@query(with_ctes(SPARSE, SAMPLES) + """SELECT protein_group, count(intens) FILTER (exp_group = 'Group A') AS n_present, 0 AS n_absent
FROM sparse JOIN meta USING (sample_name) GROUP BY 1
HAVING count(intens) FILTER (exp_group = 'Group A') >= 3 AND count(intens) FILTER (exp_group = 'POOL') = 0""")
def presence_absence(spark, sf_dir):
    long = meta.attach_metadata(b.sparse(spark, sf_dir), b.metadata(spark, sf_dir), b.extent(spark, sf_dir).samples)
    return qc.presence_absence(long, "Group A", "POOL", 3)


# --- normalisation ----------------------------------------------------------------------


@query(with_ctes(NORMALISED) + """SELECT protein_group, sample_name, round(intens, 6) AS intens, round(MED, 6) AS MED,
  round(normalized_intensity, 6) AS normalized_intensity FROM normalised""")
def median_normalised(spark, sf_dir):
    return _normalised(spark, sf_dir).select("protein_group", "sample_name", *[r6(c) for c in ("intens", "MED", "normalized_intensity")])


_POOL = f"""{NORMALISED},
pools AS (SELECT protein_group, plex, avg(normalized_intensity) FILTER (group_number = 'POOL') AS pool FROM normalised GROUP BY 1, 2),
shifts AS (SELECT protein_group, plex, avg(pool) OVER (PARTITION BY protein_group) - pool AS shift FROM pools),
unbatched AS (SELECT n.*, normalized_intensity + shift AS unbatched_intensity FROM normalised n JOIN shifts USING (protein_group, plex))"""


@query(with_ctes(_POOL) + "SELECT protein_group, sample_name, round(unbatched_intensity, 6) AS unbatched_intensity FROM unbatched")
def pool_reference(spark, sf_dir):
    return batch.pool_reference(_normalised(spark, sf_dir)).select("protein_group", "sample_name", r6("unbatched_intensity"))


@query(with_ctes(NORMALISED) + "SELECT protein_group, sample_name, round(normalized_intensity, 6) AS unbatched_intensity FROM normalised")
def no_batch_removal(spark, sf_dir):
    return batch.no_batch(_normalised(spark, sf_dir)).select("protein_group", "sample_name", r6("unbatched_intensity"))


@query(with_ctes(_POOL, "second AS (SELECT sample_name, median(unbatched_intensity) AS m FROM unbatched GROUP BY 1)") + """
SELECT protein_group, sample_name, round(unbatched_intensity - m + (SELECT median(unbatched_intensity) FROM unbatched), 6) AS unbatched_intensity
FROM unbatched JOIN second USING (sample_name)""")
def renormalised_after_batch(spark, sf_dir):
    unbatched = materialise(batch.pool_reference(_normalised(spark, sf_dir)), "unbatched")
    out = normalize.renormalise(unbatched, extent=b.extent(spark, sf_dir))
    return out.select("protein_group", "sample_name", r6("unbatched_intensity"))


@query(with_ctes(SPARSE, SAMPLES) + """SELECT protein_group, sample_name,
  round(coalesce(intens, median(intens) OVER (PARTITION BY protein_group, exp_group)), 6) AS intens
FROM sparse JOIN meta USING (sample_name)""")
def imputed_by_group_median(spark, sf_dir):
    long = meta.attach_metadata(b.sparse(spark, sf_dir), b.metadata(spark, sf_dir), b.extent(spark, sf_dir).samples)
    return normalize.impute(long, "intens", "group_median").select("protein_group", "sample_name", r6("intens"))


@query(with_ctes(SPARSE, "floors AS (SELECT sample_name, quantile_cont(intens, 0.01) AS f FROM sparse GROUP BY 1)") + """
SELECT protein_group, sample_name, round(coalesce(intens, f), 6) AS intens FROM sparse JOIN floors USING (sample_name)""")
def imputed_by_sample_floor(spark, sf_dir):
    out = normalize.impute(b.sparse(spark, sf_dir), "intens", "sample_floor", extent=b.extent(spark, sf_dir))
    return out.select("protein_group", "sample_name", r6("intens"))


# Empirical-Bayes correction: the fixed point is reached by plain iteration.
_COMBAT = f"""{NORMALISED},
bs AS (SELECT protein_group, plex AS batch, count(*) AS n, avg(normalized_intensity) AS m,
  var_pop(normalized_intensity) * count(*) AS ss FROM normalised GROUP BY 1, 2),
whole AS (SELECT protein_group, sum(n * m) / sum(n) AS grand, sum(ss) / sum(n) AS pooled FROM bs GROUP BY 1),
hats AS (SELECT protein_group, batch, n, grand, pooled, (m - grand) / sqrt(pooled) AS gh, ss / (n - 1) / pooled AS dh
  FROM bs JOIN whole USING (protein_group)),
moments AS (SELECT batch, avg(gh) AS gb, var_samp(gh) AS t2, avg(dh) AS md, var_samp(dh) AS vd FROM hats GROUP BY 1),
solved AS (
  SELECT 0 AS step, protein_group, batch, n, grand, pooled, gh, dh, gb, t2, (2 * vd + md * md) / vd AS a, (md * vd + md * md * md) / vd AS b,
    gh AS g, dh AS d FROM hats JOIN moments USING (batch)
  UNION ALL
  SELECT step + 1, protein_group, batch, n, grand, pooled, gh, dh, gb, t2, a, b,
    (t2 * n * gh + d * gb) / (t2 * n + d),
    (0.5 * ((n - 1) * dh + n * (gh - (t2 * n * gh + d * gb) / (t2 * n + d)) ** 2) + b) / (n / 2.0 + a - 1)
  FROM solved WHERE step < 100)"""


@query(with_ctes(_COMBAT) + """SELECT x.protein_group, x.sample_name,
  round(((normalized_intensity - grand) / sqrt(pooled) - g) / sqrt(d) * sqrt(pooled) + grand, 6) AS unbatched_intensity
FROM normalised x JOIN solved s ON s.protein_group = x.protein_group AND s.batch = x.plex WHERE step = 100""")
def combat_corrected(spark, sf_dir):
    batches = materialise(b.samples(spark, sf_dir).select("sample_name", F.col("plex").alias("batch")), "batches")
    rows = materialise(_normalised(spark, sf_dir), "normalised")  # read for the parameters and for the correction
    return batch.combat(rows, batches).select("protein_group", "sample_name", r6("unbatched_intensity"))


_ABSENT = "plex1_tmt_a1"  # named in the batch table, not measured


@query(with_ctes(_COMBAT.replace("FROM normalised GROUP", f"FROM normalised WHERE sample_name <> '{_ABSENT}' GROUP")) + f"""SELECT x.protein_group, x.sample_name,
  round(((normalized_intensity - grand) / sqrt(pooled) - g) / sqrt(d) * sqrt(pooled) + grand, 6) AS unbatched_intensity
FROM normalised x JOIN solved s ON s.protein_group = x.protein_group AND s.batch = x.plex WHERE step = 100 AND sample_name <> '{_ABSENT}'""")
def combat_without_an_absent_sample(spark, sf_dir):
    """Batch sizes count measured samples: one that the batch table names beyond them has no weight."""
    batches = materialise(b.samples(spark, sf_dir).select("sample_name", F.col("plex").alias("batch")), "batches")
    rows = materialise(_normalised(spark, sf_dir).where(F.col("sample_name") != _ABSENT), "normalised")
    return batch.combat(rows, batches).select("protein_group", "sample_name", r6("unbatched_intensity"))
