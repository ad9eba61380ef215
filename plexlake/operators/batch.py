"""Batch (plex) correction. Input has one row per feature and sample."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from plexlake.plans.sizing import broadcast_if, rows_up_to

_TOLERANCE = 1e-10
_MAX_STEPS = 200_000  # a fixed point that is not reached by then is an error, not a result
_PRIOR = StructType([StructField("g", DoubleType()), StructField("d", DoubleType())])


def no_batch(long: DataFrame, value: str = "normalized_intensity") -> DataFrame:
    return long.withColumn("unbatched_intensity", F.col(value))


def pool_reference(
    long: DataFrame, value: str = "normalized_intensity", feature: str = "protein_group",
    plex: str = "plex", label: str = "sample_or_pool",
) -> DataFrame:
    """Internal-reference scaling in log space.

    Each plex moves by the difference between its own pool mean and the mean of the
    pool means of all plexes, feature by feature; NULL where a plex has no pool value.
    """
    pools = long.groupBy(feature, plex).agg(F.avg(F.when(F.col(label) == "POOL", F.col(value))).alias("_pool"))
    shifts = pools.select(
        feature, plex, (F.avg("_pool").over(Window.partitionBy(feature)) - F.col("_pool")).alias("_shift")
    )  # window: one row per plex
    shifted = long.join(shifts, [feature, plex], "left")
    return shifted.withColumn("unbatched_intensity", F.col(value) + F.col("_shift")).drop("_shift")


def posterior(
    n: np.ndarray, g_hat: np.ndarray, d_hat: np.ndarray, g_bar: np.ndarray, t2: np.ndarray, a: np.ndarray, b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior location and scale; sums of squares have a closed form in (n, mean, variance)."""
    g, d = g_hat.copy(), d_hat.copy()
    left = np.flatnonzero(~np.isnan(g) & ~np.isnan(d))
    with np.errstate(all="ignore"):
        for _ in range(_MAX_STEPS):
            if not len(left):
                break
            m, hat, scale, old_g, old_d = n[left], g_hat[left], d_hat[left], g[left], d[left]
            new_g = (t2[left] * m * hat + old_d * g_bar[left]) / (t2[left] * m + old_d)
            ss = (m - 1) * scale + m * (hat - new_g) ** 2
            new_d = (0.5 * ss + b[left]) / (m / 2 + a[left] - 1)
            g[left], d[left] = new_g, new_d
            left = left[np.fmax(np.abs(new_g - old_g), np.abs(new_d - old_d) / old_d) > _TOLERANCE]
    if len(left):
        raise ArithmeticError(f"{len(left)} features have no posterior after {_MAX_STEPS} steps")
    return g, d


@F.pandas_udf(_PRIOR)
def _posterior(
    n: pd.Series, g_hat: pd.Series, d_hat: pd.Series, g_bar: pd.Series, t2: pd.Series, a: pd.Series, b: pd.Series
) -> pd.DataFrame:
    g, d = posterior(*(s.to_numpy(float) for s in (n, g_hat, d_hat, g_bar, t2, a, b)))
    return pd.DataFrame({"g": g, "d": d})


def combat_prior(per_batch: DataFrame) -> DataFrame:
    """(batch, g_bar, t2, a, b) over all features, from their (batch, g_hat, d_hat)."""
    return per_batch.groupBy("batch").agg(
        F.avg("g_hat").alias("g_bar"), F.var_samp("g_hat").alias("t2"),
        F.avg("d_hat").alias("mean_d"), F.var_samp("d_hat").alias("var_d"),
    ).select(
        "batch", "g_bar", "t2",
        ((2 * F.col("var_d") + F.col("mean_d") ** 2) / F.col("var_d")).alias("a"),
        ((F.col("mean_d") * F.col("var_d") + F.col("mean_d") ** 3) / F.col("var_d")).alias("b"),
    )


def combat_statistics(
    long: DataFrame, batches: DataFrame, value: str, feature: str = "protein_group", n_batch_rows: int | None = None, gaps: bool | None = None
) -> DataFrame:
    """(feature, batch, n, grand, pooled, g_hat, d_hat, gaps): what the correction needs of a feature.

    ``gaps`` says whether any value at all is missing, where the caller knows it better than ``long`` shows.
    """
    n_batch_rows = rows_up_to(batches) if n_batch_rows is None else n_batch_rows
    joined = long.select(feature, "sample_name", value).join(broadcast_if(batches, n_batch_rows), "sample_name")
    v = F.col(value)
    # samples that are measured, not all that a batch table names
    measured = joined.select("batch", "sample_name").distinct()
    sizes = measured.groupBy("batch").agg(F.count(F.lit(1)).alias("n_b"))
    stats = (
        joined.groupBy(feature, "batch")
        .agg(
            F.count(v).alias("n"), F.avg(v).alias("m"),
            (F.var_pop(v) * F.count(v)).alias("ss"),
        )
        .join(broadcast_if(sizes, n_batch_rows), "batch")
    )
    whole = Window.partitionBy(feature)  # one row per batch
    total = F.sum("n_b").over(whole)
    missing = joined.agg(F.count_if(v.isNull()) > 0).scalar() if gaps is None else F.lit(gaps)
    seen = F.sum("n").over(whole)
    return stats.select(
        feature, "batch", "n", "m", "ss",
        (F.sum(F.col("n_b") * F.col("m")).over(whole) / total).alias("grand"),
        (F.sum("ss").over(whole) / F.when(missing, seen - 1).otherwise(seen)).alias("pooled"),
        ((F.min("ss").over(whole) > 0) & (F.min("n").over(whole) > 1)).alias("usable"),
    ).select(
        feature, "batch", "n", "grand", "pooled",
        F.when(F.col("usable"), (F.col("m") - F.col("grand")) / F.sqrt("pooled")).alias("g_hat"),
        F.when(F.col("usable"), F.col("ss") / F.try_subtract(F.col("n"), F.lit(1)) / F.col("pooled")).alias("d_hat"),
        missing.alias("gaps"),
    )


def combat_parameters(
    long: DataFrame, batches: DataFrame, value: str, feature: str = "protein_group", n_batch_rows: int | None = None,
    prior: DataFrame | None = None, gaps: bool | None = None,
) -> DataFrame:
    """(feature, batch, grand, pooled, g, d) of empirical-Bayes location/scale correction.

    Only sufficient statistics per feature and batch are used (Johnson, Li and
    Rabinovic 2007). Features with no variance in some batch get NULL parameters. ``prior`` is
    that of these features unless given.
    """
    n_batch_rows = rows_up_to(batches) if n_batch_rows is None else n_batch_rows
    per_batch = combat_statistics(long, batches, value, feature, n_batch_rows, gaps)
    prior = combat_prior(per_batch) if prior is None else prior
    posterior = _posterior(*[F.col(c).cast("double") for c in ("n", "g_hat", "d_hat", "g_bar", "t2", "a", "b")])
    return (
        per_batch.join(broadcast_if(prior, n_batch_rows), "batch")
        .withColumn("_p", posterior)
        .select(feature, "batch", "grand", "pooled", F.col("_p.g").alias("g"), F.col("_p.d").alias("d"))
    )


def combat(
    long: DataFrame, batches: DataFrame, value: str = "normalized_intensity", feature: str = "protein_group",
    prior: DataFrame | None = None, gaps: bool | None = None,
) -> DataFrame:
    """Empirical-Bayes batch correction; ``batches`` is (sample_name, batch).

    Samples without a batch are left out; features without variance pass unchanged.
    """
    n_batch_rows = rows_up_to(batches)
    parameters = combat_parameters(long, batches, value, feature, n_batch_rows, prior, gaps)
    rows = long.join(broadcast_if(batches, n_batch_rows), "sample_name").join(parameters, [feature, "batch"])
    spread = F.sqrt("pooled")
    corrected = ((F.col(value) - F.col("grand")) / spread - F.col("g")) / F.sqrt("d") * spread + F.col("grand")
    kept = F.when(F.col("d").isNull(), F.col(value)).otherwise(corrected)
    return rows.withColumn("unbatched_intensity", kept).drop("grand", "pooled", "g", "d")
