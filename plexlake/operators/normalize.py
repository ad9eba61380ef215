"""Median normalisation and missing values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexlake.functions.quantiles import exact_quantiles
from plexlake.operators.qc import attach_samples, global_median, sample_medians
from plexlake.plans.sizing import Extent, measure


def shift_to_median(long: DataFrame, median_all: DataFrame, value: str = "intens", alias: str = "normalized_intensity") -> DataFrame:
    """``value - MED + median_all`` for a long table that carries ``MED``."""
    return long.withColumn(alias, F.col(value) - F.col("MED") + median_all.scalar())


def median_normalise(
    long: DataFrame, value: str = "intens", alias: str = "normalized_intensity", extent: Extent | None = None
) -> DataFrame:
    """Move every sample to the common median.

    The per-sample medians are broadcast under the sample bound and the common median
    is a scalar subquery, so the long rows are not shuffled.
    """
    extent = extent or measure(long)
    with_med = attach_samples(long, sample_medians(long, value, extent), extent)
    return shift_to_median(with_med, global_median(long, value, extent), value, alias)


def strict_medians(long: DataFrame, value: str, extent: Extent) -> tuple[DataFrame, DataFrame]:
    """(sample_name, MEDIAN) and one row (median_all), NULL where any value of the sample, or of all, is."""
    gaps = long.groupBy("sample_name").agg(F.count_if(F.col(value).isNull()).alias("_gaps"))
    medians = (
        sample_medians(long, value, extent, "MEDIAN")
        .join(gaps, "sample_name")
        .select("sample_name", F.when(F.col("_gaps") == 0, F.col("MEDIAN")).alias("MEDIAN"))
    )
    return medians, global_median(long, value, extent, null_propagating=True)


def renormalise(long: DataFrame, value: str = "unbatched_intensity", extent: Extent | None = None) -> DataFrame:
    """Second pass after batch removal: NULL anywhere in a sample makes its median NULL."""
    extent = extent or measure(long)
    medians, total = strict_medians(long, value, extent)
    shifted = attach_samples(long, medians, extent)
    return shifted.withColumn(value, F.col(value) - F.col("MEDIAN") + total.scalar())


def sample_floors(long: DataFrame, value: str, extent: Extent, quantile: float = 0.01) -> DataFrame:
    """(sample_name, _floor): a low quantile of every sample."""
    floors = exact_quantiles(long, ["sample_name"], value, [quantile], extent.samples, extent.sample_rows)
    return floors.select("sample_name", F.col("q")[0].alias("_floor"))


def impute(
    long: DataFrame, value: str, how: str = "no", feature: str = "protein_group",
    group: str = "exp_group", quantile: float = 0.01, extent: Extent | None = None, floors: DataFrame | None = None,
) -> DataFrame:
    """Fill missing values.

    ``no`` leaves them; ``group_median`` takes the median of the feature in its group
    (a window over at most one row per sample); ``sample_floor`` takes a low quantile
    of the sample.
    """
    if how == "no":
        return long
    if how == "group_median":
        fill = F.median(value).over(Window.partitionBy(feature, group))
        return long.withColumn(value, F.coalesce(F.col(value), fill))
    if how == "sample_floor":
        extent = extent or measure(long)
        floors = sample_floors(long, value, extent, quantile) if floors is None else floors
        filled = attach_samples(long, floors, extent)
        return filled.withColumn(value, F.coalesce(F.col(value), F.col("_floor"))).drop("_floor")
    raise ValueError(f"unknown imputation {how!r}")
