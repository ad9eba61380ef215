"""Quality metrics: the data behind every quality figure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexlake.functions.quantiles import exact_median, exact_quantiles
from plexlake.plans.sizing import Extent, broadcast_if, measure

_IQR_FACTOR = 1.5  # fixed value: whisker length of a box plot
_HIGH_MEDIAN = 1.5  # fixed value: distance in log2 units that marks a sample


def sample_medians(long: DataFrame, value: str = "intens", extent: Extent | None = None, alias: str = "MED") -> DataFrame:
    """(sample_name, <alias>), NULLs skipped; one row per sample."""
    extent = extent or measure(long)
    medians = exact_median(long, ["sample_name"], value, alias, extent.samples, extent.sample_rows)
    return medians.select("sample_name", alias)


def global_median(
    long: DataFrame, value: str = "intens", extent: Extent | None = None, null_propagating: bool = False
) -> DataFrame:
    """One row (median_all) over all rows; NULL if asked so and any value is NULL."""
    extent = extent or measure(long)
    median = exact_median(long.select(value), [], value, "median_all", 1, extent.rows)
    if null_propagating:
        gaps = long.agg(F.count_if(F.col(value).isNull()).alias("gaps"))
        return median.select(F.when(gaps.scalar() == 0, F.col("median_all")).alias("median_all"))
    return median.select("median_all")


def flag_high_medians(medians: DataFrame, threshold: float = _HIGH_MEDIAN) -> DataFrame:
    """``high`` = YES where a sample median is ``threshold`` or more off the mean of medians.

    As in the original statistics, one NULL median makes the mean, and so every flag, NULL.
    """
    everything = Window.partitionBy(F.lit(1))  # one row per sample
    mean = F.when(F.count("MED").over(everything) == F.count(F.lit(1)).over(everything), F.avg("MED").over(everything))
    off = F.abs(F.col("MED") - mean)
    return medians.withColumn("high", F.when(off >= threshold, "YES").when(off.isNotNull(), "NO"))


def attach_samples(long: DataFrame, per_sample: DataFrame, extent: Extent | None = None) -> DataFrame:
    """Add per-sample columns; broadcast under the known sample bound, so rows stay put."""
    extent = extent or measure(long)
    return long.join(broadcast_if(per_sample, extent.samples), "sample_name")


def flag_maximum(long: DataFrame, value: str = "intens", extent: Extent | None = None) -> DataFrame:
    """``is_max`` = YES on the largest value of each sample (all ties), NULL on NULL."""
    top = long.groupBy("sample_name").agg(F.max(value).alias("_top"))
    flagged = attach_samples(long, top, extent)
    is_max = F.when(F.col(value) == F.col("_top"), "YES").when(F.col(value).isNotNull(), "NO")
    return flagged.withColumn("is_max", is_max).drop("_top")


def completeness(long: DataFrame, value: str = "intens", n_features: int | None = None) -> DataFrame:
    """Percent of features with a value per sample.

    A dense long table has one row per feature in every sample; for a sparse one
    give ``n_features`` and missing rows count as missing values.
    """
    if n_features is None:
        share = 100 - 100 * F.count_if(F.col(value).isNull()) / F.count(F.lit(1))
    else:
        share = 100 * F.count(value) / F.lit(n_features)
    return long.groupBy("sample_name").agg(share.alias("completeness"))


def detected_features(long: DataFrame, value: str = "intens") -> DataFrame:
    return long.groupBy("sample_name").agg(F.count(value).alias("n_detected"))


def missing_per_feature(long: DataFrame, value: str = "intens", feature: str = "protein_group") -> DataFrame:
    return long.groupBy(feature).agg(F.count_if(F.col(value).isNull()).alias("n_missing"))


def missing_histogram(per_feature: DataFrame) -> DataFrame:
    return per_feature.groupBy("n_missing").agg(F.count(F.lit(1)).alias("n_features"))


def mean_line(per_sample: DataFrame, value: str) -> DataFrame:
    """The reference line of a bar chart."""
    return per_sample.agg(F.avg(value).alias(f"mean_{value}"))


def box_statistics(long: DataFrame, value: str = "intens", extent: Extent | None = None) -> DataFrame:
    """Quartiles, whisker ends and outlier count per sample.

    The second pass joins only the fences (one row per sample) to the rows.
    """
    extent = extent or measure(long)
    long = long.select("sample_name", value)
    quartiles = exact_quantiles(
        long, ["sample_name"], value, [0.25, 0.5, 0.75], extent.samples, extent.sample_rows
    ).select(
        "sample_name",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
    )
    reach = _IQR_FACTOR * (F.col("q3") - F.col("q1"))
    fenced = attach_samples(long, quartiles, extent).withColumns({"_lo": F.col("q1") - reach, "_hi": F.col("q3") + reach})
    v = F.col(value)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    return fenced.groupBy("sample_name").agg(
        F.first("q1").alias("q1"),
        F.first("median").alias("median"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(v.isNotNull() & ~inside).alias("n_outliers"),
    )


def presence_absence(
    long: DataFrame, present_in: str, absent_in: str, min_present: int = 1,
    value: str = "intens", feature: str = "protein_group", group: str = "exp_group",
) -> DataFrame:
    """Features seen in at least ``min_present`` samples of one group and in none of another."""
    seen = F.col(value).isNotNull()
    counts = long.groupBy(feature).agg(
        F.count_if(seen & (F.col(group) == present_in)).alias("n_present"),
        F.count_if(seen & (F.col(group) == absent_in)).alias("n_absent"),
    )
    return counts.where((F.col("n_present") >= min_present) & (F.col("n_absent") == 0))
