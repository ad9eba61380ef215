"""Checks that return the rows in breach; empty means all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.plans.sizing import checked_broadcast


def key_is_unique(df: DataFrame, key: str) -> DataFrame:
    """One row (n_rows, n_keys, is_unique)."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))
        .withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unmapped_samples(long: DataFrame, meta: DataFrame) -> DataFrame:
    """Samples of the long table without metadata, with the rows they would lose."""
    per_sample = long.groupBy("sample_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return per_sample.join(checked_broadcast(meta.select("sample_name")), "sample_name", "left_anti")


def ambiguous_groups(annotation: DataFrame, values: DataFrame, feature: str) -> DataFrame:
    """Features that several annotation rows or several intensity rows describe."""
    a = annotation.groupBy(feature).agg(F.count(F.lit(1)).alias("n_annotation"))
    v = values.groupBy(feature).agg(F.count(F.lit(1)).alias("n_values"))
    return a.join(v, feature).where((F.col("n_annotation") > 1) | (F.col("n_values") > 1))
