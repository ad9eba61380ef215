"""Annotation: collapsing, concatenating and joining what describes a feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.functions.scalars import quoted, tag_count

_RUN = 8192  # rows joined to one string in the first stage


def collapse_redundant(df: DataFrame, feature: str, values: Sequence[str]) -> DataFrame:
    """Distinct (feature, intensities)."""
    return df.select(feature, *values).distinct()


def concat_annotation(
    df: DataFrame, key: str, columns: Sequence[str], order: str, sep: str = ";", null_text: str = "NA"
) -> DataFrame:
    """One row per key with each column's values joined in ``order`` (duplicates kept).

    ``order`` is a whole number that rises along the input. Runs of it are joined
    first, so no task sorts a whole group of rows; the second stage joins one string
    per run. The result string is as long as the group makes it.
    """

    def joined(pairs, c):
        return F.array_join(F.transform(F.array_sort(pairs), lambda p: p[c]), sep)

    texts = [F.coalesce(F.col(c).cast("string"), F.lit(null_text)).alias(c) for c in columns]
    runs = (
        df.select(key, F.floor(F.col(order) / _RUN).alias("_run"), F.col(order).alias("_ord"), *texts)
        .groupBy(key, "_run")
        .agg(F.collect_list(F.struct("_ord", *columns)).alias("_rows"))
        .select(key, "_run", *[joined("_rows", c).alias(c) for c in columns])
    )
    return (
        runs.groupBy(key)
        .agg(F.collect_list(F.struct("_run", *columns)).alias("_runs"))
        .select(key, *[joined("_runs", c).alias(c) for c in columns])
    )


def concat_beside(
    df: DataFrame, key: str, joined: Sequence[str], kept: Sequence[str], order: str, sep: str = ";"
) -> DataFrame:
    """Columns ``joined`` concatenated per key, beside every distinct combination of the columns ``kept``."""
    return concat_annotation(df, key, joined, order, sep).join(df.select(key, *kept).distinct(), key)


def join_groups(annotation: DataFrame, values: DataFrame, feature: str) -> DataFrame:
    """Annotation rows x intensity rows of the same feature (m x n where both repeat)."""
    return annotation.join(values, feature)


def annotation_dimension(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def attach_annotation(results: DataFrame, annotation: DataFrame, feature: str = "protein_group") -> DataFrame:
    """Results with annotation columns right after the feature."""
    extra = [c for c in annotation.columns if c != feature]
    rest = [c for c in results.columns if c != feature]
    return results.join(annotation, feature).select(*[F.col(quoted(c)) for c in (feature, *extra, *rest)])


def results_with_values(results: DataFrame, long: DataFrame, value: str, feature: str = "protein_group") -> DataFrame:
    """Selected results with the sample values of their features."""
    return results.join(long.select(feature, "sample_name", value), feature)


def modification_summary(df: DataFrame, peptide: str, tag: str = "+79.97") -> DataFrame:
    """How many peptides carry the tag, how often, and the share."""
    n = tag_count(F.col(peptide), tag)
    return df.agg(
        F.count(peptide).alias("n_peptides"),
        F.count_if(n > 0).alias("n_modified"),
        F.sum(n).alias("n_tags"),
        (100 * F.count_if(n > 0) / F.count(peptide)).alias("percent_modified"),
    )
