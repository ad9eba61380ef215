"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.functions.scalars import first_of, is_flagged
from plexlake.plans.session import materialise
from plexlake.plans.sizing import broadcast_if, checked_broadcast, dealt_by

FLAGS = ("reverse", "potential_contaminant", "only_identified_by_site")


def drop_flagged(df: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """Drop rows marked ``+`` in any flag column, then the flag columns."""
    for flag in flags:
        df = df.where(~is_flagged(F.col(flag)))
    return df.drop(*flags)


def remove_contaminants(df: DataFrame, contaminants: DataFrame, accession: str = "accession") -> DataFrame:
    """Drop rows when any token of the accession is a contaminant accession.

    Only rows that hold a token shared with the list are collected per distinct
    accession string, so the wide rows are shuffled at most once.
    """
    known = checked_broadcast(contaminants.select(F.col("accession").alias("_token")).distinct())
    hits = (
        df.select(accession).distinct()
        .select(accession, F.explode(F.split(accession, r"[|:;]")).alias("_token"))
        .join(known, "_token", "left_semi")
        .select(accession).distinct()
    )
    return df.join(checked_broadcast(materialise(hits, "contaminants")), accession, "left_anti")


def drop_all_missing(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows without any value. Narrow."""
    return wide.where(first_of(columns).isNotNull())


def drop_all_missing_long(long: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Drop the rows of keys without any value.

    Both sides are shuffled by key into parts of bounded size, where the keys with a value are hashed and the
    rows stream past them.
    """
    long = dealt_by(long, keys)
    seen = long.where(F.col(value).isNotNull()).select(*keys).distinct()
    return long.join(seen.hint("shuffle_hash"), list(keys), "left_semi")


def confident_sites(df: DataFrame, probability: str = "localization_prob", minimum: float = 0.5) -> DataFrame:
    return df.where(F.col(probability) >= minimum)


def remove_samples(long: DataFrame, names: Sequence[str] = ()) -> DataFrame:
    return long.where(~F.col("sample_name").isin(*names)) if names else long


def filter_missing(
    long: DataFrame, max_missing: float, value: str, feature: str = "protein_group", n_samples: int | None = None
) -> DataFrame:
    """Keep features whose share of missing values is at most ``max_missing``.

    With ``n_samples`` absent rows count as missing too, so a sparse table need not be
    filled first. The share is combined map-side; the semi join then moves each row
    once by feature.
    """
    share = F.avg(F.col(value).isNull().cast("double")) if n_samples is None else 1 - F.count(value) / F.lit(n_samples)
    kept = long.groupBy(feature).agg(share.alias("_share")).where(F.col("_share") <= max_missing)
    return long.join(kept, feature, "left_semi")


def keep_common_samples(long: DataFrame, samples: DataFrame, n_samples: int | None = None) -> DataFrame:
    """Only samples present in both tables."""
    names = samples.select("sample_name").distinct()
    small = broadcast_if(names, n_samples) if n_samples is not None else checked_broadcast(names)
    return long.join(small, "sample_name", "left_semi")


def significant(results: DataFrame, p: str = "p_value", below: float = 0.01) -> DataFrame:
    return results.where(F.col(p) < below)
