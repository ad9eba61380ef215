"""Sample metadata. These tables have one row per sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexlake.functions.scalars import (
    channel_of,
    plex_of,
    quoted,
    readable_label,
    replace_words,
    sample_or_pool,
    sheet_sample_number,
)
from plexlake.plans.sizing import broadcast_if, checked_broadcast


def channel_rows(matrix: DataFrame, kit: str, plex: str = "plex") -> DataFrame:
    """Plex x channel matrix -> (sample_number, sample_name)."""
    channels = [c for c in matrix.columns if c != plex]
    long = matrix.unpivot([plex], [F.col(quoted(c)) for c in channels], "_channel", "_number")
    return long.where(F.col("_number").isNotNull()).select(
        sheet_sample_number(F.col("_number")).alias("sample_number"),
        F.lower(F.concat_ws("_", F.col(plex), F.lit(kit), F.col("_channel"))).alias("sample_name"),
    )


def sample_sheet(sheet: DataFrame) -> DataFrame:
    return sheet.withColumn("sample_number", sheet_sample_number(F.col("sample_number")))


def sample_metadata(channels: DataFrame, sheet: DataFrame) -> DataFrame:
    """(sample_number, sample_name, group_number, exp_group)."""
    return channels.join(sheet, "sample_number")


def order_by_group(meta: DataFrame) -> DataFrame:
    return meta.orderBy("group_number", "sample_number", "sample_name")


def attach_metadata(long: DataFrame, meta: DataFrame, n_samples: int | None = None, strict: bool = False) -> DataFrame:
    """Add metadata, plex, channel and pool label; samples without metadata drop.

    ``n_samples`` is a known bound on the rows of ``meta``; without it they are counted.
    """
    small = broadcast_if(meta, n_samples) if n_samples is not None else checked_broadcast(meta)
    return long.join(small, "sample_name").withColumns(
        {
            "plex": plex_of(F.col("sample_name")),
            "tmt": channel_of(F.col("sample_name")),
            "sample_or_pool": sample_or_pool(F.col("group_number"), strict),
        }
    )


def non_pool_samples(meta: DataFrame) -> DataFrame:
    """Ordered list of samples that are no pools (a table of samples, one small window)."""
    return (
        meta.where(~F.startswith("group_number", F.lit("POOL")))
        .select("sample_name")
        .withColumn("position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("sample_name")))
    )


def running_number(meta: DataFrame, group: str = "exp_group") -> DataFrame:
    """1, 2, ... within each group, by sample name."""
    return meta.withColumn("running_number", F.row_number().over(Window.partitionBy(group).orderBy("sample_name")))


def readable_names(meta: DataFrame, words: Mapping[str, str] | None = None, ending: str = "number", sep: str = "_") -> DataFrame:
    """Add ``label``: the group, its words replaced, with the sample's number or a running one."""
    named = meta.withColumn("exp_group", replace_words(F.col("exp_group"), words or {}))
    if ending == "running":
        number = F.col("running_number").cast("string")
        return running_number(named).withColumn("label", F.concat_ws(sep, "exp_group", number)).drop("running_number")
    if ending != "number":
        raise ValueError(f"unknown ending {ending!r}")
    return named.withColumn("label", readable_label(F.col("exp_group"), F.col("sample_number"), sep))


def samples_on_one_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sample names that only one of two tables holds, with the side."""
    a, b = left.select("sample_name").distinct(), right.select("sample_name").distinct()
    only_left = a.join(b, "sample_name", "left_anti").withColumn("side", F.lit("left"))
    only_right = b.join(a, "sample_name", "left_anti").withColumn("side", F.lit("right"))
    return only_left.unionByName(only_right)


def sample_names(meta: DataFrame, limit: int = 5_000) -> Sequence[str]:
    """Sample names for matrix columns; refuses more than ``limit``."""
    rows = meta.select("sample_name").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} samples")
    return sorted(r["sample_name"] for r in rows)
