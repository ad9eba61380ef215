"""Size checks that decide between a broadcast and a shuffled join."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table is broadcast only below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def rows_up_to(df: DataFrame, limit: int = BROADCAST_ROWS) -> int:
    """Row count, counting no further than ``limit + 1``."""
    return df.limit(limit + 1).count()


def broadcast_if(df: DataFrame, n_rows: int | None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a known row bound allows it, else leave the join to AQE."""
    return F.broadcast(df) if n_rows is not None and n_rows <= limit else df


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes: texts by their length, nested values by that of their JSON, the rest eight bytes."""
    total = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
        elif field.dataType.typeName() in ("array", "map", "struct"):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return total


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Measure ``df`` (bounded) and hint a broadcast only when it is small in rows and in bytes.

    Beyond the limits the caller's join runs as a shuffled join, where AQE splits
    skewed partitions.
    """
    rows, size = df.limit(limit + 1).agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return F.broadcast(df) if rows <= limit and (size or 0) <= most_bytes else df


# Rows of a table with as many groups as rows that one task sorts or groups.
TASK_ROWS = 500_000


def dealt_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` shuffled by ``keys`` into parts in proportion to its rows, counted first; a small one as it is.

    For keys with few rows each: what a task holds of them stays the same however large the table is, which a
    fixed number of partitions, or one that goes by compressed bytes, does not ensure.
    """
    parts = math.ceil(df.count() / TASK_ROWS)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), *keys) if parts > 1 else df


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before heavy work in Python.

    Input of a real size comes in more files than cores and is left where it is; so is what does not
    come from files, as a shuffle has dealt it out already.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


# Above this many rows in one group the built-in percentile is replaced by passes of counts.
LARGE_GROUP_ROWS = 1_000_000


@dataclass(frozen=True)
class Extent:
    """Proven bounds of a long table: how many samples, how many rows in the largest one."""

    samples: int
    sample_rows: int

    @property
    def rows(self) -> int:
        return self.samples * self.sample_rows


def measure(long: DataFrame, *sample: str) -> Extent:
    """Count samples and their rows: one pass over the sample column, two numbers back."""
    per_sample = long.groupBy(*(sample or ("sample_name",))).agg(F.count(F.lit(1)).alias("n"))
    row = per_sample.agg(F.count(F.lit(1)).alias("samples"), F.max("n").alias("rows")).first()
    return Extent(row["samples"], row["rows"] or 0)
