"""Intermediate tables of the corpus operators, on the cluster's shared storage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from plexlake.plans.session import delete_path, scratch_path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile has its shuffle files deleted right after, not when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write once, compressed, and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._kept_at = path
    return kept


def keep_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As :func:`keep`, in buckets by ``key``: groups of it are read without a shuffle, and stand together in a file."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    rows = df.write.option("compression", "zstd").option("path", path)
    rows.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key).saveAsTable(table)
    kept = spark.table(table)
    kept._kept_at, kept._table = path, table
    return kept


def remove(kept: DataFrame) -> None:
    """Delete the files of a table that :func:`keep` or :func:`keep_by` returned, once nothing reads it any more."""
    if "_table" in vars(kept):
        kept.sparkSession.sql(f"DROP TABLE {kept._table}")
    delete_path(kept.sparkSession, kept._kept_at)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name
