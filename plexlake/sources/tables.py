"""Delimited tables in and out. Columns are read as text and cast by name, so no inference pass."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexlake.functions.scalars import quoted
from plexlake.operators.reshape import expression_matrix
from plexlake.plans.session import materialise
from plexlake.plans.sizing import checked_broadcast


def cast_numeric(df: DataFrame, pattern: str) -> DataFrame:
    """Matching columns to DOUBLE; text that is no number becomes NULL."""
    return df.select(
        *[
            F.col(quoted(c)).try_cast("double").alias(c) if re.search(pattern, c) else F.col(quoted(c))
            for c in df.columns
        ]
    )


def _read(
    spark: SparkSession, path: str, sep: str, numeric: str | None, quote: str | None, strict: bool = True, multi_line: bool = False
) -> DataFrame:
    """Rows with too few or too many fields end the read when ``strict``; else they are padded or cut."""
    reader = spark.read.option("sep", sep).option("header", True).option("escape", '"')
    reader = reader.option("mode", "FAILFAST" if strict else "PERMISSIVE").option("multiLine", multi_line)
    if quote is not None:
        reader = reader.option("quote", quote)
    df = reader.csv(path)
    return cast_numeric(df, numeric) if numeric else df


def in_input_order(df: DataFrame, alias: str = "_ord") -> DataFrame:
    """A table just read from files, with the place of every row in the whole input: 0, 1, ... by path, block and row.

    Rows are written once with their file and block; the counts of blocks, one row each, become offsets.
    """
    at = ["_file", "_block"]
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id")
    )
    placed = materialise(placed, "input")
    # a task numbers the rows of a block without a gap
    blocks = placed.groupBy(*at).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)  # a row per block of the input
    offsets = materialise(blocks.select(*at, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "blocks")
    numbered = placed.join(checked_broadcast(offsets), at).withColumn(alias, F.col("_id") + F.col("_shift"))
    return numbered.drop(*at, "_id", "_shift")


def read_tsv(
    spark: SparkSession, path: str, numeric: str | None = r"(?i)intensity", quote: str | None = None, strict: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Tab-separated export; ``quote=""`` turns quoting off as for site tables."""
    return _read(spark, path, "\t", numeric, quote, strict, multi_line)


def read_csv(
    spark: SparkSession, path: str, numeric: str | None = r"(?i)intensity", strict: bool = True, multi_line: bool = False
) -> DataFrame:
    """Comma-separated export; ``multi_line`` is for quoted line breaks and reads a file in one task."""
    return _read(spark, path, ",", numeric, None, strict, multi_line)


def read_channel_map(spark: SparkSession, path: str) -> DataFrame:
    """Plex x channel matrix; the first column holds the plex."""
    df = _read(spark, path, ",", None, None)
    return df.withColumnRenamed(df.columns[0], "plex")


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sheet columns by position: sample number, group, experimental group."""
    df = _read(spark, path, ",", None, None)
    first_three = [F.col(quoted(c)) for c in df.columns[:3]]
    return df.select(*first_three).toDF("sample_number", "group_number", "exp_group")


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).csv(path)


def write_by_contrast(df: DataFrame, path: str, rows_per_file: int = 5_000_000, tsv: bool = False) -> None:
    """One folder per contrast, in few files: rows are dealt by contrast, large contrasts over several tasks."""
    writer = df.hint("rebalance", "contrast").write.option("maxRecordsPerFile", rows_per_file).partitionBy("contrast")
    if tsv:
        writer.option("sep", "\t").option("header", True).csv(path)
    else:
        writer.parquet(path)


def export_matrix(long: DataFrame, samples: list[str], value: str, path: str, feature: str = "protein_group") -> None:
    """Features x samples as a TSV file set."""
    write_tsv(expression_matrix(long, samples, value, feature), path)
