"""Proteomics roles played by the order tables.

Suppliers (or, sparser, parts) are the features, a sample is line status x return flag x
line number, and the measured value is a sum over lines. Line number 7 is the pool.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexlake.functions.scalars import log2_intensity, zero_to_null
from plexlake.operators.meta import attach_metadata
from plexlake.plans.sizing import Extent, measure

SAMPLE_COLUMNS = ["l_linestatus", "l_returnflag", "l_linenumber"]
GROUPS = ["Group_A", "Group_N", "Group_R"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PLEX = "if(l_linestatus = 'F', 'plex1', 'plex2')"
CHANNEL = "concat(lower(l_returnflag), l_linenumber)"
SAMPLE_NAME = f"concat({PLEX}, '_tmt_', {CHANNEL})"
_FLAG_ORDER = "(instr('ANR', l_returnflag) - 1)"
_LATE = "if(l_linestatus = 'O', 1, 0)"
_NUMBER = (
    f"if(l_linenumber = 7, concat('POOL', 1 + {_FLAG_ORDER} + 3 * {_LATE}), "
    f"string(l_linenumber + 6 * {_FLAG_ORDER} + 18 * {_LATE}))"
)
_GROUP = "if(l_linenumber = 7, 'POOL', concat('Group', l_returnflag))"
_EXP_GROUP = "if(l_linenumber = 7, 'POOL', concat('Group ', l_returnflag))"


def extent(spark: SparkSession, sf_dir: str) -> Extent:
    """Samples, and lines of the largest sample: no feature table has more rows per sample."""
    return measure(table(spark, sf_dir, "lineitem"), *SAMPLE_COLUMNS)


def quantities(spark: SparkSession, sf_dir: str, feature: str = "l_suppkey", measure: str = "l_extendedprice") -> DataFrame:
    """(protein_group, sample_name, value): one row per measured cell.

    Summed map-side on the raw key columns; names are made once per cell.
    """
    summed = table(spark, sf_dir, "lineitem").groupBy(feature, *SAMPLE_COLUMNS).agg(F.sum(measure).alias("value"))
    return summed.selectExpr(f"string({feature}) AS protein_group", f"{SAMPLE_NAME} AS sample_name", "value")


def log_long(spark: SparkSession, sf_dir: str, feature: str = "l_suppkey", measure: str = "l_extendedprice") -> DataFrame:
    """(protein_group, sample_name, intens): log2, zero is missing."""
    intens = log2_intensity(zero_to_null(F.col("value")))
    return quantities(spark, sf_dir, feature, measure).select("protein_group", "sample_name", intens.alias("intens"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier has a value in every sample."""
    return log_long(spark, sf_dir)


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts: about half of the cells exist, some of them hold NULL."""
    return log_long(spark, sf_dir, "l_partkey", "l_discount")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single lines as repeated measurements, zero is missing."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_partkey) AS protein_group", f"{SAMPLE_NAME} AS sample_name", "nullif(l_discount, 0D) AS v"
    )


def _sample_rows(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*SAMPLE_COLUMNS).distinct().selectExpr(*columns)


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample with its number (``POOL<n>`` for pools)."""
    return _sample_rows(
        spark, sf_dir, f"{SAMPLE_NAME} AS sample_name", f"{PLEX} AS plex", f"{CHANNEL} AS channel", f"{_NUMBER} AS number"
    )


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_number, group_number, exp_group) as a user writes it."""
    return _sample_rows(
        spark, sf_dir, f"{_NUMBER} AS sample_number", f"{_GROUP} AS group_number", f"{_EXP_GROUP} AS exp_group"
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_number, sample_name, group_number, exp_group)."""
    return _sample_rows(
        spark, sf_dir, f"if(l_linenumber = 7, '', 'sample_') || {_NUMBER} AS sample_number", f"{SAMPLE_NAME} AS sample_name",
        f"{_GROUP} AS group_number", f"{_EXP_GROUP} AS exp_group",
    )


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense table with metadata."""
    return attach_metadata(dense(spark, sf_dir), metadata(spark, sf_dir), extent(spark, sf_dir).samples)


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense table without pools, with groups."""
    return annotated(spark, sf_dir).where("sample_or_pool = 'sample'")


def supplier_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("protein_group"), F.col("s_name").alias("protein_names"),
        F.col("s_nationkey").alias("gene_names"),
    )


def fasta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FASTA text made of suppliers: a header and two sequence lines each."""
    key = F.col("s_suppkey").cast("string")
    header = F.concat(
        F.lit(">sp|S"), key, F.lit("|"), F.upper("s_name"), F.lit("_MOUSE Protein of "), F.col("s_nationkey").cast("string"),
        F.lit(" OS=Mus musculus GN=Gene"), F.col("s_nationkey").cast("string"), F.lit(" PE=1"),
    )
    letters = F.translate(F.col("s_name"), "0123456789#", "ACDEFGHIKLM")
    return table(spark, sf_dir, "supplier").select(
        F.concat_ws("\n", header, F.upper(letters), F.translate(key, "0123456789", "NPQRSTVWYA")).alias("value")
    )
