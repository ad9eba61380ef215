"""FASTA records as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexlake.functions.scalars import fasta_accession, fasta_description, fasta_gene


def read_fasta(spark: SparkSession, path: str, species_token: str = "MOUSE") -> DataFrame:
    """(header, sequence, description, gene_name, accession, fasta_ord).

    The text source splits on the record mark itself, so files are read in
    parallel and a record is never cut. ``fasta_ord`` is (file, place in it): it rises along each
    file, files by path, whatever way they are packed into tasks.
    """
    record = F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "")
    lines = (
        spark.read.option("lineSep", "\n>").text(path)
        .select(
            record.alias("r"),
            F.struct(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("fasta_ord"),
        )
        .where(F.trim("r") != "")
    )
    header = F.concat(F.lit(">"), F.substring_index("r", "\n", 1))
    body = F.when(F.instr("r", "\n") > 0, F.regexp_replace(F.regexp_replace("r", "^[^\n]*\n", ""), "\n", ""))
    return lines.select(
        header.alias("header"),
        F.coalesce(body, F.lit("")).alias("sequence"),
        fasta_description(header, species_token).alias("description"),
        fasta_gene(header).alias("gene_name"),
        fasta_accession(header).alias("accession"),
        "fasta_ord",
    )
