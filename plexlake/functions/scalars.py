"""Scalar expressions. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name that may hold dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))


def floor_to_null(value: Column, base: float) -> Column:
    """Values at or below ``base`` count as not measured."""
    return F.when(value > base, value)


def log2_intensity(value: Column) -> Column:
    return F.log2(value)


def is_flagged(flag: Column) -> Column:
    return F.coalesce(flag, F.lit("")) == "+"


def token(name: Column, position: int) -> Column:
    """1-based ``_`` token of a sample name, NULL when there are fewer."""
    return F.try_element_at(F.split(name, "_"), F.lit(position))


def plex_of(sample_name: Column) -> Column:
    """``plex12_tmt10_127n`` -> ``plex12``; holds for ten and more plexes."""
    return token(sample_name, 1)


def channel_of(sample_name: Column) -> Column:
    return token(sample_name, 3)


def sample_or_pool(group_number: Column, strict: bool = False) -> Column:
    """``POOL`` or ``sample``; ``strict`` gives NULL unless the name starts with Group."""
    pool = F.when(F.startswith(group_number, F.lit("POOL")), "POOL")
    if strict:
        return pool.when(F.startswith(group_number, F.lit("Group")), "sample")
    return pool.when(group_number.isNotNull(), "sample")


def sheet_sample_number(number: Column) -> Column:
    """Sheet and channel-map numbers become ``sample_<n>``; pools keep their name."""
    text = number.cast("string")
    return F.when(F.startswith(text, F.lit("POOL")), text).otherwise(F.concat(F.lit("sample_"), text))


def fasta_gene(header: Column) -> Column:
    """Gene name after ``GN=``; the whole header when there is none."""
    return F.regexp_replace(header, r"^.*GN=([^ ]*).*$", "$1")


def fasta_description(header: Column, species_token: str = "MOUSE") -> Column:
    """Text between the species token and ``OS``, trimmed."""
    return F.trim(F.regexp_replace(header, f"^.*{species_token}(.*?)OS.*$", "$1"))


def fasta_accession(header: Column) -> Column:
    """Second ``|`` field of a header."""
    return F.regexp_replace(header, r"^[^|]*\|([^|]*).*$", "$1")


def strip_modifications(peptide: Column) -> Column:
    """``AAK(+79.97)LR`` -> ``AAKLR``."""
    return F.regexp_replace(peptide, r"\s*\([^)]+\)", "")


def accession_head(accession: Column) -> Column:
    """Part before the first ``|``."""
    return F.substring_index(accession, "|", 1)


def accession_tail(accession: Column) -> Column:
    """Part after the first ``|``; the whole string when there is none."""
    return F.regexp_replace(accession, r"^[^|]*\|(.*)$", "$1")


def before_last(accession: Column) -> Column:
    """Second-to-last ``|`` token, NULL when there is only one."""
    return F.try_element_at(F.split(accession, r"\|"), F.lit(-2))


def sample_suffix(sample_number: Column) -> Column:
    """``sample_12`` -> ``12``; pool names stay whole."""
    return F.regexp_replace(sample_number, r"^.+_(.+)$", "$1")


def readable_label(exp_group: Column, sample_number: Column, sep: str = "_") -> Column:
    """``<exp_group>_<n>`` for matrices, ``<exp_group>.<n>`` for heat maps."""
    return F.concat(exp_group, F.lit(sep), sample_suffix(sample_number))


def replace_words(text: Column, words: Mapping[str, str]) -> Column:
    """Replace each word in turn, in the order of the mapping."""
    for old, new in words.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def syntactic_name(name: Column) -> Column:
    return F.replace(name, F.lit(" "), F.lit("_"))


def site_key(protein: Column, positions: Column, multiplicity: Column) -> Column:
    """``<protein>_<positions>___<m>`` (the multiplicity brings its underscores)."""
    return F.concat(protein, F.lit("_"), positions, multiplicity)


def percent_of(value: Column, total: Column, digits: int = 2) -> Column:
    return F.round(100 * value / total, digits)


def tag_count(peptide: Column, tag: str = "+79.97") -> Column:
    """How often a modification tag stands in a peptide string."""
    return F.regexp_count(peptide, F.lit("\\Q" + tag + "\\E"))


def first_of(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.col(quoted(c)) for c in columns])
