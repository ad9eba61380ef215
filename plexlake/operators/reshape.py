"""Wide to long and back."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.functions.quantiles import cell_median
from plexlake.functions.scalars import quoted

# Matrices are made of one column per sample; more samples than this stay long.
MAX_SAMPLE_COLUMNS = 5_000


def to_long(wide: DataFrame, samples: Sequence[str], value: str = "intens") -> DataFrame:
    """One row per feature row and sample, NULLs kept. No shuffle."""
    ids = [F.col(quoted(c)) for c in wide.columns if c not in set(samples)]
    return wide.unpivot(ids, [F.col(quoted(s)) for s in samples], "sample_name", value)


def cells(long: DataFrame, value: str, feature: str = "protein_group", hot_rows: int = 1_000_000) -> DataFrame:
    """Median per feature x sample, NULL when any member is NULL."""
    return cell_median(long, [feature, "sample_name"], value, value, True, hot_rows)


def check_matrix_width(samples: Sequence[str]) -> None:
    if len(samples) > MAX_SAMPLE_COLUMNS:
        raise ValueError(f"{len(samples)} samples exceed {MAX_SAMPLE_COLUMNS} matrix columns; keep the table long")


def expression_matrix(cell_table: DataFrame, samples: Sequence[str], value: str, feature: str = "protein_group") -> DataFrame:
    """Features x samples from a table with one row per cell."""
    check_matrix_width(samples)
    return cell_table.groupBy(feature).pivot("sample_name", list(samples)).agg(F.first(value, ignorenulls=True))


def rename_samples(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """Matrix columns under their readable names; samples without one keep theirs."""
    rows = labels.where(F.col("sample_name").isin(matrix.columns)).select("sample_name", "label").collect()  # one per column
    names = {r["sample_name"]: r["label"] for r in rows}
    repeated = {n for n in names.values() if list(names.values()).count(n) > 1}
    if repeated:
        raise ValueError(f"several samples would be called {sorted(repeated)}")
    return matrix.withColumnsRenamed(names)


def densify(cell_table: DataFrame, samples: Sequence[str], value: str, feature: str = "protein_group") -> DataFrame:
    """Every feature x sample, NULL where no cell exists.

    One grouping by feature; a group holds at most one entry per sample.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("sample_name", value)))
    return (
        cell_table.groupBy(feature)
        .agg(entries.alias("_m"))
        .select(feature, "_m", F.explode(F.array(*[F.lit(s) for s in samples])).alias("sample_name"))
        .select(feature, "sample_name", F.try_element_at("_m", F.col("sample_name")).alias(value))
    )


def multiplicity_rows(wide: DataFrame, prefix: str = "reporter_intensity_corrected") -> DataFrame:
    """``<prefix>_<ch>_plex<p>_<m>`` columns to rows (ids, sample, multiplicity, value).

    ``multiplicity`` is ``___<m>``. Zero shuffles.
    """
    values = [c for c in wide.columns if c.startswith(prefix)]
    ids = [c for c in wide.columns if not c.startswith(prefix)]
    pattern = rf"^({prefix}_[0-9]+_plex[0-9]+)_+([0-9]+)$"
    long = wide.unpivot(ids, values, "_column", "value")
    return long.select(
        *ids,
        F.regexp_extract("_column", pattern, 1).alias("sample"),
        F.concat(F.lit("___"), F.regexp_extract("_column", pattern, 2)).alias("multiplicity"),
        "value",
    )


def multiplicity_wide(wide: DataFrame, prefix: str = "reporter_intensity_corrected") -> DataFrame:
    """One row per input row and multiplicity, with ids, ``multiplicity`` and one column per sample.

    A struct per multiplicity is exploded: nothing is shuffled or merged, so rows with equal ids
    stay apart. A sample without a column for a multiplicity is NULL there.
    """
    found: dict[str, dict[str, str]] = {}
    for column in wide.columns:
        if m := re.fullmatch(rf"({prefix}_[0-9]+_plex[0-9]+)_+([0-9]+)", column):
            found.setdefault(m[2], {})[m[1]] = column
    samples = list(dict.fromkeys(s for columns in found.values() for s in columns))
    ids = [F.col(quoted(c)) for c in wide.columns if not c.startswith(prefix)]
    rows = [
        F.struct(
            F.lit(f"___{k}").alias("multiplicity"),
            *[(F.col(quoted(columns[s])) if s in columns else F.lit(None)).cast("double").alias(s) for s in samples],
        )
        for k, columns in sorted(found.items())
    ]
    return wide.select(*ids, F.inline(F.array(*rows)))
