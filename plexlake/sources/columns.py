"""Column names and column choice. Nothing here touches rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.functions.scalars import quoted

# Reporter channels of each labelling kit, in column order.
CHANNELS = {
    "tmt6": ["126", "127n", "128c", "129n", "130c", "131"],
    "tmt10": ["126", "127n", "127c", "128n", "128c", "129n", "129c", "130n", "130c", "131n"],
    "tmt11": ["126", "127n", "127c", "128n", "128c", "129n", "129c", "130n", "130c", "131n", "131c"],
    "tmt16": [
        "126", "127n", "127c", "128n", "128c", "129n", "129c", "130n",
        "130c", "131n", "131c", "132n", "132c", "133n", "133c", "134n",
    ],
}
REPORTER_PATTERN = r"^Reporter intensity corrected"


def reporter_names(kit: str, n_plex: int) -> list[str]:
    """``Intensity plex1 : TMT10-126`` and so on, plex by plex."""
    label = kit.upper()
    return [f"Intensity plex{p} : {label}-{c.upper()}" for p in range(1, n_plex + 1) for c in CHANNELS[kit]]


def rename_reporters(df: DataFrame, kit: str, n_plex: int) -> DataFrame:
    """Name the reporter columns after plex and channel, in their order."""
    old = [c for c in df.columns if re.search(REPORTER_PATTERN, c)]
    new = reporter_names(kit, n_plex)
    if len(old) != len(new):
        raise ValueError(f"{len(old)} reporter columns found, {kit} x {n_plex} plexes needs {len(new)}")
    return df.withColumnsRenamed(dict(zip(old, new, strict=True)))


def select_columns(df: DataFrame, ids: Sequence[str], intensities: str, flags: Sequence[str] = ()) -> DataFrame:
    """Id columns by name, intensity columns by pattern, flag columns by prefix."""
    values = [c for c in df.columns if re.search(intensities, c)]
    marks = [c for c in df.columns if any(c.startswith(f) for f in flags)]
    return df.select(*[F.col(quoted(c)) for c in [*ids, *values, *marks]])


def drop_combined(df: DataFrame) -> DataFrame:
    """Drop columns that stand for several samples (``;`` or ``(`` in the name)."""
    return df.select(*[F.col(quoted(c)) for c in df.columns if not re.search(r"[;(]", c)])


def snake_case(name: str) -> str:
    text = name.replace("%", "_percent_").replace("#", "_number_")
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"([a-z])([A-Z])", r"\1_\2", text)
    text = re.sub(r"[^0-9A-Za-z]+", "_", text).strip("_").lower()
    return "x" + text if text[:1].isdigit() or not text else text


def clean_columns(df: DataFrame, plex_word: str = "tm_tset", strip: str = "intensity_") -> DataFrame:
    """Snake case, without the word to strip, plex word unified, duplicates numbered."""
    names: list[str] = []
    for column in df.columns:
        name = snake_case(column).replace(strip, "").replace(plex_word, "plex")
        seen, unique = 1, name
        while unique in names:
            seen += 1
            unique = f"{name}_{seen}"
        names.append(unique)
    return df.toDF(*names)


def plex_columns(df: DataFrame, pattern: str = r"^plex[0-9]") -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def zero_to_null_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(0.0)) for c in columns})
