"""Left joins with a table of unique keys when one key of the left side may hold a third of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.llm.stage import keep
from plexlake.plans.sizing import checked_broadcast

HEAVY_ROWS = 10_000  # rows of one key that a task takes
HEAVY_KEYS = 100_000  # bound of the keys that are sent to all tasks


def attach(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined with ``table`` (unique ``key``) without one task taking all rows of a key.

    A table that is measured to be small is broadcast. Otherwise keys are counted map-side. Heavy ones, of
    which there are at most ``HEAVY_KEYS`` since each holds that share of the rows, are broadcast with
    their entries; what is left has few rows a key and is shuffled.
    """
    small = checked_broadcast(table)
    if small is not table:
        return rows.join(small, key, "left")
    counts = keep(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")), "counts")
    most = max(HEAVY_ROWS, (counts.agg(F.sum("n")).first()[0] or 0) // HEAVY_KEYS)
    heavy = keep(counts.where(F.col("n") > most).join(table, key, "left").drop("n"), "heavy")
    names = F.broadcast(heavy.select(key))
    return rows.join(names, key, "left_anti").join(table, key, "left").unionByName(rows.join(F.broadcast(heavy), key))
