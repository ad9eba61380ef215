"""Exact medians and quantiles that never gather a group in one task.

``percentile`` buffers every distinct value of a group on one executor. Per-sample
and global medians have few groups and unbounded rows, so they go another way:

1. a mergeable sketch per group gives a bracket that surely holds the wanted rank;
2. the bracket is cut into bins, and bin counts (combined map-side) name the one
   or two bins with the rank;
3. only the rows of those bins are counted by value and picked from.

Each step is one pass with a tiny shuffle, and the result is the exact interpolated
quantile. Where a row bound shows that every group is small, the built-in aggregate is
used instead. Cells (feature x sample) have many small groups: they are sorted in
place, and only cells above a row limit are sent the other way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexlake.plans.sizing import LARGE_GROUP_ROWS, broadcast_if, dealt_by

_SKETCH = 1000  # rank error of the sketch is n / _SKETCH
_MARGIN = 3.0 / _SKETCH  # more than the error plus two ranks once n > _SKETCH
_BINS = 1024


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """-1 below the bracket, 0.._BINS-1 inside, NULL above."""
    inside = F.least(F.floor((v - lo) / (hi - lo) * _BINS), F.lit(_BINS - 1)).cast("int")
    return (
        F.when(v < lo, -1)
        .when((v <= hi) & (lo == hi), 0)
        .when(v <= hi, inside)
        .cast("int")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    n_groups: int | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """(keys, n, q array<double>): linear-interpolated quantiles, NULLs skipped.

    ``n_groups`` and ``group_rows`` are known bounds on the number of groups and on
    the rows of the largest; without ``group_rows`` the rows are counted first.
    Keys must not be NULL.
    """
    keys = list(keys)
    if group_rows is None:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        group_rows = sizes.agg(F.max("_n")).first()[0] or 0
    if group_rows <= LARGE_GROUP_ROWS:
        points = F.array(*[F.lit(float(p)) for p in probs])
        return df.groupBy(*keys).agg(F.count(value).alias("n"), F.percentile(F.col(value).cast("double"), points).alias("q"))
    return quantiles_by_counts(df, keys, value, probs, n_groups)


def quantiles_by_counts(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], n_groups: int | None = None
) -> DataFrame:
    """Same result as :func:`exact_quantiles` for groups of any size."""
    keys = list(keys)
    by = keys or ["_all"]
    n_groups = 1 if not keys else n_groups
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    if not keys:
        # one group, by a key that is not a literal: the optimiser would turn that into a cross join
        rows = rows.withColumn("_all", F.pmod(F.hash("_v"), F.lit(1)))
    points = [x for p in probs for x in (max(p - _MARGIN, 0.0), min(p + _MARGIN, 1.0))]

    sketch = rows.groupBy(*by).agg(
        F.count("_v").alias("n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", points, _SKETCH).alias("_s"),
    )
    small = F.col("n") <= _SKETCH
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.floor((F.col("n") - 1) * p).alias("r0"),
                F.ceil((F.col("n") - 1) * p).alias("r1"),
                ((F.col("n") - 1) * p - F.floor((F.col("n") - 1) * p)).alias("w"),
                F.when(small, F.col("_min")).otherwise(F.col("_s")[2 * i]).alias("lo"),
                F.when(small, F.col("_max")).otherwise(F.col("_s")[2 * i + 1]).alias("hi"),
            )
            for i, p in enumerate(probs)
        ]
    )
    brackets = sketch.where("n > 0").select(*by, targets.alias("_t"))
    rows = rows.where(F.col("_v").isNotNull())

    binned = (
        rows.join(broadcast_if(brackets, n_groups), by)
        .select(
            *by,
            F.explode(F.transform("_t", lambda t: F.struct(t["i"].alias("i"), _bin(F.col("_v"), t["lo"], t["hi"]).alias("b")))).alias("x"),
        )
        .where("x.b is not null")
        .groupBy(*by, F.col("x.i").alias("i"), F.col("x.b").alias("b"))
        .agg(F.count("*").alias("c"))
    )
    upto = Window.partitionBy(*by, "i").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("c").over(upto), F.lit(0))
    hit = (
        binned.withColumn("before", before)
        .join(broadcast_if(brackets.select(*by, F.inline("_t")), n_groups), [*by, "i"])
        .where((F.col("b") >= 0) & (F.col("before") <= F.col("r1")) & (F.col("before") + F.col("c") > F.col("r0")))
    )
    chosen = hit.groupBy(*by).agg(
        F.collect_list(F.struct("i", "b", "before", "r0", "r1", "w", "lo", "hi")).alias("_c")  # at most 2 per prob
    )
    picked = (
        rows.join(broadcast_if(chosen, n_groups), by)
        .select(
            *by,
            "_v",
            F.inline(F.filter("_c", lambda c: _bin(F.col("_v"), c["lo"], c["hi"]) == c["b"])),
        )
        .groupBy(*by, "i", "b", "before", "r0", "r1", "w", "_v")
        .agg(F.count("*").alias("c"))
    )
    order = Window.partitionBy(*by, "i", "b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("before") + F.sum("c").over(order)
    values = (
        picked.withColumn("end", end)
        .groupBy(*by, "i")
        .agg(
            F.max("w").alias("w"),
            F.min(F.when(F.col("end") > F.col("r0"), F.col("_v"))).alias("v0"),
            F.min(F.when(F.col("end") > F.col("r1"), F.col("_v"))).alias("v1"),
            (F.min("before") > F.max("r0")).alias("_below"),
        )
        # a sketch that missed its own bound must not pass for a quantile
        .withColumn("q", F.when(F.col("_below") | F.col("v1").isNull(), F.raise_error(F.lit("a rank lies outside its bracket"))).otherwise(
            F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("w")))
        .groupBy(*by)
        .agg(*[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"_q{i}") for i in range(len(probs))])
    )
    result = sketch.select(*by, "n").join(broadcast_if(values, n_groups), by, "left")
    return result.select(*keys, "n", F.array(*[F.col(f"_q{i}") for i in range(len(probs))]).alias("q"))


def exact_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    alias: str = "median",
    n_groups: int | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """(keys, n, <alias>) for few groups of any size."""
    quantiles = exact_quantiles(df, keys, value, [0.5], n_groups, group_rows)
    return quantiles.select(*keys, "n", F.col("q")[0].alias(alias))


def _sorted_median(df: DataFrame, keys: list[str], value: str, alias: str, null_propagating: bool) -> DataFrame:
    """Median of many small groups: one shuffle, a spillable sort and the middle rows.

    Half the time of the built-in aggregate, which keeps one object map per group.
    """
    cell = Window.partitionBy(*keys)
    ranked = df.select(
        *keys,
        F.col(value).alias("_v"),
        F.row_number().over(cell.orderBy(F.asc_nulls_last(value))).alias("_r"),
        F.count(value).over(cell).alias("_n"),
        F.count(F.lit(1)).over(cell).alias("_all"),
    )
    middle = (F.col("_r") >= F.floor((F.col("_n") + 1) / 2)) & (F.col("_r") <= F.ceil((F.col("_n") + 1) / 2))
    empty = (F.col("_n") == 0) & (F.col("_r") == 1)
    median = F.avg("_v")
    if null_propagating:
        median = F.when(F.max("_n") == F.max("_all"), median)
    return ranked.where(middle | empty).groupBy(*keys).agg(median.alias(alias))


def cell_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    alias: str,
    null_propagating: bool = True,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Median per cell for many groups.

    ``null_propagating`` gives NULL when any member is NULL, otherwise NULLs are
    skipped. A first pass of counts decides: when no cell has more than two
    rows (the usual case, one measurement per cell) the mean is the median. Cells above ``hot_rows`` (at most rows / hot_rows of them)
    take :func:`exact_median`, all others are sorted within their cell. Cells are dealt to
    tasks by the number of rows, so a task holds as many in a table of any size.
    """
    keys = list(keys)
    df = dealt_by(df.select(*keys, value), keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.agg(F.max("_n").alias("largest"), F.count_if(F.col("_n") > hot_rows).alias("hot")).first()
    if (sizes["largest"] or 0) <= 2:
        mean = F.avg(value)
        if null_propagating:
            mean = F.when(F.count(value) == F.count(F.lit(1)), mean)
        return df.groupBy(*keys).agg(mean.alias(alias))
    if sizes["hot"] == 0:
        return _sorted_median(df, keys, value, alias, null_propagating)
    hot = broadcast_if(counts.where(F.col("_n") > hot_rows), sizes["hot"])
    cold = _sorted_median(df.join(hot, keys, "left_anti"), keys, value, alias, null_propagating)
    big = exact_median(df.join(hot, keys, "left_semi"), keys, value, "_m", sizes["hot"]).join(hot, keys)
    keep = F.when(F.col("n") == F.col("_n"), F.col("_m")) if null_propagating else F.col("_m")
    return cold.unionByName(big.select(*keys, keep.alias(alias)))
