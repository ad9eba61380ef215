"""Adjusted p-values, ranked tables and heat-map matrices."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from plexlake.functions.scalars import quoted, readable_label
from plexlake.operators import arrays, model
from plexlake.operators.annotate import attach_annotation, results_with_values
from plexlake.operators.clean import significant
from plexlake.operators.project import row_z
from plexlake.plans.session import materialise, shared_dir
from plexlake.plans.sizing import BROADCAST_ROWS, LARGE_GROUP_ROWS, broadcast_if, checked_broadcast


def adjust_bh(
    df: DataFrame, p: str = "p_value", by: Sequence[str] = (), alias: str = "adj_p_value",
    group_rows: int | None = None, small_rows: int = LARGE_GROUP_ROWS,
) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values within ``by``; NULL p stays NULL and is not counted.

    Groups up to ``small_rows`` take one window each. Larger ones, of which there are at most rows / ``small_rows``,
    are ordered over all tasks and scanned in two passes (:func:`_adjust_by_scan`). ``group_rows`` is a known bound.
    """
    by = list(by)
    if group_rows is not None and group_rows <= small_rows:
        return _adjust_in_windows(df, p, by, alias)
    df = materialise(df, "tested")  # counted, and read again for either kind of group
    counts = df.groupBy(*by).agg(F.count(p).alias("_total"))
    large = materialise(counts.where(F.col("_total") > small_rows), "large_groups")
    n_large = large.count()
    if not n_large:
        return _adjust_in_windows(df, p, by, alias)
    if not by:
        return _adjust_by_scan(df, large, 1, p, by, alias)
    known = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in by]
    x, y = df.alias("x"), broadcast_if(large, n_large).alias("y")
    small = _adjust_in_windows(x.join(y, known, "left_anti"), p, by, alias)
    return small.unionByName(_adjust_by_scan(x.join(y, known, "left_semi"), large, n_large, p, by, alias))


def _adjust_in_windows(df: DataFrame, p: str, by: list[str], alias: str) -> DataFrame:
    # the flag keeps NULL p-values, wherever they sort, out of ranks and counts
    part = [*[F.col(c) for c in by], F.col(p).isNull()]
    upto = Window.partitionBy(*part).orderBy(p)
    rank = F.count(p).over(upto)  # range frame: ties share the highest rank
    n = F.count(p).over(Window.partitionBy(*part))
    onward = Window.partitionBy(*part).orderBy(F.desc(p))  # descending, so the minimum runs along in one pass
    return (
        df.withColumn("_raw", F.col(p) * n / F.nullif(rank, F.lit(0)))
        .withColumn(alias, F.when(F.col(p).isNotNull(), F.least(F.min("_raw").over(onward), F.lit(1.0))))
        .drop("_raw")
    )


def _runs(run: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))


def _scan(n_columns: int, alias: str | None):
    """Over rows in order of group and falling p: (..., p, run, above, total, carry).

    Without ``alias`` it gives (run, least) per batch and run; with it, the first ``n_columns`` columns and the
    running minimum.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen, least = None, 0, np.inf  # of the run that the batch before ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            p, run, above, total, carry = (c.to_numpy(zero_copy_only=False) for c in batch.columns[n_columns:])
            first = _runs(run)
            start = np.repeat(first, np.diff(np.append(first, len(run))))
            place = np.arange(len(run)) - start + np.where(run == last, seen, 0)
            raw = p * total / (total - above - place)
            if alias is None:
                found = [pa.array(run[first]), pa.array(np.fmin.reduceat(raw, first))]
                yield pa.record_batch(found, names=["_run", "_least"])
            else:
                raw = np.fmin(raw, np.minimum(carry, 1.0))
                if run[0] == last:
                    raw[0] = min(raw[0], least)
                for at, to in zip(first, np.append(first[1:], len(run))):
                    raw[at:to] = np.fmin.accumulate(raw[at:to])
                columns = batch.columns[:n_columns]
                yield pa.record_batch([*columns, pa.array(raw)], names=[*batch.schema.names[:n_columns], alias])
            last, seen, least = run[-1], place[-1] + 1, raw[-1]

    return scan


def _in_order(tested: DataFrame, p: str, by: Sequence[str]) -> DataFrame:
    """Rows ranged over tasks by group and falling p, equal values spread by a number of their own."""
    keys, falling = [F.col(quoted(c)) for c in by], F.col(quoted(p)).desc()
    numbered = tested.withColumn("_own", F.monotonically_increasing_id())
    return numbered.repartitionByRange(*keys, falling, "_own").sortWithinPartitions(*keys, falling).drop("_own")


def _adjust_by_scan(df: DataFrame, large: DataFrame, n_large: int, p: str, by: list[str], alias: str) -> DataFrame:
    """Large groups: rows in order over all tasks, then offsets and minima of the pieces that tasks hold.

    Rows are ranged by group, p and a number of their own, so equal p-values spread over tasks as any others, and
    written by ``checkpoint``, which keeps the pieces and their order. A piece has its count; with the counts
    of the pieces above it every row knows its rank. Then a piece has its least p x n / rank, and the running minimum over
    falling p goes on from the least of the pieces above. Only numbers per group and piece are joined, in a
    broadcast: groups and pieces bound them. No row is joined by its p-value.
    """
    spark = df.sparkSession
    columns = df.columns
    shared = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    tested = df.where(F.col(p).isNotNull())
    ranged = _in_order(tested, p, by).checkpoint()
    pieces = ranged.withColumn("_piece", F.spark_partition_id())
    counts = pieces.groupBy(*by, "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    above = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # a row per piece
    placed = materialise(
        counts.select(
            *by, "_piece", F.monotonically_increasing_id().alias("_run"), F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_above"),
            F.sum("_rows").over(Window.partitionBy(*by)).alias("_total"),
        ),
        "pieces",
    )
    n_placed = placed.count()  # at most groups plus pieces

    def met(about: DataFrame) -> DataFrame:
        x, y = pieces.alias("x"), broadcast_if(about, n_placed, max(BROADCAST_ROWS, n_large + ranged.rdd.getNumPartitions())).alias("y")
        on = [F.col("x._piece") == F.col("y._piece"), *[F.col(f"x.{quoted(c)}").eqNullSafe(F.col(f"y.{quoted(c)}")) for c in by]]
        number = F.col(f"x.{quoted(p)}").cast("double").alias("_p")
        rows = [F.col(f"x.{quoted(c)}") for c in columns]
        return x.join(y, on).select(*rows, number, "y._run", "y._above", "y._total", "y._carry")

    start = placed.withColumn("_carry", F.lit(float("inf")))
    minima = met(start).select("_p", "_run", "_above", "_total", "_carry").mapInArrow(_scan(0, None), "_run long, _least double")
    least = minima.groupBy("_run").agg(F.min("_least").alias("_least"))
    carried = placed.join(broadcast_if(least, n_placed), "_run").withColumn("_carry", F.coalesce(F.min("_least").over(above), F.lit(float("inf"))))
    carried = materialise(carried.drop("_least"), "carried")
    schema = StructType([*tested.schema.fields, StructField(alias, DoubleType())])
    adjusted = met(carried).mapInArrow(_scan(len(columns), alias), schema)
    return adjusted.unionByName(df.where(F.col(p).isNull()).withColumn(alias, F.lit(None).cast("double")))


def ranked(results: DataFrame, p: str = "p_value", feature: str = "protein_group", top: int | None = None) -> DataFrame:
    """All rows by p-value, feature as tie-break; ``top`` gives the first rows only."""
    ordered = results.orderBy(F.asc_nulls_last(p), feature)
    return ordered.limit(top) if top is not None else ordered


def contrast_results(
    fit: DataFrame, contrasts: model.Contrasts | DataFrame, annotation: DataFrame | None = None, feature: str = "protein_group",
    prior: model.VariancePrior | None = None,
) -> DataFrame:
    """Per contrast and feature: log_fc, ave_expr, t, p_value, adj_p_value, b, with annotation.

    ``fit`` should be materialised: prior and tables read it several times.
    """
    prior = prior or model.variance_prior(fit)
    # written before ranks and odds read it several times: each p-value is worked out once
    rows = materialise(model.moderated_t(model.moderate(model.apply_contrasts(fit, contrasts), prior)), "contrasts")
    n = rows.select("contrast").distinct().count() if isinstance(contrasts, DataFrame) else len(contrasts)
    rows = model.log_odds(rows, prior, n, feature)
    rows = adjust_bh(rows, by=["contrast"], group_rows=prior.most_rows)
    table = rows.select(feature, "contrast", "log_fc", "ave_expr", "t", "p_value", "adj_p_value", "b")
    return attach_annotation(table, annotation, feature) if annotation is not None else table


def overall_results(
    fit: DataFrame, contrasts: model.Contrasts, group_sizes: Mapping[str, int],
    annotation: DataFrame | None = None, feature: str = "protein_group", prior: model.VariancePrior | None = None, fold_changes: bool = True,
) -> DataFrame:
    """The table over all contrasts. With one contrast it is that contrast's own table."""
    if len(contrasts) == 1:
        return contrast_results(fit, contrasts, annotation, feature, prior)
    prior = prior or model.variance_prior(fit)
    table = adjust_bh(model.f_statistics(fit, contrasts, group_sizes, prior, fold_changes), group_rows=prior.most_rows)
    return attach_annotation(table, annotation, feature) if annotation is not None else table


def heat_map(
    results: DataFrame, long: DataFrame, meta: DataFrame, value: str = "unbatched_intensity",
    below: float = 0.01, feature: str = "protein_group", n_samples: int | None = None,
) -> DataFrame:
    """(feature, label, z) of significant features, with readable sample labels."""
    hits = significant(results, below=below).select(feature).distinct()
    scored = row_z(results_with_values(hits, long, value, feature), value, feature)
    labels = meta.select("sample_name", readable_label(F.col("exp_group"), F.col("sample_number"), ".").alias("label"))
    return scored.join(broadcast_if(labels, n_samples), "sample_name").select(feature, "label", "z")


def heat_map_of_cells(
    results: DataFrame, cells: DataFrame, samples: Sequence[str], labels: DataFrame, below: float = 0.01,
    feature: str = "protein_group", n_samples: int | None = None,
) -> DataFrame:
    """:func:`heat_map` from (feature, c): z-scores within the row, samples under the names in ``labels`` (sample_name, label)."""
    hits = checked_broadcast(significant(results, below=below).select(feature).distinct())
    scored = arrays.standardise(cells.join(hits, feature, "left_semi"), len(samples), False, feature)
    rows = arrays.cells_to_long(scored, samples, "z", feature)
    return rows.join(broadcast_if(labels.select("sample_name", "label"), n_samples), "sample_name").select(feature, "label", "z")
