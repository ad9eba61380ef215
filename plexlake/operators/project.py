"""Standardising, Gram matrix, principal components, distances and neighbours of samples.

Everything comes from one row per feature with an array over the samples. Numbers per sample, and per sample
and component, reach the driver; samples x samples tables stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plexlake.operators.arrays import cells_column, cells_matrix, from_cells, z_scores
from plexlake.plans.session import materialise
from plexlake.plans.sizing import broadcast_if

TILE = 512  # samples in a piece of a row of products
GRAM_BYTES = 256 << 20  # sums that one task holds
COMPONENTS = 100  # leading components that are worked out unless asked otherwise


def standardise(long: DataFrame, value: str, n_samples: int, feature: str = "protein_group") -> DataFrame:
    """Centre and scale each feature; only features complete over all samples and not constant."""
    moments = (
        long.groupBy(feature)
        .agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"), F.count(value).alias("_n"))
        .where((F.col("_n") == n_samples) & (F.col("_s") > 0))
    )
    return long.join(moments, feature).withColumn("z", (F.col(value) - F.col("_m")) / F.col("_s")).drop("_m", "_s", "_n")


def row_z(long: DataFrame, value: str, feature: str = "protein_group") -> DataFrame:
    """Row z-score of a heat map: NULLs allowed, constant rows give NULL."""
    moments = long.groupBy(feature).agg(F.avg(value).alias("_m"), F.nullif(F.stddev_samp(value), F.lit(0.0)).alias("_s"))
    return long.join(moments, feature).withColumn("z", (F.col(value) - F.col("_m")) / F.col("_s")).drop("_m", "_s")


def tree_sum(parts: DataFrame, fan: int = 64) -> DataFrame:
    """(key, values) summed over ``parts`` (key, part, values), arrays of one length.

    Two rounds, so that no task adds up what all tasks made; either reads its rows sorted by key, one batch at a time.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(0).to_numpy()
            values = batch.column(1).flatten().to_numpy().reshape(len(found), -1)
            if total is not None:
                found, values = np.concatenate([key, found]), np.concatenate([total, values])
            first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            sums = np.add.reduceat(values, first, axis=0)
            if len(first) > 1:
                yield pa.record_batch([pa.array(found[first[:-1]]), cells_column(sums[:-1])], names=["key", "values"])
            key, total = found[first[-1:]], sums[-1:]
        if total is not None:
            yield pa.record_batch([pa.array(key), cells_column(total)], names=["key", "values"])

    schema = "key long, values array<double>"
    some = parts.select("key", "values", F.pmod("part", F.lit(fan)).alias("bucket"))
    # the bucket is part of the key of the first round: its sums stay apart until the second
    first = some.repartition("key", "bucket").sortWithinPartitions("key").select("key", "values").mapInArrow(add, schema)
    return first.repartition("key").sortWithinPartitions("key").mapInArrow(add, schema)


def _usable(x: np.ndarray, scaled: bool) -> np.ndarray:
    """Complete rows; z-scores of those with variance if ``scaled``."""
    x = z_scores(x) if scaled else x
    return x[~np.isnan(x).any(axis=1)]


KINDS = ("scaled", "raw")


def gram_rows(
    table: DataFrame, n: int, kinds: Sequence[str] = KINDS, tile: int = TILE, most_bytes: int = GRAM_BYTES
) -> DataFrame:
    """(kind, i, tile, values, n_features): sums of products of sample ``i`` with those of a tile of samples.

    ``table`` is (feature, c); features count that are complete and, for the scaled kind, vary. A task adds up outer
    products and gives out one array a sample and tile (the last one filled up with zeros), which are summed in a
    tree. Both kinds come from one pass; where the sums of all samples do not fit ``most_bytes`` in a
    task, strips of samples are done one after the other, so any number of samples works.
    """
    tiles = -(-n // tile)
    rows = max(1, min(n, most_bytes // (8 * tiles * tile * len(kinds))))

    def strip(low: int) -> DataFrame:
        high = min(n, low + rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            sums, counts = [np.zeros((high - low, tiles * tile)) for _ in kinds], [0] * len(kinds)
            for batch in batches:
                cells = cells_matrix(batch.column(0), n)
                for k, kind in enumerate(kinds):
                    x = _usable(cells, kind == "scaled")
                    sums[k][:, :n] += x[:, low:high].T @ x
                    counts[k] += len(x)
            for k in range(len(kinds)):
                if counts[k]:
                    keys = (k * n + np.arange(low, high))[:, None] * tiles + np.arange(tiles)
                    values = sums[k].reshape(-1, tile)
                    keys, values = keys.ravel(), np.column_stack([values, np.full(len(values), float(counts[k]))])
                    for at in range(0, len(keys), 4096):
                        cut = slice(at, at + 4096)
                        where = np.full(len(keys[cut]), part, np.int32)
                        yield pa.record_batch([pa.array(keys[cut]), pa.array(where), cells_column(values[cut])], names=["key", "part", "values"])

        return table.select("c").mapInArrow(run, "key long, part int, values array<double>")

    parts = reduce(DataFrame.unionByName, [strip(low) for low in range(0, n, rows)])
    at = F.floor(F.col("key") / tiles).cast("long")
    return tree_sum(parts).select(
        F.get(F.array(*[F.lit(k) for k in kinds]), F.floor(at / n).cast("int")).alias("kind"),
        F.pmod(at, F.lit(n)).cast("int").alias("i"),
        F.pmod("key", F.lit(tiles)).cast("int").alias("tile"),
        F.slice("values", 1, tile).alias("values"),
        F.element_at("values", tile + 1).cast("long").alias("n_features"),
    )


def gram(cell_table: DataFrame, samples: Sequence[str], value: str, scale: bool = True, feature: str = "protein_group") -> DataFrame:
    """(i, j, g, n_features): sums of products over complete features, samples by position."""
    n = len(samples)
    rows = gram_rows(from_cells(cell_table, samples, value, feature), n, ["scaled" if scale else "raw"])
    return gram_long(rows, n, "scaled" if scale else "raw")


def gram_long(rows: DataFrame, n: int, kind: str, tile: int = TILE) -> DataFrame:
    """(i, j, g, n_features) of :func:`gram_rows`."""
    apart = rows.where(F.col("kind") == kind).select("i", "tile", "n_features", F.posexplode("values").alias("_p", "g"))
    j = F.col("tile") * tile + F.col("_p")
    return apart.select("i", j.alias("j"), "g", "n_features").where(F.col("j") < n)


def _product(table: DataFrame, n: int, q: np.ndarray) -> tuple[np.ndarray, int]:
    """(G q, features) for the matrix G of products of standardised samples over n - 1; G itself is never made."""
    width = q.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, count = TaskContext.get().partitionId(), np.zeros((n, width)), 0
        for batch in batches:
            x = _usable(cells_matrix(batch.column(0), n), True)
            total += x.T @ (x @ q)
            count += len(x)
        if count:
            values = np.column_stack([total, np.full(n, float(count))])
            yield pa.record_batch([pa.array(np.arange(n)), pa.array(np.full(n, part, np.int32)), cells_column(values)], names=["key", "part", "values"])

    rows = tree_sum(table.select("c").mapInArrow(run, "key long, part int, values array<double>")).collect()  # one per sample
    out = np.zeros((n, width + 1))
    for row in rows:
        out[row["key"]] = row["values"]
    return out[:, :-1] / max(1, n - 1), int(out[:, -1].max(initial=0))


def principal_axes(
    table: DataFrame, n: int, components: int = COMPONENTS, tolerance: float = 1e-9, most_passes: int = 60
) -> tuple[np.ndarray, np.ndarray, int]:
    """(eigenvalues, vectors, features) of the leading components, by block Krylov iteration from a random start.

    Each step is one pass over the features that multiplies the matrix with the newest block; the driver
    holds the blocks, samples x (components + 10) numbers each. It ends when every wanted residual is
    below ``tolerance`` times the largest value, or the blocks span all samples, where the result is exact; if neither
    happens it raises.
    """
    width = min(n, components + 10)
    block = np.eye(n) if width == n else np.linalg.qr(np.random.default_rng(0).normal(size=(n, width)))[0]
    basis, images = np.zeros((n, 0)), np.zeros((n, 0))
    for _ in range(most_passes):
        image, n_features = _product(table, n, block)
        basis, images = np.concatenate([basis, block], axis=1), np.concatenate([images, image], axis=1)
        small = basis.T @ images
        values, y = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1][: max(1, min(components, n - 1, n_features))]
        values, y = values[order], y[:, order]
        vectors = basis @ y
        off = np.linalg.norm(images @ y - vectors * values, axis=0)
        if basis.shape[1] == n or (off <= tolerance * max(values[0], 1e-300)).all():
            k = min(components, n - 1, n_features)
            return np.clip(values[:k], 0, None), vectors[:, :k], n_features
        fresh = image
        for _ in range(2):  # twice is enough to be orthogonal
            fresh = fresh - basis @ (basis.T @ fresh)
        q, r = np.linalg.qr(fresh)
        new = np.abs(np.diag(r)) > 1e-12 * max(values[0], 1e-300)
        block = q[:, new][:, : n - basis.shape[1]]
        if not block.shape[1]:
            k = min(components, n - 1, n_features)
            return np.clip(values[:k], 0, None), vectors[:, :k], n_features
        block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
    raise ArithmeticError(f"{components} components have not settled after {most_passes} passes; ask for fewer")


def pca(
    cell_table: DataFrame, samples: Sequence[str], value: str, feature: str = "protein_group", components: int = COMPONENTS
) -> tuple[DataFrame, DataFrame]:
    """:func:`pca_of_cells` of a long table with one row per cell."""
    return pca_of_cells(from_cells(cell_table, samples, value, feature), samples, components)


def pca_of_cells(table: DataFrame, samples: Sequence[str], components: int = COMPONENTS) -> tuple[DataFrame, DataFrame]:
    """Scores (sample_name, component, score) and components (component, eigenvalue, percent, n_features) of (feature, c).

    Samples are the observations; at most ``components`` are given, in order. Their percent is of the variance
    of all, which for standardised features is the number of them. The largest score of a component is positive.
    """
    spark, n = table.sparkSession, len(samples)
    table = materialise(table, "cells")
    values, vectors, n_features = principal_axes(table, n, components)
    k = len(values)
    flip = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)]) if k else np.zeros(0)
    scores = vectors * flip * np.sqrt(values * (n - 1))
    percent = np.round(100 * values / max(1, n_features), 2)
    score_rows = pd.DataFrame(
        {"sample_name": np.repeat(list(samples), k), "component": np.tile(np.arange(1, k + 1), n), "score": scores.ravel()}
    )
    component_rows = pd.DataFrame(
        {"component": np.arange(1, k + 1), "eigenvalue": values, "percent": percent, "n_features": n_features}
    )
    return (
        spark.createDataFrame(score_rows, "sample_name string, component int, score double"),
        spark.createDataFrame(component_rows, "component int, eigenvalue double, percent double, n_features long"),
    )


def pca_loadings(standardised: DataFrame, scores: DataFrame, components: DataFrame, n_samples: int, feature: str = "protein_group") -> DataFrame:
    """(feature, component, loading) for the components given: one keyed sum over the long table."""
    unit = scores.join(components.where("eigenvalue > 1e-9"), "component").select(
        "sample_name", "component", (F.col("score") / (F.col("eigenvalue") * (n_samples - 1))).alias("_u")
    )
    n_rows = n_samples * n_samples
    return (
        standardised.join(broadcast_if(unit, n_rows), "sample_name")
        .groupBy(feature, "component")
        .agg(F.sum(F.col("z") * F.col("_u")).alias("loading"))
    )


def sample_distances(gram_table: DataFrame, samples: Sequence[str]) -> DataFrame:
    """(sample_a, sample_b, distance): Euclidean, from an unscaled Gram matrix."""
    names = F.array(*[F.lit(s) for s in samples])
    diagonal = gram_table.where("i = j")
    n = len(samples)
    a = broadcast_if(diagonal.select("i", F.col("g").alias("g_ii")), n)
    b = broadcast_if(diagonal.select("j", F.col("g").alias("g_jj")), n)
    squared = F.greatest(F.col("g_ii") + F.col("g_jj") - 2 * F.col("g"), F.lit(0.0))
    return (
        gram_table.join(a, "i").join(b, "j")
        .select(
            F.get(names, F.col("i")).alias("sample_a"),
            F.get(names, F.col("j")).alias("sample_b"),
            F.when(F.col("i") == F.col("j"), 0.0).otherwise(F.sqrt(squared)).alias("distance"),
        )
    )


def nearest_neighbours(rows: DataFrame, samples: Sequence[str], k: int = 3, tile: int = TILE) -> DataFrame:
    """(sample_a, sample_b, distance, neighbour): the k nearest samples of each; the sample itself is the first.

    ``rows`` is :func:`gram_rows` with the raw kind. Every tile of a sample gives its own k best, and those of all
    tiles are merged: k rows a sample and tile, never all pairs. Ties go by name.
    """
    n = len(samples)
    raw = rows.where("kind = 'raw'")
    own = np.zeros(n)
    for row in raw.where(F.floor(F.col("i") / tile) == F.col("tile")).select("i", F.get("values", F.pmod("i", F.lit(tile))).alias("g")).collect():
        own[row["i"]] = row["g"]  # one number a sample
    by_name = np.argsort(np.argsort(np.array(list(samples), object), kind="stable"), kind="stable")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, b = batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy().astype(np.int64)
            g = cells_matrix(batch.column(2), tile)
            j = b[:, None] * tile + np.arange(tile)
            there = j < n
            j = np.where(there, j, 0)
            squared = np.maximum(own[i][:, None] + own[j] - 2 * g, 0.0)
            same = i[:, None] == j
            gaps = np.where(there, np.where(same, 0.0, np.sqrt(squared)), np.inf)
            order = np.lexsort((by_name[j], ~same, gaps), axis=-1)[:, :k]
            take = lambda x: np.take_along_axis(x, order, axis=1).ravel()
            kept = take(there)
            columns = [np.repeat(i, order.shape[1])[kept].astype(np.int32), take(j)[kept].astype(np.int32), take(gaps)[kept]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["i", "j", "distance"])

    names = F.array(*[F.lit(s) for s in samples])
    found = raw.select("i", "tile", "values").mapInArrow(best, "i int, j int, distance double").select(
        F.get(names, F.col("i")).alias("sample_a"), F.get(names, F.col("j")).alias("sample_b"), "distance"
    )
    order = Window.partitionBy("sample_a").orderBy("distance", F.col("sample_a") != F.col("sample_b"), "sample_b")  # k rows a tile
    return found.withColumn("neighbour", F.row_number().over(order)).where(F.col("neighbour") <= k)
