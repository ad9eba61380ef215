"""Exact k-means of vectors by Shallot search (Borgelt 2020), on whole numbers.

A vector carries its centroid and the second nearest, an upper bound of the distance to the one and a
lower bound to all others. Bounds move with the centroids; while they hold, a vector is not compared
with anything. When they fail, the search starts at the closer of the two remembered centroids and
goes through that one's neighbours by distance. A centroid better than the second best so far lies
within the vector's distance to the start plus that second distance, a ball that shrinks as better
ones turn up. Bounds are floating point with slack; every comparison that decides is between whole
squared distances, ties to the smaller number.

The state (vec_id, components, both centroids, both bounds) is a table on shared storage, written once
a round; the one before it is removed then. Sums are combined in tasks before they are shuffled, so a
cluster with a third of all rows is a few partial rows. Only centroids, bounded by the settings, and
their sums are on the driver and in tasks.

Defined results: vectors that are NULL, of another length, or hold NULL or non-finite components are
left out; with fewer vectors than centroids every vector starts one; repeated rows are vectors of their
own; a NULL vec_id is clustered and never starts a centroid unless ids run out; an empty table gives no
rows. Components beyond ``matrices.LIMIT`` after scaling saturate. Columns other than ``vec_id`` and
``embedding`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexlake.llm import matrices
from plexlake.llm.stage import keep, remove
from plexlake.plans.sizing import spread

Batches = Iterator[pa.RecordBatch]
STATE = "vec_id long, v array<int>, first int, second int, upper double, lower double"


@dataclass(frozen=True)
class Settings:
    dims: int = 64
    centroids: int = 40
    rounds: int = 5
    scale: float = 256.0
    seed: str = "2:"  # centroids start at the vectors with the smallest hash of this and their id


class Centres:
    """Centroids, the neighbours of each in order of distance, and how far they moved."""

    def __init__(self, points: np.ndarray, before: np.ndarray | None = None):
        self.points = points
        squares = np.stack([matrices.square(points, p[None, :]) for p in points])
        np.fill_diagonal(squares, -1)
        self.near = np.argsort(squares, axis=1, kind="stable")[:, 1:]
        # every gap is a little too small: a ball then holds too many centroids, never too few
        self.gaps = np.sqrt(np.take_along_axis(squares, self.near, axis=1)) * (1 - matrices.SLACK)
        self.half = self.gaps[:, 0] / 2 if len(points) > 1 else np.full(len(points), np.inf)
        moved = np.zeros(len(points)) if before is None else np.sqrt(matrices.square(points, before)) * (1 + matrices.SLACK)
        self.moved = moved
        # the farthest move among the other centroids
        top = np.argsort(-moved, kind="stable")[:2]
        self.others_moved = np.full(len(points), moved[top[0]])
        self.others_moved[top[0]] = moved[top[1]] if len(points) > 1 else 0.0


def search(x: np.ndarray, state: tuple[np.ndarray, ...], centres: Centres) -> tuple[np.ndarray, ...]:
    """(first, second, upper, lower) of the rows of ``x`` for moved centroids."""
    first, second, upper, lower = (s.copy() for s in state)
    upper += centres.moved[first]
    lower -= centres.others_moved[first]
    open_ = np.flatnonzero(upper >= np.maximum(lower, centres.half[first]))
    own = matrices.square(x[open_], centres.points[first[open_]])
    upper[open_] = np.sqrt(own) * (1 + matrices.SLACK)
    still = upper[open_] >= np.maximum(lower[open_], centres.half[first[open_]])
    rows, own = open_[still], own[still]
    if not len(rows):
        return first, second, upper, lower
    if len(centres.points) == 1:
        lower[rows] = np.inf
        return first, second, upper, lower
    best, rival = first[rows], second[rows]
    best_square, rival_square = own, matrices.square(x[rows], centres.points[rival])
    swap = (rival_square < best_square) | ((rival_square == best_square) & (rival < best))
    best, rival = np.where(swap, rival, best), np.where(swap, best, rival)
    best_square, rival_square = np.where(swap, rival_square, best_square), np.where(swap, best_square, rival_square)
    start, reach = best.copy(), np.sqrt(best_square)
    active = np.arange(len(rows))
    for step in range(centres.near.shape[1]):
        inside = centres.gaps[start[active], step] <= (reach[active] + np.sqrt(rival_square[active])) * (1 + matrices.SLACK)
        active = active[inside]
        if not len(active):
            break
        other = centres.near[start[active], step]
        new = (other != best[active]) & (other != rival[active])
        at, other = active[new], other[new]
        found = matrices.square(x[rows[at]], centres.points[other])
        wins = (found < best_square[at]) | ((found == best_square[at]) & (other < best[at]))
        rises = ~wins & (found < rival_square[at])
        won, risen = at[wins], at[rises]
        rival[won], rival_square[won] = best[won], best_square[won]
        best[won], best_square[won] = other[wins], found[wins]
        rival[risen], rival_square[risen] = other[rises], found[rises]
    first[rows], second[rows] = best, rival
    upper[rows] = np.sqrt(best_square) * (1 + matrices.SLACK)
    lower[rows] = np.sqrt(rival_square) * (1 - matrices.SLACK)
    return first, second, upper, lower


def _begin(settings: Settings, known: int) -> Callable[[pa.RecordBatch], tuple]:
    """State of raw vectors: bounds that hold for nothing, so that all are searched."""

    def read(batch: pa.RecordBatch) -> tuple:
        places, values = matrices.matrix(batch.column(1), settings.dims)
        n = len(places)
        state = np.zeros(n, np.int64), np.full(n, min(1, known - 1)), np.full(n, np.inf), np.zeros(n)
        return batch.column(0).take(pa.array(places)), matrices.whole(values, settings.scale), state

    return read


def _resume(settings: Settings) -> Callable[[pa.RecordBatch], tuple]:
    def read(batch: pa.RecordBatch) -> tuple:
        state = tuple(batch.column(i).to_numpy() for i in range(2, 6))
        return batch.column(0), matrices.whole_matrix(batch.column(1), settings.dims), state

    return read


def _assign(read: Callable[[pa.RecordBatch], tuple], centres: Centres, last: bool) -> Callable[[Batches], Batches]:
    def assign(batches: Batches) -> Batches:
        for batch in batches:
            ids, x, state = read(batch)
            first, second, upper, lower = search(x, state, centres)
            if last:
                found = [ids, first.astype(np.int32), matrices.square(x, centres.points[first])]
                names = ["vec_id", "cluster", "distance"]
            else:
                found = [ids, matrices.lists(x), first.astype(np.int32), second.astype(np.int32), upper, lower]
                names = ["vec_id", "v", "first", "second", "upper", "lower"]
            yield pa.record_batch([f if isinstance(f, pa.Array) else pa.array(f) for f in found], names=names)

    return assign


def _sum(k: int, dims: int) -> Callable[[Batches], Batches]:
    """Rows and component sums of every cluster, over the rows of a task."""

    def add(batches: Batches) -> Batches:
        counts, sums = np.zeros(k, np.int64), np.zeros(k * dims, np.int64)
        for batch in batches:
            x, at = matrices.whole_matrix(batch.column(0), dims), batch.column(1).to_numpy()
            counts += np.bincount(at, minlength=k)
            keys = (at[:, None] * dims + np.arange(dims)).ravel()
            sums += np.bincount(keys, weights=x.ravel(), minlength=k * dims).astype(np.int64)  # below 2 ** 53, so exact
        some = np.flatnonzero(counts)
        sums = sums.reshape(k, dims)[some]
        yield pa.record_batch(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    return add


def _starts(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The vectors that centroids start from: a top-k, bounded by the settings."""
    kept = vectors.where((F.size("embedding") == settings.dims) & matrices.usable(F.col("embedding")))
    order = F.sha2(F.concat(F.lit(settings.seed), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "embedding").limit(settings.centroids).select("embedding").collect()
    return matrices.whole(np.array([r.embedding for r in rows], np.float64).reshape(-1, settings.dims), settings.scale)


def _moved(state: DataFrame, points: np.ndarray) -> np.ndarray:
    """Centroids at the floors of their vectors' means; those without vectors stay."""
    k, dims = points.shape
    partial = state.select("v", "first").mapInArrow(_sum(k, dims), "cluster int, n long, sums array<long>")
    totals = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))
    after = points.copy()
    for row in totals.collect():  # at most one row a centroid
        after[row.cluster] = matrices.floors(row.sums, row.n)
    return after


@dataclass(frozen=True)
class Clustering:
    members: DataFrame  # (vec_id, cluster, distance)
    centroids: np.ndarray

    def described(self) -> DataFrame:
        """``members`` with the inertia of the cluster and of all, and a hash of the centroid."""
        spark = self.members.sparkSession
        sums = {r.cluster: r.s for r in self.members.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
        total = sum(sums.values())
        rows = [
            (k, sums[k], total, hashlib.sha256(",".join(map(str, self.centroids[k].tolist())).encode()).hexdigest()) for k in sorted(sums)
        ]
        about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
        return self.members.join(F.broadcast(about), "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
        )


def cluster(vectors: DataFrame, settings: Settings = Settings()) -> Clustering:
    """Cluster ``vectors`` (vec_id, embedding); the state is rewritten once a round and then removed."""
    spark = vectors.sparkSession
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    points = _starts(raw, settings)
    if not len(points):
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"), points)
    source, read, before = spread(raw), _begin(settings, len(points)), None
    for _ in range(settings.rounds):
        state = keep(source.mapInArrow(_assign(read, Centres(points, before), False), STATE), "clusters")
        if before is not None:
            remove(source)
        before, points = points, _moved(state, points)
        source, read = state, _resume(settings)
    last = _assign(read, Centres(points, before), True)
    members = keep(source.mapInArrow(last, "vec_id long, cluster int, distance long"), "clusters")
    if before is not None:
        remove(source)
    return Clustering(members, points)
