"""Vectors as short codes: a codebook for every part of a vector, learnt by Ball k-means (Xia et al. 2020).

The parts nearest to an entry form its ball; the radius is the largest distance of one of them, moved
along with the entry. Only entries closer than twice the radius are neighbours of the ball, so only they
can take a part from it. A part nearer to its entry than half the way to the nearest neighbour lies
in the stable core and keeps its entry. The others lie in rings: a part whose distance falls between half the
gaps to the t-th and the next neighbour has just the t nearest neighbours as candidates. A ball that did
not move, nor any neighbour of it, is left alone as a whole. Distances that decide are whole squared
numbers, ties to the lower entry; gaps and radii are floating point with slack.

All parts start in the ball of entry 0 with an infinite radius, so the first round needs no search of its
own. The state (vec_id, label, components, code) is written once a round and the one before it removed.
Radii, counts and sums are combined in tasks; codebooks, bounded by the settings, are on the driver and in tasks.

Defined results: vectors that are NULL, of another length than ``dims``, or hold NULL or non-finite
components are left out; with fewer vectors than entries the codebook is as short; repeated rows are coded
alike; NULL ids come last among those that start entries; NULL labels are one label; an empty table gives
no rows. Components beyond ``matrices.LIMIT`` after scaling saturate. Columns other than ``vec_id``,
``embedding`` and ``label`` are not read.
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
from plexlake.plans.sizing import checked_broadcast, spread

Batches = Iterator[pa.RecordBatch]
STATE = "vec_id long, label string, v array<int>, code binary"


@dataclass(frozen=True)
class Settings:
    dims: int = 64
    parts: int = 16
    entries: int = 64  # 256 at most: an index is a byte
    rounds: int = 2
    scale: float = 256.0

    @property
    def width(self) -> int:
        return self.dims // self.parts


class Balls:
    """The entries of one part position: neighbours by distance, half the gaps to them, balls left alone."""

    def __init__(self, entries: np.ndarray, radii: np.ndarray, moved: np.ndarray):
        self.entries = entries
        k = len(entries)
        squares = np.stack([matrices.square(entries, e[None, :]) for e in entries])
        np.fill_diagonal(squares, -1)
        self.near = np.argsort(squares, axis=1, kind="stable")[:, 1:]
        gaps = np.sqrt(np.take_along_axis(squares, self.near, axis=1)) * (1 - matrices.SLACK)
        neighbour = gaps <= 2 * radii[:, None]
        self.half = np.where(neighbour, gaps / 2, np.inf)
        self.still = ~(moved | (moved[self.near] & neighbour).any(axis=1)) if k > 1 else ~moved

    def nearest(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The nearest entry of every row of ``x``, which lies in the ball of entry ``own``."""
        found = own.copy()
        rows = np.flatnonzero(~self.still[own])
        ball = own[rows]
        best = matrices.square(x[rows], self.entries[ball])
        reach = np.sqrt(best) * (1 + matrices.SLACK)
        active = np.arange(len(rows))
        for ring in range(self.near.shape[1]):
            active = active[self.half[ball[active], ring] <= reach[active]]
            if not len(active):
                break
            other = self.near[ball[active], ring]
            square = matrices.square(x[rows[active]], self.entries[other])
            now = found[rows[active]]
            wins = (square < best[active]) | ((square == best[active]) & (other < now))
            best[active[wins]] = square[wins]
            found[rows[active[wins]]] = other[wins]
        return found


@dataclass
class Codebooks:
    """Entries (parts, entries, width) with the radii of their balls and whether they moved."""

    entries: np.ndarray
    radii: np.ndarray
    moved: np.ndarray

    @classmethod
    def start(cls, entries: np.ndarray) -> Codebooks:
        return cls(entries, np.full(entries.shape[:2], np.inf), np.ones(entries.shape[:2], bool))

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _part(x: np.ndarray, part: int, width: int) -> np.ndarray:
    return x[:, part * width : (part + 1) * width]


def encode(x: np.ndarray, code: np.ndarray, books: Codebooks) -> np.ndarray:
    """The code (n, parts) of the rows of ``x`` that had ``code`` before the entries moved."""
    width = books.entries.shape[2]
    columns = [
        Balls(books.entries[p], books.radii[p], books.moved[p]).nearest(_part(x, p, width), code[:, p]) for p in range(len(books.entries))
    ]
    return np.stack(columns, axis=1)


def errors(x: np.ndarray, code: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances (n, parts) of parts to their entries."""
    width = entries.shape[2]
    return np.stack([matrices.square(_part(x, p, width), entries[p][code[:, p]]) for p in range(len(entries))], axis=1)


def _bytes(code: np.ndarray) -> pa.Array:
    n, parts = code.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * parts).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(code, np.uint8).tobytes())])


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    first = column.offset * parts
    return np.frombuffer(column.buffers()[2], np.uint8)[first : first + len(column) * parts].reshape(-1, parts).astype(np.int64)


def _begin(settings: Settings) -> Callable[[pa.RecordBatch], tuple]:
    def read(batch: pa.RecordBatch) -> tuple:
        places, values = matrices.matrix(batch.column(2), settings.dims)
        at = pa.array(places)
        code = np.zeros((len(places), settings.parts), np.int64)
        return batch.column(0).take(at), batch.column(1).take(at), matrices.whole(values, settings.scale), code

    return read


def _resume(settings: Settings) -> Callable[[pa.RecordBatch], tuple]:
    def read(batch: pa.RecordBatch) -> tuple:
        x = matrices.whole_matrix(batch.column(2), settings.dims)
        return batch.column(0), batch.column(1), x, _codes(batch.column(3), settings.parts)

    return read


def _assign(read: Callable[[pa.RecordBatch], tuple], books: Codebooks, last: bool) -> Callable[[Batches], Batches]:
    def assign(batches: Batches) -> Batches:
        for batch in batches:
            ids, labels, x, code = read(batch)
            code = encode(x, code, books)
            values = pa.array(errors(x, code, books.entries).sum(axis=1)) if last else matrices.lists(x)
            yield pa.record_batch([ids, labels, values, _bytes(code)], names=["vec_id", "label", "error" if last else "v", "code"])

    return assign


def _sum(settings: Settings, entries: np.ndarray) -> Callable[[Batches], Batches]:
    """Rows, component sums and largest squared distance of every entry, over the rows of a task."""
    parts, k, width = entries.shape

    def add(batches: Batches) -> Batches:
        counts, sums, far = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            x, code = matrices.whole_matrix(batch.column(0), settings.dims), _codes(batch.column(1), parts)
            gaps = errors(x, code, entries)
            for p in range(parts):
                at, values = code[:, p], _part(x, p, width)
                counts[p] += np.bincount(at, minlength=k)
                for c in range(width):  # below 2 ** 53, so exact
                    sums[p, :, c] += np.bincount(at, weights=values[:, c], minlength=k).astype(np.int64)
                np.maximum.at(far[p], at, gaps[:, p])
        p, e = np.nonzero(counts)
        columns = [p.astype(np.int32), e.astype(np.int32), counts[p, e], far[p, e]]
        yield pa.record_batch(
            [*map(pa.array, columns), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], names=["part", "entry", "n", "far", "sums"]
        )

    return add


def _starts(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The parts of the vectors with the smallest ids: a top-k, bounded by the settings."""
    kept = vectors.where((F.size("embedding") == settings.dims) & matrices.usable(F.col("embedding")))
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(settings.entries).select("embedding").collect()
    x = matrices.whole(np.array([r.embedding for r in rows], np.float64).reshape(-1, settings.dims), settings.scale)
    return x.reshape(len(x), settings.parts, settings.width).transpose(1, 0, 2).copy()


def _moved(state: DataFrame, books: Codebooks, settings: Settings) -> Codebooks:
    """Entries at the floors of their parts' means; unused ones stay. A ball's radius grows by its entry's move."""
    schema = "part int, entry int, n long, far long, sums array<long>"
    partial = state.select("v", "code").mapInArrow(_sum(settings, books.entries), schema)
    totals = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.max("far").alias("far"), F.array(*[F.sum(F.col("sums")[i]) for i in range(settings.width)]).alias("sums")
    )
    entries, radii = books.entries.copy(), np.zeros(books.radii.shape)
    for row in totals.collect():  # at most one row an entry
        entries[row.part, row.entry] = matrices.floors(row.sums, row.n)
        radii[row.part, row.entry] = row.far**0.5
    drift = np.sqrt(((entries - books.entries) ** 2).sum(axis=2))
    return Codebooks(entries, (radii + drift) * (1 + matrices.SLACK), drift > 0)


@dataclass(frozen=True)
class Compressed:
    codes: DataFrame  # (vec_id, label, code binary, error)
    codebooks: Codebooks
    scale: float = Settings.scale

    def described(self) -> DataFrame:
        """(vec_id, code, error, label_error, codebooks_sha256): codes in hexadecimal.

        Errors are summed map-side by label; the sums meet the rows in a broadcast where they are measured to
        be few, else in a join whose skewed partitions adaptive execution splits.
        """
        sums = self.codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
        joined = self.codes.join(checked_broadcast(sums), F.col("label").eqNullSafe(F.col("of")))
        return joined.select(
            "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(self.codebooks.digest()).alias("codebooks_sha256")
        )

    def decoded(self) -> DataFrame:
        """(vec_id, label, embedding): the vectors that the codes stand for."""
        entries, scale = self.codebooks.entries, self.scale
        parts, _, width = entries.shape

        def decode(batches: Batches) -> Batches:
            for batch in batches:
                code = _codes(batch.column(2), parts)
                x = np.concatenate([entries[p][code[:, p]] for p in range(parts)], axis=1) / scale
                n, dims = x.shape
                values = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dims), pa.array(x.ravel()))
                yield pa.record_batch([batch.column(0), batch.column(1), values], names=["vec_id", "label", "embedding"])

        return self.codes.select("vec_id", "label", "code").mapInArrow(decode, "vec_id long, label string, embedding array<double>")


def compress(vectors: DataFrame, settings: Settings = Settings()) -> Compressed:
    """Code ``vectors`` (vec_id, embedding, label); the state is rewritten once a round and then removed."""
    raw = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    schema = "vec_id long, label string, error long, code binary"
    books = Codebooks.start(_starts(raw, settings))
    if not books.entries.size:
        return Compressed(vectors.sparkSession.createDataFrame([], schema), books, settings.scale)
    source, read = spread(raw), _begin(settings)
    for turn in range(settings.rounds):
        state = keep(source.mapInArrow(_assign(read, books, False), STATE), "codes")
        if turn:
            remove(source)
        books = _moved(state, books, settings)
        source, read = state, _resume(settings)
    codes = keep(source.mapInArrow(_assign(read, books, True), schema), "codes")
    if settings.rounds:
        remove(source)
    return Compressed(codes, books, settings.scale)
