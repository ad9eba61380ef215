"""One row per feature: values by sample in arrays, so that every step within a feature is narrow.

``gather`` makes (feature, raw), where ``raw`` holds one inner array per input row of the feature, over the
samples in a given order. A table without repeated features is not shuffled for that; otherwise rows
meet in one exchange. Features with more rows than a bound are split off first and stay in long form,
with the operators of the other modules. What is known of a sample (plex, group, median) is one short array over
the samples, in tasks as on the driver; the wide input has as many columns.

Inside tasks, features with equally many rows form a cube (features, rows, samples), with NaN for NULL; a
NaN in the input reads as missing.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from plexlake.functions.scalars import quoted
from plexlake.operators.batch import combat_prior, posterior
from plexlake.plans.sizing import broadcast_if

MOST_ROWS = 1_000  # rows of one feature that are gathered
Batches = Iterator[pa.RecordBatch]
_CELLS = ArrayType(DoubleType())
_ROWS = ArrayType(_CELLS)


# --- in and out ------------------------------------------------------------------------


def _number(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def gather(
    wide: DataFrame, samples: Sequence[str], change: Callable[[Column], Column] = _number, feature: str = "protein_group", most_rows: int | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(feature, raw) of all features with at most ``most_rows`` (``MOST_ROWS``) rows, and the wide rows of the others, if any.

    ``change`` is applied to every value. There are at most rows / ``most_rows`` features of the second kind.
    """
    most_rows = MOST_ROWS if most_rows is None else most_rows
    values = F.array(*[F.col(quoted(s)).cast("double") for s in samples])
    rows = wide.select(feature, F.transform(values, lambda x: _number(change(x))).alias("raw"))
    counts = wide.groupBy(feature).agg(F.count(F.lit(1)).alias("n"))
    size = counts.agg(F.max("n").alias("most"), F.count_if(F.col("n") > most_rows).alias("hot")).first()
    if (size["most"] or 0) <= 1:
        return rows.select(feature, F.array("raw").alias("raw")), None
    hot = None
    if size["hot"]:
        names = broadcast_if(counts.where(F.col("n") > most_rows).select(feature), size["hot"])
        hot = wide.join(names, feature, "left_semi")
        rows = rows.join(names, feature, "left_anti")
    return rows.groupBy(feature).agg(F.collect_list("raw").alias("raw")), hot


def from_cells(cell_table: DataFrame, samples: Sequence[str], value: str, feature: str = "protein_group") -> DataFrame:
    """(feature, c) of a long table with one row per cell; samples that a feature lacks are NULL."""
    place = F.map_from_arrays(F.array(*[F.lit(s) for s in samples]), F.array(*[F.lit(i) for i in range(len(samples))]))
    entry = F.struct(F.try_element_at(place, F.col("sample_name")).alias("i"), _number(F.col(value).cast("double")).alias("v"))
    found = cell_table.where(F.col("sample_name").isin(list(samples))).groupBy(feature).agg(F.collect_list(entry).alias("_e"))
    schema = StructType([found.schema[feature], StructField("c", _CELLS)])
    n = len(samples)

    def lay(batches: Batches) -> Batches:
        for batch in batches:
            entries, counts = batch.column(1).flatten(), batch.column(1).value_lengths().to_numpy()
            x = np.full((len(counts), n), np.nan)
            at = np.repeat(np.arange(len(counts)), counts), entries.field(0).to_numpy()
            if len(np.unique(at[0] * n + at[1])) < len(at[0]):
                raise ValueError("a feature has several rows for one sample; take cells first")
            x[at] = entries.field(1).to_numpy(zero_copy_only=False)
            yield pa.record_batch([batch.column(0), cells_column(x)], names=[feature, "c"])

    return found.mapInArrow(lay, schema)


def to_long(table: DataFrame, samples: Sequence[str], values: dict[str, str], feature: str = "protein_group") -> DataFrame:
    """One row per input row and sample: (feature, sample_name, ...), ``values`` naming array columns and their new names.

    Narrow. Columns are arrays of rows.
    """
    row = table.select(feature, F.explode(F.arrays_zip(*values)).alias("_r"))
    names = F.array(*[F.lit(s) for s in samples])
    zipped = F.arrays_zip(names.alias("sample_name"), *[F.col(f"_r.{c}").alias(name) for c, name in values.items()])
    return row.select(feature, F.inline(zipped)).toDF(feature, "sample_name", *values.values())


def cells_to_long(table: DataFrame, samples: Sequence[str], value: str, feature: str = "protein_group") -> DataFrame:
    """(feature, sample_name, value) of a (feature, c) table."""
    return to_long(table.select(feature, F.array("c").alias("c")), samples, {"c": value}, feature)


def matrix(table: DataFrame, samples: Sequence[str], feature: str = "protein_group") -> DataFrame:
    """One column per sample. Narrow: no pivot."""
    return table.select(feature, *[F.col("c")[i].alias(s) for i, s in enumerate(samples)])


def cells_column(x: np.ndarray) -> pa.Array:
    n, width = x.shape
    flat = np.ascontiguousarray(x).ravel()
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(flat, mask=np.isnan(flat)))


def cells_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


@dataclass
class Block:
    """The features of an Arrow batch: all rows, and where those of each feature are."""

    x: np.ndarray
    counts: np.ndarray

    @classmethod
    def read(cls, column: pa.Array, width: int) -> Block:
        return cls(cells_matrix(column.flatten(), width).copy(), column.value_lengths().to_numpy().astype(np.int64))

    def cubes(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(features, rows, cube) of the features with equally many rows."""
        first = np.cumsum(self.counts) - self.counts
        for r in np.unique(self.counts):
            which = np.flatnonzero(self.counts == r)
            rows = first[which][:, None] + np.arange(r)
            yield which, rows, self.x[rows]

    def column(self) -> pa.Array:
        return self.column_of(self.x)

    def column_of(self, x: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), cells_column(x))

    def chosen(self, keep: np.ndarray) -> Block:
        return Block(self.x[np.repeat(keep, self.counts)], self.counts[keep])


def _schema(table: DataFrame, feature: str, *columns: str) -> StructType:
    return StructType([table.schema[feature], *[StructField(c, _ROWS) for c in columns]])


def _nan(function: Callable[..., np.ndarray], *args, **kwargs) -> np.ndarray:
    """Reductions that ignore NaN, silent where nothing is left."""
    with np.errstate(all="ignore"), warnings.catch_warnings():
        warnings.simplefilter("ignore", RuntimeWarning)
        return function(*args, **kwargs)


# --- normalisation and missing values -----------------------------------------------------


def normalise(
    table: DataFrame, width: int, places: Sequence[int], shift: np.ndarray, max_missing: float, groups: Sequence | None = None, feature: str = "protein_group"
) -> DataFrame:
    """(feature, raw, v): the samples at ``places``, ``v = raw + shift``, features with too many missing values left out.

    The share is over all rows and samples of the feature. With ``groups`` (one per sample) a missing value becomes
    the median of its feature in its group.
    """
    places, shift = np.asarray(places, np.int64), np.asarray(shift, float)
    labels = None if groups is None else [np.flatnonzero([g == h for g in groups]) for h in dict.fromkeys(groups)]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            raw = Block.read(batch.column(1), width)
            raw = Block(raw.x[:, places], raw.counts)
            first = np.cumsum(raw.counts) - raw.counts
            if not len(first):
                continue
            gaps = np.add.reduceat(np.isnan(raw.x + shift).sum(axis=1), first)
            keep = gaps / (raw.counts * max(1, len(places))) <= max_missing
            raw = raw.chosen(keep)
            v = raw.x + shift
            if labels is not None:
                for _, rows, cube in Block(v, raw.counts).cubes():
                    for at in labels:
                        part = cube[:, :, at]
                        fill = _nan(np.nanmedian, part.reshape(len(part), -1), axis=1)
                        cube[:, :, at] = np.where(np.isnan(part), fill[:, None, None], part)
                    v[rows] = cube
            yield pa.record_batch([batch.column(0).filter(pa.array(keep)), raw.column(), raw.column_of(v)], names=[feature, "raw", "v"])

    return table.select(feature, "raw").mapInArrow(run, _schema(table, feature, "raw", "v"))


def _with(table: DataFrame, name: str, width: int, change: Callable[[np.ndarray], np.ndarray], of: str, feature: str) -> DataFrame:
    """Add (or replace) array column ``name``: ``change`` of the cubes of ``of``."""
    others = [c for c in table.columns if c not in (feature, name)]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            block = Block.read(batch.column(batch.schema.get_field_index(of)), width)
            for _, rows, cube in block.cubes():
                block.x[rows] = change(cube)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in (feature, *others)]
            yield pa.record_batch([*kept, block.column()], names=[feature, *others, name])

    return table.mapInArrow(run, _schema(table, feature, *others, name))


def filled(table: DataFrame, width: int, floors: np.ndarray, feature: str = "protein_group") -> DataFrame:
    """Missing values of ``v`` replaced by one value per sample."""
    return _with(table, "v", width, lambda x: np.where(np.isnan(x), floors, x), "v", feature)


def shifted(table: DataFrame, width: int, shift: np.ndarray, column: str = "u", feature: str = "protein_group") -> DataFrame:
    return _with(table, column, width, lambda x: x + shift, column, feature)


def pool_reference(table: DataFrame, plexes: Sequence, pools: Sequence[bool], feature: str = "protein_group") -> DataFrame:
    """Add ``u``: internal-reference scaling as in :func:`plexlake.operators.batch.pool_reference`."""
    pools = np.asarray(pools, bool)
    members = [np.flatnonzero([p == q for p in plexes]) for q in dict.fromkeys(plexes)]

    def change(x: np.ndarray) -> np.ndarray:
        flat = [x[:, :, at[pools[at]]].reshape(len(x), -1) for at in members]
        means = np.stack([_nan(np.nanmean, f, axis=1) if f.shape[1] else np.full(len(x), np.nan) for f in flat], axis=1)
        move = _nan(np.nanmean, means, axis=1)[:, None] - means
        out = x.copy()
        for k, at in enumerate(members):
            out[:, :, at] += move[:, k, None, None]
        return out

    return _with(table, "u", len(plexes), change, "v", feature)


# --- empirical-Bayes batch correction -----------------------------------------------------


@dataclass(frozen=True)
class _Sites:
    """Sufficient statistics of features: arrays (features, batches)."""

    n: np.ndarray
    grand: np.ndarray
    pooled: np.ndarray
    g_hat: np.ndarray
    d_hat: np.ndarray


def _sites(x: np.ndarray, members: Sequence[np.ndarray], gaps: bool) -> _Sites:
    """``gaps``: whether any value at all is missing, which takes one from the divisor of the pooled variance."""
    parts = [x[:, :, at].reshape(len(x), -1) for at in members]
    n = np.stack([(~np.isnan(p)).sum(axis=1) for p in parts], axis=1)
    m = np.stack([_nan(np.nanmean, p, axis=1) for p in parts], axis=1)
    ss = np.stack([np.nansum((p - m[:, [k]]) ** 2, axis=1) for k, p in enumerate(parts)], axis=1)
    sizes = np.array([len(at) for at in members], float)
    with np.errstate(all="ignore"):
        grand = np.nansum(sizes * m, axis=1) / sizes.sum()
        pooled = ss.sum(axis=1) / (n.sum(axis=1) - gaps)
        usable = (np.where(n > 0, ss, np.inf).min(axis=1) > 0) & (n.min(axis=1) > 1)
        g_hat = np.where(usable[:, None], (m - grand[:, None]) / np.sqrt(pooled)[:, None], np.nan)
        d_hat = np.where(usable[:, None], ss / (n - 1) / pooled[:, None], np.nan)
    return _Sites(n, grand, pooled, g_hat, d_hat)


def any_missing(table: DataFrame, column: str = "v") -> bool:
    return table.where(F.exists(column, lambda row: F.exists(row, lambda x: x.isNull()))).limit(1).count() > 0


def combat(
    table: DataFrame, batches: Sequence, feature: str = "protein_group", more: DataFrame | None = None, gaps: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """Add ``u``: batch correction as in :func:`plexlake.operators.batch.combat`, and return it with the priors.

    ``batches`` has one label per sample, none of them missing. Two narrow passes with one small aggregate between them.
    ``more`` are statistics (batch, g_hat, d_hat) of features kept in long form, which share the priors; ``gaps`` says
    whether any value of either is missing.
    """
    names = sorted(set(batches))
    members = [np.flatnonzero([b == q for b in batches]) for q in names]
    width = len(batches)
    gaps = any_missing(table) if gaps is None else gaps

    def sites(found: Batches) -> Batches:
        for batch in found:
            for _, _, cube in Block.read(batch.column(0), width).cubes():
                s = _sites(cube, members, gaps)
                labels = np.tile(np.array(names, object), len(cube))
                columns = [pa.array(c.ravel(), mask=np.isnan(c.ravel())) for c in (s.g_hat, s.d_hat)]
                yield pa.record_batch([pa.array(labels, pa.string()), *columns], names=["batch", "g_hat", "d_hat"])

    per_batch = table.select("v").mapInArrow(sites, "batch string, g_hat double, d_hat double")
    if more is not None:
        per_batch = per_batch.unionByName(more.select("batch", "g_hat", "d_hat"))
    prior = combat_prior(per_batch)
    found = {r["batch"]: r for r in prior.collect()}  # one row per batch
    numbers = np.array([[found[b][c] if b in found and found[b][c] is not None else np.nan for b in names] for c in ("g_bar", "t2", "a", "b")])

    def change(x: np.ndarray) -> np.ndarray:
        s = _sites(x, members, gaps)
        wide = [np.broadcast_to(row, s.n.shape).ravel() for row in numbers]
        g, d = (p.reshape(s.n.shape) for p in posterior(s.n.ravel().astype(float), s.g_hat.ravel(), s.d_hat.ravel(), *wide))
        spread, out = np.sqrt(s.pooled)[:, None, None], x.copy()
        for k, at in enumerate(members):
            part, grand = x[:, :, at], s.grand[:, None, None]
            with np.errstate(all="ignore"):
                moved = ((part - grand) / spread - g[:, k, None, None]) / np.sqrt(d[:, k, None, None]) * spread + grand
            out[:, :, at] = np.where(np.isnan(d[:, k, None, None]), part, moved)
        return out

    return _with(table, "u", width, change, "v", feature), prior


def restricted(table: DataFrame, width: int, places: Sequence[int], feature: str = "protein_group") -> DataFrame:
    """Only the samples at ``places``, in that order."""
    if list(places) == list(range(width)):
        return table
    at = F.array(*[F.lit(int(p)) for p in places])
    cut = lambda c: F.transform(c, lambda row: F.transform(at, lambda p: F.get(row, p))).alias(c)
    return table.select(feature, *[cut(c) for c in table.columns if c != feature])


# --- cells, model, z-scores -------------------------------------------------------------------


def cells(table: DataFrame, width: int, column: str, feature: str = "protein_group") -> DataFrame:
    """(feature, c): medians over the rows of a feature, NULL where any row is."""
    schema = StructType([table.schema[feature], StructField("c", _CELLS)])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            block = Block.read(batch.column(1), width)
            out = np.zeros((len(block.counts), width))
            for which, _, cube in block.cubes():
                out[which] = cube[:, 0] if cube.shape[1] == 1 else np.median(cube, axis=1)
            yield pa.record_batch([batch.column(0), cells_column(out)], names=[feature, "c"])

    return table.select(feature, column).mapInArrow(run, schema)


def fit_groups(table: DataFrame, groups: Sequence[str | None], feature: str = "protein_group") -> DataFrame:
    """The columns of :func:`plexlake.operators.model.fit_groups` from (feature, c). Narrow.

    ``groups`` has one name per sample, None for samples that are not fitted.
    """
    names = sorted({g for g in groups if g is not None})
    members = [np.flatnonzero([g == name for g in groups]) for name in names]
    width = len(groups)
    schema = StructType([table.schema[feature]]).add("n_obs", "long").add("df", "long").add("sigma2", "double")
    schema = schema.add("ave_expr", "double").add("_n", ArrayType(LongType())).add("_mean", _CELLS)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = cells_matrix(batch.column(1), width)
            parts = [x[:, at] for at in members]
            n = np.stack([(~np.isnan(p)).sum(axis=1) for p in parts], axis=1) if parts else np.zeros((len(x), 0), np.int64)
            some = n.sum(axis=1) > 0
            n = n[some]
            parts = [p[some] for p in parts]
            if not len(n):
                continue
            mean = np.stack([_nan(np.nanmean, p, axis=1) for p in parts], axis=1)
            ss = np.stack([np.nansum((p - mean[:, [k]]) ** 2, axis=1) for k, p in enumerate(parts)], axis=1).sum(axis=1)
            total, df = n.sum(axis=1), n.sum(axis=1) - (n > 0).sum(axis=1)
            with np.errstate(all="ignore"):
                sigma2 = np.where(df > 0, ss / df, np.nan)
            ave = np.nansum(n * mean, axis=1) / total
            counts = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * n.shape[1]), pa.array(n.ravel().astype(np.int64)))
            yield pa.record_batch(
                [batch.column(0).filter(pa.array(some)), pa.array(total), pa.array(df), pa.array(sigma2, mask=np.isnan(sigma2)), pa.array(ave), counts,
                 cells_column(mean)],
                names=schema.names,
            )

    fitted = table.select(feature, "c").mapInArrow(run, schema)
    zipped = F.arrays_zip(F.array(*[F.lit(g) for g in names]).alias("g"), F.col("_n").alias("n"), F.col("_mean").alias("mean"))
    entries = F.transform(F.filter(zipped, lambda z: z["n"] > 0), lambda z: F.struct(z["g"], F.struct(z["n"].alias("n"), z["mean"].alias("mean"))))
    return fitted.withColumn("groups", F.map_from_entries(entries)).drop("_n", "_mean")


def standardise(table: DataFrame, width: int, complete: bool = True, feature: str = "protein_group") -> DataFrame:
    """(feature, c): z-scores. ``complete``: features with a gap or without variance go; else gaps stay and constant rows are NULL."""
    schema = StructType([table.schema[feature], StructField("c", _CELLS)])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            z = z_scores(cells_matrix(batch.column(1), width))
            keep = ~np.isnan(z).any(axis=1) if complete else np.ones(len(z), bool)
            yield pa.record_batch([batch.column(0).filter(pa.array(keep)), cells_column(z[keep])], names=[feature, "c"])

    return table.select(feature, "c").mapInArrow(run, schema)


def z_scores(x: np.ndarray) -> np.ndarray:
    """Rows centred and scaled over what they hold; NaN where there is no variance."""
    if not x.size:
        return x
    mean = _nan(np.nanmean, x, axis=1, keepdims=True)
    sd = _nan(np.nanstd, x, axis=1, keepdims=True, ddof=1)
    with np.errstate(all="ignore"):
        return np.where(sd > 0, (x - mean) / sd, np.nan)
