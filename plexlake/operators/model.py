"""Per-feature linear model on groups, contrasts, and moderated statistics.

With one indicator per group the least-squares fit is the group means, so the whole
model is two keyed aggregates. The fitted table has one row per feature; contrasts are a small table that
features meet in a broadcast join, so no feature moves.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from plexlake.functions.quantiles import exact_median, exact_quantiles
from plexlake.functions.scalars import quoted, syntactic_name
from plexlake.functions.special import (
    digamma,
    digamma_value,
    f_pvalue,
    t_pvalue,
    t_quantile,
    trigamma,
    trigamma_inverse,
)
from plexlake.operators.arrays import cells_matrix
from plexlake.plans.session import materialise
from plexlake.plans.sizing import BROADCAST_BYTES, BROADCAST_ROWS, LARGE_GROUP_ROWS, broadcast_if

Contrasts = Mapping[str, Mapping[str, float]]

# Fixed values of the published method.
_VARIANCE_FLOOR = 1e-5
_RANK_TOLERANCE = 1e-8
_PROPORTION = 0.01
_STDEV_LIMITS = (0.1, 4.0)

_MAX_GROUPS = 5_000
CONTRAST_BLOCK = 1_000  # contrasts that a feature meets in one row
_CHUNK_NUMBERS = 1 << 22  # numbers of contrasts x features worked on at once


# --- contrasts -------------------------------------------------------------------------


def group_names(meta: DataFrame) -> list[str]:
    """Syntactic names of the experimental groups (bounded by the number of samples)."""
    rows = meta.select(syntactic_name(F.col("exp_group")).alias("g")).distinct().limit(_MAX_GROUPS + 1).collect()
    if len(rows) > _MAX_GROUPS:
        raise ValueError(f"more than {_MAX_GROUPS} groups")
    return sorted(r["g"] for r in rows)


def group_sizes(meta: DataFrame) -> dict[str, int]:
    """Samples per experimental group."""
    names = group_names(meta)
    rows = meta.groupBy(syntactic_name(F.col("exp_group")).alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["g"]: r["n"] for r in rows}
    return {g: sizes[g] for g in names}


def pairwise_contrasts(groups: Sequence[str]) -> dict[str, dict[str, float]]:
    """``a_vs_b`` for every unordered pair."""
    return {f"{a}_vs_{b}": {a: 1.0, b: -1.0} for a, b in combinations(sorted(groups), 2)}


def versus_rest(group: str, groups: Sequence[str], name: str | None = None) -> dict[str, dict[str, float]]:
    """One group against the mean of all others."""
    rest = [g for g in groups if g != group]
    return {name or f"{group} vs. rest": {group: 1.0, **{g: -1.0 / len(rest) for g in rest}}}


def reverse_contrasts(contrasts: Contrasts, names: Sequence[str], sep: str = "_vs_") -> dict[str, dict[str, float]]:
    """Negate the named contrasts and swap the two sides of their names; order is kept."""
    unknown = set(names) - set(contrasts)
    if unknown:
        raise ValueError(f"no such contrast: {sorted(unknown)}")
    result = {}
    for name, weights in contrasts.items():
        if name in names:
            left, right = name.split(sep, 1)
            result[f"{right}{sep}{left}"] = {g: -w for g, w in weights.items()}
        else:
            result[name] = dict(weights)
    return result


def check_contrasts(contrasts: Contrasts, groups: Sequence[str]) -> None:
    for name, weights in contrasts.items():
        unknown = set(weights) - set(groups)
        if unknown:
            raise ValueError(f"contrast {name!r} names unknown groups {sorted(unknown)}")


def contrast_table(spark: SparkSession, contrasts: Contrasts) -> DataFrame:
    rows = [(c, g, float(w)) for c, weights in contrasts.items() for g, w in weights.items()]
    return spark.createDataFrame(rows, "contrast string, exp_group string, weight double")


def pairwise_table(spark: SparkSession, groups: Sequence[str]) -> DataFrame:
    """(contrast, exp_group, weight) of ``a_vs_b`` for every unordered pair, made from one row of names without a join."""
    names = F.posexplode(F.col("names")).alias("i", "a")
    one = spark.createDataFrame([(sorted(groups),)], "names array<string>")
    later = F.slice("names", F.col("i") + 2, F.size("names"))
    pairs = one.select("names", names).select("a", F.explode(later).alias("b"))
    sides = F.array(*[F.struct(F.col(g).alias("exp_group"), F.lit(w).alias("weight")) for g, w in (("a", 1.0), ("b", -1.0))])
    return pairs.select(F.concat_ws("_vs_", "a", "b").alias("contrast"), F.inline(sides))


def reverse_table(table: DataFrame, names: Sequence[str], sep: str = "_vs_") -> DataFrame:
    """The named contrasts of a table negated, the sides of their names swapped."""
    if not names:
        return table
    found = {r["contrast"] for r in table.where(F.col("contrast").isin(list(names))).select("contrast").distinct().collect()}
    if set(names) - found:
        raise ValueError(f"no such contrast: {sorted(set(names) - found)}")
    turned, at = F.col("contrast").isin(list(names)), F.locate(sep, F.col("contrast"))
    swapped = F.concat(F.substr("contrast", at + len(sep)), F.lit(sep), F.substr("contrast", F.lit(1), at - 1))
    return table.select(
        F.when(turned, swapped).otherwise(F.col("contrast")).alias("contrast"), "exp_group",
        F.when(turned, -F.col("weight")).otherwise(F.col("weight")).alias("weight"),
    )


def check_contrast_table(table: DataFrame, groups: Sequence[str]) -> None:
    wrong = table.where(~F.col("exp_group").isin(list(groups)) | F.col("exp_group").isNull()).limit(5).collect()
    if wrong:
        raise ValueError(f"contrasts name unknown groups {sorted({str(r['exp_group']) for r in wrong})}")


# --- fit -------------------------------------------------------------------------------


def group_means(long: DataFrame, value: str, feature: str = "protein_group") -> DataFrame:
    """(feature, exp_group, n, mean, ss); partial sums are combined before the shuffle."""
    v = F.col(value)
    return (
        long.where(v.isNotNull())
        .groupBy(feature, syntactic_name(F.col("exp_group")).alias("exp_group"))
        .agg(F.count(v).alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("ss"))
    )


def fit_groups(long: DataFrame, value: str, feature: str = "protein_group") -> DataFrame:
    """(feature, n_obs, df, sigma2, ave_expr, groups map<group, (n, mean)>)."""
    per_group = group_means(long, value, feature)
    entries = F.map_from_entries(F.collect_list(F.struct("exp_group", F.struct("n", "mean"))))
    total = F.sum("n")
    df = total - F.count(F.lit(1))
    return per_group.groupBy(feature).agg(
        total.alias("n_obs"),
        df.alias("df"),
        F.when(df > 0, F.sum("ss") / df).alias("sigma2"),
        (F.sum(F.col("n") * F.col("mean")) / total).alias("ave_expr"),
        entries.alias("groups"),
    )


def _by_place(names: Sequence[str], part: str) -> Column:
    """An array over ``names`` of what the fit holds of each group, NULL where it was not observed."""
    return F.transform(F.array(*[F.lit(g) for g in names]), lambda g: F.try_element_at("groups", g)[part].cast("double"))


def apply_contrasts(fit: DataFrame, contrasts: Contrasts | DataFrame, block: int = CONTRAST_BLOCK) -> DataFrame:
    """One row per feature and contrast: the fit with (contrast, log_fc, unscaled).

    Contrasts are a table (contrast, exp_group, weight). Its contrasts are gathered in blocks of about ``block``, and
    every feature meets every block in a broadcast join on the block's number; a table beyond the broadcast
    bounds is taken in pieces below them, one join each. Fold change and unscaled variance are NULL where a
    group with a weight was not observed.
    """
    spark = fit.sparkSession
    table = contrasts if isinstance(contrasts, DataFrame) else contrast_table(spark, contrasts)
    weighted = table.where("weight <> 0")
    names = sorted(r["exp_group"] for r in weighted.select("exp_group").distinct().collect())  # groups, at most
    place = F.map_from_arrays(F.array(*[F.lit(g) for g in names]), F.array(*[F.lit(i) for i in range(len(names))]))
    term = F.struct(F.try_element_at(place, F.col("exp_group")).alias("g"), F.col("weight").alias("w"))
    terms = weighted.groupBy("contrast").agg(F.sort_array(F.collect_list(term)).alias("terms")) if names else None
    keep = [c for c in fit.columns if c != "groups"]
    if terms is None:
        return spark.createDataFrame([], fit.select(*keep).schema.add("contrast", "string").add("log_fc", "double").add("unscaled", "double"))
    terms = materialise(terms, "contrast_terms")
    size = terms.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("terms")).alias("terms"), F.sum(F.octet_length("contrast")).alias("text")).first()
    pieces = max(-(-size["n"] // BROADCAST_ROWS), -(-(24 * size["terms"] + size["text"] + 64 * size["n"]) // BROADCAST_BYTES))
    blocks = -(-size["n"] // (block * pieces))  # of a piece
    bucket = F.pmod(F.xxhash64("contrast"), F.lit(pieces * blocks)).cast("int")
    placed = terms.groupBy(bucket.alias("_at")).agg(F.collect_list(F.struct("contrast", "terms")).alias("_c"))
    features = fit.select(*keep, _by_place(names, "mean").alias("_mean"), _by_place(names, "n").alias("_n"))

    def total(t: Column, part: Callable[[Column, Column, Column], Column]) -> Column:
        return F.aggregate(t, F.lit(0.0), lambda sum_, x: sum_ + part(x["w"], F.get("_mean", x["g"]), F.get("_n", x["g"])))

    rows = F.transform(
        "_c",
        lambda c: F.struct(
            c["contrast"].alias("contrast"),
            total(c["terms"], lambda w, mean, n: w * mean).alias("log_fc"),
            total(c["terms"], lambda w, mean, n: w * w / n).alias("unscaled"),
        ),
    )

    def piece(k: int) -> DataFrame:
        mine = F.broadcast(placed.where((F.col("_at") >= k * blocks) & (F.col("_at") < (k + 1) * blocks)))
        spread = features.withColumn("_at", F.explode(F.sequence(F.lit(k * blocks), F.lit((k + 1) * blocks - 1))))
        return spread.join(mine, "_at").select(*keep, F.inline(rows))

    return reduce(DataFrame.unionByName, [piece(k) for k in range(pieces)])


def ordinary_t(coefficients: DataFrame) -> DataFrame:
    """Unmoderated t and p per feature and contrast."""
    t = F.col("log_fc") / F.sqrt(F.col("unscaled") * F.nullif(F.col("sigma2"), F.lit(0.0)))
    return coefficients.withColumn("t", t).withColumn("p_value", t_pvalue(F.col("t"), F.col("df").cast("double")))


# --- moderation ------------------------------------------------------------------------


@dataclass(frozen=True)
class VariancePrior:
    """Scaled inverse chi-square prior of the residual variances, and what it was fitted on."""

    df0: float
    s02: float
    df_pooled: float
    n_features: int
    n_rows: int = 0  # of the whole fit, features without residual degrees of freedom too

    @property
    def most_rows(self) -> int:
        """Bound on the rows of one contrast."""
        return max(self.n_rows, self.n_features)


def variance_prior(fit: DataFrame) -> VariancePrior:
    """Moments of log variances (Smyth 2004): two passes of plain aggregates, five numbers back."""
    usable = fit.where("df > 0 and sigma2 is not null").select("df", "sigma2")
    # counting a materialised fit reads file footers only
    n_rows = fit.count()
    row = exact_median(usable, [], "sigma2", "m", 1, n_rows).first()
    if row is None or row["m"] is None:
        raise ValueError("no feature has residual degrees of freedom")
    floor = _VARIANCE_FLOOR * row["m"]
    half = F.col("df") / 2.0
    e = F.log(F.greatest("sigma2", F.lit(floor))) - digamma(half) + F.log(half)
    s = usable.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(e).alias("mean"),
        F.var_samp(e).alias("var"),
        F.avg(trigamma(half)).alias("trigamma"),
        F.sum("df").alias("df"),
    ).first()
    excess = (s["var"] or 0.0) - s["trigamma"]
    if excess <= 0:
        return VariancePrior(math.inf, math.exp(s["mean"]), float(s["df"]), s["n"], n_rows)
    df0 = 2 * trigamma_inverse(excess)
    s02 = math.exp(s["mean"] + digamma_value(df0 / 2) - math.log(df0 / 2))
    return VariancePrior(df0, s02, float(s["df"]), s["n"], n_rows)


def posterior_variance(prior: VariancePrior) -> Column:
    if math.isinf(prior.df0):
        return F.lit(prior.s02)
    own = F.when(F.col("df") > 0, F.col("df") * F.col("sigma2")).otherwise(0.0)
    return (F.lit(prior.df0 * prior.s02) + own) / (F.lit(prior.df0) + F.col("df"))


def total_df(prior: VariancePrior) -> Column:
    if math.isinf(prior.df0):
        return F.lit(prior.df_pooled)
    return F.least(F.col("df") + F.lit(prior.df0), F.lit(prior.df_pooled))


def moderate(coefficients: DataFrame, prior: VariancePrior) -> DataFrame:
    """Add ``s2_post``, ``df_total`` and, to rows of contrasts, ``t``. Narrow."""
    out = coefficients.withColumns({"s2_post": posterior_variance(prior), "df_total": total_df(prior)})
    if "log_fc" not in coefficients.columns:
        return out
    return out.withColumn("t", F.col("log_fc") / F.sqrt(F.col("unscaled") * F.col("s2_post")))


def moderated_t(moderated: DataFrame) -> DataFrame:
    """(feature, ..., contrast, log_fc, t, p_value)."""
    return moderated.withColumn("p_value", t_pvalue(F.col("t"), F.col("df_total")))


# --- F over all contrasts --------------------------------------------------------------


@dataclass(frozen=True)
class GroupSpace:
    """What F needs of the contrasts, in numbers per group: no table of contrasts by contrasts.

    Scaled to unit variance of each contrast, the contrasts x groups matrix A has as many independent
    directions as its groups x groups product; those with a share of the largest above a tolerance are kept.
    """

    names: list[str]
    sizes: np.ndarray
    places: np.ndarray  # (contrasts, terms): groups of a contrast, filled up with weights of 0
    weights: np.ndarray
    scaled: np.ndarray  # A at the same places
    axes: np.ndarray  # (groups, rank)
    strengths: np.ndarray  # of the axes

    @property
    def rank(self) -> int:
        return len(self.strengths)

    @property
    def used(self) -> np.ndarray:
        return np.isin(np.arange(len(self.names)), self.places[self.weights != 0])

    @classmethod
    def of(cls, contrasts: Contrasts, group_sizes: Mapping[str, int]) -> GroupSpace:
        names = sorted(group_sizes)
        at, sizes = {g: i for i, g in enumerate(names)}, np.array([group_sizes[g] for g in names], float)
        rows = [[(at[g], float(w)) for g, w in weights.items() if w] for weights in contrasts.values()]
        width = max((len(r) for r in rows), default=0)
        padded = [r + [(0, 0.0)] * (width - len(r)) for r in rows]
        places = np.array([[g for g, _ in r] for r in padded], np.int64).reshape(len(rows), width)
        weights = np.array([[w for _, w in r] for r in padded], float).reshape(len(rows), width)
        sd = np.sqrt((weights**2 / sizes[places]).sum(axis=1))
        scaled = weights / np.sqrt(sizes[places]) / sd[:, None]
        product = np.zeros((len(names), len(names)))
        for k in range(width):
            for m in range(width):
                np.add.at(product, (places[:, k], places[:, m]), scaled[:, k] * scaled[:, m])
        values, axes = np.linalg.eigh(product)
        keep = values > _RANK_TOLERANCE * values.max()
        return cls(names, sizes, places, weights, scaled, axes[:, keep], values[keep])

    def f(self, mean: np.ndarray, n: np.ndarray, s2: np.ndarray) -> np.ndarray:
        """F of features; NaN where a group in use was not observed. Means and counts are (features, groups)."""
        used, out = self.used, np.full(len(mean), np.nan)
        mean = np.where(used, mean, 0.0)
        whole = (n[:, used] == self.sizes[used]).all(axis=1)
        along = (mean[whole] * np.sqrt(self.sizes)) @ self.axes
        out[whole] = (along**2).sum(axis=1) / s2[whole] / self.rank
        # where measurements are missing, contrasts have variances of their own: t of each, and back to groups
        part = np.flatnonzero(~whole & ~np.isnan(mean).any(axis=1))
        order = np.argsort(self.places.ravel(), kind="stable")
        groups, first = np.unique(self.places.ravel()[order], return_index=True)
        contrast = order // self.places.shape[1] if self.places.size else order
        step = max(1, _CHUNK_NUMBERS // max(1, self.places.size))
        for at in range(0, len(part), step):
            rows = part[at : at + step]
            m, c = mean[rows][:, self.places], n[rows][:, self.places]
            with np.errstate(all="ignore"):
                unscaled = np.where(self.weights != 0, self.weights**2 / c, 0.0).sum(axis=2)
            t = (m * self.weights).sum(axis=2) / np.sqrt(unscaled * s2[rows][:, None])
            back = np.zeros((len(rows), len(self.names)))
            back[:, groups] = np.add.reduceat(t[:, contrast] * self.scaled.ravel()[order], first, axis=1)
            out[rows] = ((back @ self.axes / self.strengths) ** 2).sum(axis=1) / self.rank
        return out


def f_statistics(
    fit: DataFrame, contrasts: Contrasts, group_sizes: Mapping[str, int], prior: VariancePrior, fold_changes: bool = True
) -> DataFrame:
    """One row per feature: a log fold change per contrast (if asked), ave_expr, F and its p-value. Narrow.

    ``fold_changes`` makes a column per contrast; with very many contrasts the table of contrasts has them as rows.
    """
    space = GroupSpace.of(contrasts, group_sizes)
    width = len(space.names)
    moderated = moderate(fit, prior).withColumns({"_mean": _by_place(space.names, "mean"), "_n": _by_place(space.names, "n")})

    @F.arrow_udf(DoubleType())
    def f_of(mean: pa.Array, n: pa.Array, s2: pa.Array) -> pa.Array:
        variance = s2.to_numpy(zero_copy_only=False)
        found = space.f(cells_matrix(mean, width), np.nan_to_num(cells_matrix(n, width)), variance)
        return pa.array(found, mask=np.isnan(found))

    at = {g: i for i, g in enumerate(space.names)}

    def change(weights: Mapping[str, float]) -> Column:
        terms = [F.get("_mean", F.lit(at[g])) * F.lit(float(w)) for g, w in weights.items() if w]
        return reduce(lambda x, y: x + y, terms, F.lit(0.0))

    keep = [c for c in fit.columns if c not in ("groups", "n_obs", "df", "sigma2")]
    effects = [change(w).alias(c) for c, w in contrasts.items()] if fold_changes else []
    return moderated.select(*keep, *effects, f_of("_mean", "_n", "s2_post").alias("f"), "df_total").select(
        *keep, *[F.col(quoted(c)) for c in contrasts if fold_changes], "f", f_pvalue(F.col("f"), F.lit(float(space.rank)), F.col("df_total")).alias("p_value")
    )


# --- log odds --------------------------------------------------------------------------


def effect_prior(rows: DataFrame, prior: VariancePrior, n_contrasts: int, feature: str = "protein_group") -> DataFrame:
    """(contrast, v0): prior variance of true effects from the most extreme t of each contrast.

    Extreme means a small p-value, which compares t of different degrees of freedom. A
    quantile cut keeps the top share of rows before ranks are given, so the ranking
    window holds that share only.
    """
    tested = rows.where(F.col("p_value").isNotNull()).withColumn("abs_t", F.abs("t"))
    per_contrast = Window.partitionBy("contrast")
    if prior.most_rows <= LARGE_GROUP_ROWS:
        near = tested.withColumn("n_genes", F.count(F.lit(1)).over(per_contrast))
    else:
        cut = exact_quantiles(
            tested, ["contrast"], "p_value", [_PROPORTION / 2], n_contrasts, prior.most_rows
        ).select("contrast", F.col("n").alias("n_genes"), F.col("q")[0].alias("cut"))
        joined = tested.join(broadcast_if(cut, n_contrasts), "contrast")
        # the interpolated quantile may fall one rank short of the last wanted row
        above = joined.where(F.col("p_value") > F.col("cut")).groupBy("contrast").agg(F.min("p_value").alias("following"))
        near = joined.join(broadcast_if(above, n_contrasts), "contrast", "left").where(
            F.col("p_value") <= F.coalesce(F.col("following"), F.col("cut"))
        )
    best_first = per_contrast.orderBy("p_value", F.desc("abs_t"), feature)
    top = (
        near.withColumn("target", F.ceil(F.lit(_PROPORTION / 2) * F.col("n_genes")))
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= F.col("target"))
    )
    max_df = rows.agg(F.max("df_total")).scalar()
    share = F.greatest(F.col("target") / F.col("n_genes"), F.lit(_PROPORTION))
    same_df = F.col("df_total") >= F.col("max_df") - 1e-9
    scored = (
        top.withColumn("max_df", max_df)
        .withColumn("p0", F.col("p_value") / 2)
        .withColumn("t_top", F.when(same_df, F.col("abs_t")).otherwise(t_quantile(F.col("p0"), F.col("max_df"))))
        .withColumn("p_target", ((F.col("rank") - 0.5) / (2 * F.col("n_genes")) - (1 - share) * F.col("p0")) / share)
    )
    q = t_quantile(F.when(F.col("p_target") > F.col("p0"), F.col("p_target")), F.col("max_df"))
    v = F.col("unscaled") * ((F.col("t_top") / q) ** 2 - 1)
    low, high = (s * s / prior.s02 for s in _STDEV_LIMITS)
    bounded = F.least(F.greatest(F.coalesce(v, F.lit(0.0)), F.lit(low)), F.lit(high))
    return scored.withColumn("v0", bounded).groupBy("contrast").agg(F.avg("v0").alias("v0"))


def log_odds(rows: DataFrame, prior: VariancePrior, n_contrasts: int, feature: str = "protein_group") -> DataFrame:
    """Add ``b``: log odds that a feature differs, per contrast."""
    v0 = effect_prior(rows, prior, n_contrasts, feature)
    joined = rows.join(broadcast_if(v0, n_contrasts), "contrast", "left")
    r = (F.col("unscaled") + F.col("v0")) / F.col("unscaled")
    t2 = F.col("t") * F.col("t")
    if prior.df0 > 1e6:
        kernel = t2 * (1 - 1 / r) / 2
    else:
        kernel = (1 + F.col("df_total")) / 2 * F.log((t2 + F.col("df_total")) / (t2 / r + F.col("df_total")))
    odds = math.log(_PROPORTION / (1 - _PROPORTION))
    return joined.withColumn("b", F.lit(odds) - F.log(r) / 2 + kernel).drop("v0")
