"""Special functions of the statistics: JVM expressions where a series does, Arrow else."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_SHIFT = 8


def digamma(x: Column) -> Column:
    """psi(x) for x > 0: eight recurrence steps, then the asymptotic series."""
    y = x + _SHIFT
    r = 1 / (y * y)
    series = F.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
    for i in range(_SHIFT):
        series = series - 1 / (x + i)
    return series


def trigamma(x: Column) -> Column:
    """psi'(x) for x > 0, same scheme."""
    y = x + _SHIFT
    r = 1 / (y * y)
    series = 1 / y + r / 2 + r / y * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * 5 / 66))))
    for i in range(_SHIFT):
        series = series + 1 / ((x + i) * (x + i))
    return series


def digamma_value(x: float) -> float:
    y, r = x + _SHIFT, 1 / (x + _SHIFT) ** 2
    series = math.log(y) - 0.5 / y - r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
    return series - sum(1 / (x + i) for i in range(_SHIFT))


def trigamma_value(x: float) -> float:
    y, r = x + _SHIFT, 1 / (x + _SHIFT) ** 2
    series = 1 / y + r / 2 + r / y * (1 / 6 - r * (1 / 30 - r * (1 / 42 - r * (1 / 30 - r * 5 / 66))))
    return series + sum(1 / (x + i) ** 2 for i in range(_SHIFT))


def trigamma_inverse(y: float) -> float:
    """x > 0 with psi'(x) = y, by bisection on log x (psi' falls steadily)."""
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if trigamma_value(math.exp(mid)) > y:
            lo = mid
        else:
            hi = mid
    return math.exp((lo + hi) / 2)


_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012,
    9.9843695780195716e-6, 1.5056327351493116e-7,
)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Lanczos approximation (g = 7), x > 0."""
    z = np.asarray(x, dtype=float) - 1
    total = np.full_like(z, _LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], start=1):
        total = total + c / (z + i)
    t = z + 7.5
    return 0.5 * math.log(2 * math.pi) + (z + 0.5) * np.log(t) - t + np.log(total)


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log B(a, b); a Stirling difference where one argument is large."""
    small, large = np.minimum(a, b), np.maximum(a, b)
    with np.errstate(all="ignore"):
        direct = _log_gamma(small) + _log_gamma(large) - _log_gamma(small + large)
        s = small + large
        corr = (1 / large - 1 / s) / 12 - (1 / large**3 - 1 / s**3) / 360
        stirling = (
            _log_gamma(small) + small
            - (large - 0.5) * np.log1p(small / large) - small * np.log(s) + corr
        )
    return np.where(large > 200, stirling, direct)


def reg_inc_beta(a, b, x, y=None) -> np.ndarray:
    """I_x(a, b) by the modified Lentz continued fraction, vectorised.

    ``y = 1 - x`` may be given where the difference would lose digits.
    """
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    y = 1 - x if y is None else np.broadcast_to(np.asarray(y, float), x.shape)
    flip = x > (a + 1) / (a + b + 2)
    p, q = np.where(flip, b, a), np.where(flip, a, b)
    u, w = np.where(flip, y, x), np.where(flip, x, y)
    tiny = 1e-300
    with np.errstate(all="ignore"):
        log_u = np.where(w < 0.5, np.log1p(-w), np.log(u))
        log_w = np.where(u < 0.5, np.log1p(-u), np.log(w))
        front = np.exp(p * log_u + q * log_w - _log_beta(p, q)) / p
        c = np.ones_like(u)
        d = 1 - (p + q) * u / (p + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        h = d.copy()
        for m in range(1, 3000):
            even = m * (q - m) * u / ((p + 2 * m - 1) * (p + 2 * m))
            odd = -(p + m) * (p + q + m) * u / ((p + 2 * m) * (p + 2 * m + 1))
            for term in (even, odd):
                d = 1 + term * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + term / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                step = d * c
                h = h * step
            if not np.any(np.abs(step - 1) > 1e-15):
                break
        else:
            slow = np.abs(step - 1) > 1e-10
            if np.any(slow):
                raise ArithmeticError(f"{int(slow.sum())} incomplete beta functions did not converge")
        part = np.where(u <= 0, 0.0, front * h)
    return np.where(np.isnan(x), np.nan, np.where(flip, 1 - part, part))


# From here on t is expanded around the normal; the error falls with the cube of 1 / df.
_LARGE_DF = 1e5
_NORMAL_DF = 1e10


def _normal_two_sided(t: np.ndarray) -> np.ndarray:
    """erfc(|t| / sqrt 2) by the incomplete gamma function's continued fraction and series, vectorised."""
    x = np.abs(np.asarray(t, float)) / math.sqrt(2)
    square = x * x
    near = square < 2
    with np.errstate(all="ignore"):
        term = np.where(near, x, 0.0)
        series = term.copy()
        for k in range(1, 60):
            term = -term * square / k
            series = series + term / (2 * k + 1)
        tail = np.zeros_like(x)
        for k in range(200, 0, -1):
            tail = (k / 2) / (np.where(near, 1.0, x) + tail)
        far = np.exp(-square) / math.sqrt(math.pi) / (x + tail)
    return np.where(near, 1 - 2 / math.sqrt(math.pi) * series, far)


def _large_df_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Hill's normal deviate of t (1970), then the normal tail."""
    half = df - 0.5
    z2 = half * np.log1p(t * t / df)
    z = np.sqrt(z2)
    b = 48 * half * half
    z = z + z * (z2 + 3) / b - z * (4 * z2**3 + 33 * z2 * z2 + 240 * z2 + 855) / (10 * b * (b + 0.8 * z2 * z2 + 100))
    return _normal_two_sided(z)


def t_two_sided(t, df) -> np.ndarray:
    """P(|T| > |t|)."""
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    large = df > _LARGE_DF
    v = np.where(large, 1.0, df)
    square = t * t
    with np.errstate(all="ignore"):
        p = reg_inc_beta(v / 2, 0.5, v / (v + square), square / (v + square))
        if large.any():
            p = np.where(large, _large_df_two_sided(t, np.where(large, np.minimum(df, 1e15), _LARGE_DF)), p)
    return p


def f_upper(f, df1: float, df2) -> np.ndarray:
    """P(F > f) with df1 and df2 degrees of freedom."""
    f, df2 = np.broadcast_arrays(np.asarray(f, float), np.asarray(df2, float))
    v = np.minimum(df2, _NORMAL_DF)
    with np.errstate(all="ignore"):
        return reg_inc_beta(v / 2, df1 / 2, v / (v + df1 * f), df1 * f / (v + df1 * f))


def t_upper_quantile(p, df) -> np.ndarray:
    """t with P(T > t) = p, for 0 < p <= 0.5, by bisection on log t."""
    p, df = np.broadcast_arrays(np.asarray(p, float), np.asarray(df, float))
    lo, hi = np.full(p.shape, -60.0), np.full(p.shape, 60.0)
    for _ in range(120):
        mid = (lo + hi) / 2
        above = t_two_sided(np.exp(mid), df) / 2 > p
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return np.exp((lo + hi) / 2)


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(t.to_numpy(float), df.to_numpy(float))).where(t.notna() & df.notna(), None)


@F.pandas_udf(DoubleType())
def f_pvalue(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    p = f_upper(f.to_numpy(float), df1.to_numpy(float), df2.to_numpy(float))
    return pd.Series(p).where(f.notna() & df2.notna(), None)


@F.pandas_udf(DoubleType())
def t_quantile(p: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_upper_quantile(p.to_numpy(float), df.to_numpy(float))).where(p.notna(), None)
