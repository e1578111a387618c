"""Distribution functions: column expressions where a formula does, vectorised numpy where a search is needed."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published rational approximation of the normal quantile (algorithm AS 241, PPND16), highest power first.
_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
_NEAR = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
     3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0),
)
_FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def _ratio(coefficients: tuple[Sequence[float], Sequence[float]], x: Column) -> Column:
    top, bottom = (reduce(lambda acc, c: acc * x + F.lit(c), cs[1:], F.lit(cs[0])) for cs in coefficients)
    return top / bottom


def normal_quantile(p: Column | str) -> Column:
    """Standard normal quantile as a column expression, to 1e-15 of its size; NULL outside (0, 1)."""
    p = (F.col(p) if isinstance(p, str) else p).cast("double")
    q = p - 0.5
    centre = q * _ratio(_CENTRE, F.lit(0.180625) - q * q)
    r = F.sqrt(-F.ln(F.least(p, F.lit(1.0) - p)))
    tail = F.signum(q) * F.when(r <= 5.0, _ratio(_NEAR, r - 1.6)).otherwise(_ratio(_FAR, r - 5.0))
    return F.when((p > 0.0) & (p < 1.0), F.when(F.abs(q) <= 0.425, centre).otherwise(tail))


def _log_factorial_rest(n: np.ndarray) -> np.ndarray:
    """ln n! less Stirling's leading terms."""
    small = np.array([0.0, *[math.lgamma(i + 1) - (i + 0.5) * math.log(i) + i - 0.5 * math.log(2 * math.pi) for i in range(1, 16)]])
    big = np.maximum(n, 16.0)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - 1 / 1188 / big**2) / big**2) / big**2) / big**2) / big
    return np.where(n < 16, small[np.minimum(n, 15).astype(int)], series)


def _deviance(k: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """k ln(k / rate) + rate - k without cancellation where k is near the rate (k > 0)."""
    v = (k - rate) / (k + rate)
    near = np.abs(v) < 0.1
    w = np.where(near, v, 0.0)
    total, power = (k - rate) * w, 2 * k * w
    for j in range(1, 12):
        power = power * w * w
        total = total + power / (2 * j + 1)
    plain = k * np.log(np.maximum(k, 1e-300) / rate) + rate - k
    return np.where(near, total, plain)


def poisson_mass(k: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """P(X = k) by the saddle-point form, accurate at any rate above 0."""
    some = np.maximum(k, 1.0)
    mass = np.exp(-_log_factorial_rest(some) - _deviance(some, rate)) / np.sqrt(2 * math.pi * some)
    return np.where(k < 0, 0.0, np.where(k == 0, np.exp(-rate), mass))


def poisson_at_most(k: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """P(X <= k): the incomplete gamma function's series, from k downwards below the rate and upwards above it.

    Its terms fall from the first on, and a few times the root of the rate of
    them matter.  Works on all rows at once, while any has terms left.
    """
    k, rate = np.floor(np.asarray(k, float)), np.asarray(rate, float)
    out = np.where(k < 0, 0.0, 1.0)
    idx = np.flatnonzero((k >= 0) & (rate > 0))
    at, lam = k[idx], rate[idx]
    up = at >= lam
    first = np.where(up, at + 1, at)
    term, total, place = np.ones(len(idx)), np.ones(len(idx)), first.copy()
    live = np.arange(len(idx))
    while len(live):
        u, i, r = up[live], place[live], lam[live]
        t = term[live] * np.where(u, r / (i + 1), i / r)
        term[live], place[live] = t, np.where(u, i + 1, i - 1)
        total[live] += t
        live = live[t > total[live] * 1e-17]
    part = np.minimum(poisson_mass(first, lam) * total, 1.0)
    out[idx] = np.where(up, 1.0 - part, part)
    return out


def poisson_first(rate: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Smallest k with P(X <= k) >= p: bracketed around the corrected normal approximation, then bisected."""
    rate, p = np.asarray(rate, float), np.asarray(p, float)
    inv = np.vectorize(_normal_inverse, otypes=[float])
    levels, which = np.unique(p, return_inverse=True)
    z = inv(levels)[which]
    guess = np.floor(rate + z * np.sqrt(rate) + (z * z - 1) / 6)
    step = np.full(len(rate), 2.0)
    low, high = np.maximum(guess - 2, -1.0), np.maximum(guess + 2, 0.0)
    enough = lambda k, i: poisson_at_most(k, rate[i]) >= p[i] - 1e-12
    todo = np.flatnonzero(low >= 0)
    while len(todo):  # low must not be enough
        todo = todo[enough(low[todo], todo)]
        high[todo], low[todo] = low[todo], np.maximum(low[todo] - step[todo], -1.0)
        step[todo] *= 2
        todo = todo[low[todo] >= 0]
    todo = np.arange(len(rate))
    while len(todo):  # high must be
        todo = todo[~enough(high[todo], todo)]
        low[todo], high[todo] = high[todo], high[todo] + step[todo]
        step[todo] *= 2
    todo = np.flatnonzero(high - low > 1)
    while len(todo):
        middle = np.floor((low[todo] + high[todo]) / 2)
        good = enough(middle, todo)
        high[todo], low[todo] = np.where(good, middle, high[todo]), np.where(good, low[todo], middle)
        todo = todo[high[todo] - low[todo] > 1]
    return np.where(rate <= 0, 0.0, high)


def _normal_inverse(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(p)


@F.pandas_udf(T.DoubleType())
def poisson_quantile(rate, p):
    """Poisson quantile of whole batches; NULL for a missing or infinite rate or a level outside (0, 1)."""
    r, q = rate.to_numpy(float), p.to_numpy(float)
    out = np.full(len(r), np.nan)
    good = np.flatnonzero(np.isfinite(r) & (q > 0) & (q < 1))
    out[good] = poisson_first(np.maximum(r[good], 0.0), q[good])
    return rate.__class__(out, dtype="Float64").mask(np.isnan(out))


@F.pandas_udf(T.DoubleType())
def poisson_cdf(rate, x):
    """P(X <= x) of whole batches; 1 for a rate of 0; NULL where either is missing."""
    r, v = rate.to_numpy(float), x.to_numpy(float)
    out = np.full(len(r), np.nan)
    good = np.flatnonzero(np.isfinite(r) & np.isfinite(v))
    out[good] = np.where(r[good] <= 0, 1.0, poisson_at_most(np.floor(v[good] + 1e-9), np.maximum(r[good], 0.0)))
    return rate.__class__(out, dtype="Float64").mask(np.isnan(out))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by the modified Lentz method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 10_000):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + top / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if not 0.0 < x < 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def f_tail(f: float, df_num: float, df_den: float) -> float:
    """P(F > f) with these degrees of freedom."""
    if f <= 0:
        return 1.0
    return incomplete_beta(df_den / 2.0, df_num / 2.0, df_den / (df_den + df_num * f))


# The published response surface of unit-root p-values with a constant (one series): the normal deviate
# as a polynomial of the statistic, lowest power first, on either side of a statistic; beyond two others it is 0 or 1.
_UNIT_ROOT_LOW, _UNIT_ROOT_HIGH = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
_UNIT_ROOT_SPLIT, _UNIT_ROOT_LEAST, _UNIT_ROOT_MOST = -1.61, -18.83, 2.74


def unit_root_tail(statistic: float) -> float:
    """P-value of the unit-root statistic of a regression with a constant."""
    from statistics import NormalDist

    if statistic != statistic:
        return float("nan")
    if statistic > _UNIT_ROOT_MOST or statistic < _UNIT_ROOT_LEAST:
        return 1.0 if statistic > _UNIT_ROOT_MOST else 0.0
    surface = _UNIT_ROOT_LOW if statistic <= _UNIT_ROOT_SPLIT else _UNIT_ROOT_HIGH
    return NormalDist().cdf(sum(c * statistic**i for i, c in enumerate(surface)))
