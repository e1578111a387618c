"""Intervals, gaps and test levels of vector autoregressions against closed forms and tables."""

import datetime as dt
import math

import numpy as np
import pytest
from conftest import to_pandas

from demandloom.functions import distributions as DI
from demandloom.functions.exprs import z_value
from demandloom.operators.forecast import var as V

START = dt.date(2020, 1, 1)


# Published upper 5, 2.5 and 1 percent points, and elementary cases.
@pytest.mark.parametrize("f, a, b, tail", [
    (3.325835, 5, 10, 0.05), (4.236086, 5, 10, 0.025), (5.636326, 5, 10, 0.01), (161.4476, 1, 1, 0.05), (2.534, 10, 14, 0.0545),
    (1.0, 7, 7, 0.5), (0.0, 3, 9, 1.0), (3.841459, 1, 10**7, 0.05),
])
def test_f_tail(f, a, b, tail):
    assert DI.f_tail(f, a, b) == pytest.approx(tail, abs=3e-4 if tail == 0.0545 else 2e-6)


def test_f_tail_in_closed_form():
    """With two degrees of freedom above, the tail is a power."""
    for b in (1, 4, 30, 2000):
        for f in (1e-6, 0.3, 1.0, 7.5, 60.0):
            assert DI.f_tail(f, 2, b) == pytest.approx((1 + 2 * f / b) ** (-b / 2), rel=1e-10)


@pytest.mark.parametrize("statistic, p", [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10), (-1.0, 0.7533), (-30.0, 0.0), (5.0, 1.0)])
def test_unit_root_tail(statistic, p):
    assert DI.unit_root_tail(statistic) == pytest.approx(p, abs=7e-4)
    assert math.isnan(DI.unit_root_tail(float("nan")))


def test_unit_root_tail_is_monotone():
    grid = [DI.unit_root_tail(x / 100) for x in range(-1883, 270)]
    assert all(a <= b + 2e-4 for a, b in zip(grid, grid[1:]))


def rows(values, key="a", skip=()):
    return [(key, START + dt.timedelta(days=i), *map(float, v)) for i, v in enumerate(values) if i not in skip]


def simulated(n=600, seed=2):
    rng = np.random.default_rng(seed)
    a, z = np.array([[0.5, 0.2], [0.1, 0.4]]), np.zeros((n, 2))
    for i in range(1, n):
        z[i] = a @ z[i - 1] + rng.normal(size=2)
    return z


SCHEMA = "k string, date date, u double, v double"


def test_intervals_of_one_lag(spark):
    """Errors of a first-order model: the sum of A^s S A'^s; of its running sum: with the summed powers."""
    z = simulated()
    df = spark.createDataFrame(rows(z), SCHEMA)
    models = V.var_fit(df, ["u", "v"], ["k"], max_lags=1, difference=False)
    m = models.first()
    a, s = V._matrix(m["coef"])[:, 1:], V._matrix(m["sigma"])
    got = to_pandas(V.var_forecast(models, ["u", "v"], ["k"], 4, 0.9), "variable", "ds")
    total, power = np.zeros((2, 2)), np.eye(2)
    for step in range(4):
        total, power = total + power @ s @ power.T, a @ power
        for j, name in enumerate("uv"):
            row = got[got.variable == name].iloc[step]
            half = z_value(0.95) * math.sqrt(total[j, j])
            assert row.yhat_upper - row.yhat == pytest.approx(half) and row.yhat - row.yhat_lower == pytest.approx(half)
    walk = {**m.asDict(), "diff_order": [1, 2]}
    spread = V._spread(walk, 3)
    once, twice = [np.eye(2)], [np.eye(2)]
    for i in (1, 2):
        once.append(once[-1] + np.linalg.matrix_power(a, i))
    for i in (1, 2):
        twice.append(twice[-1] + once[i])
    assert spread[2, 0] == pytest.approx(math.sqrt(sum((c @ s @ c.T)[0, 0] for c in once)))
    assert spread[2, 1] == pytest.approx(math.sqrt(sum((c @ s @ c.T)[1, 1] for c in twice)))


def test_a_lag_is_a_day(spark):
    """A weekly wave with missing days keeps its period where gaps are filled, and loses it where rows count."""
    n = 400
    wave = np.array([[10 + 3 * math.sin(2 * math.pi * i / 28), 5 + 2 * math.cos(2 * math.pi * i / 28)] for i in range(n)])
    skip = set(np.random.default_rng(0).choice(np.arange(1, n - 1), 60, replace=False).tolist())
    df = spark.createDataFrame(rows(wave, skip=skip), SCHEMA)
    truth = [10 + 3 * math.sin(2 * math.pi * i / 28) for i in range(n, n + 28)]
    error = {}
    for gaps in ("interpolate", "ignore"):
        models = V.var_fit(df, ["u", "v"], ["k"], max_lags=3, difference=False, gaps=gaps)
        assert models.first()["n"] == (n if gaps == "interpolate" else n - 60)
        out = to_pandas(V.var_forecast(models, ["u", "v"], ["k"], 28), "variable", "ds")
        error[gaps] = np.abs(out[out.variable == "u"].yhat.to_numpy() - truth).max()
    assert error["interpolate"] < 0.5 < error["ignore"]


def test_every_series_has_a_row(spark):
    z = simulated(80)
    bad = [("nan", START + dt.timedelta(days=i), float("nan"), None) for i in range(50)]
    df = spark.createDataFrame([*rows(z), *rows(z[:6], "short"), *bad, *rows(np.ones((60, 2)), "flat")], SCHEMA)
    models = V.var_fit(df, ["u", "v"], ["k"])
    assert models.count() == 4
    got = to_pandas(V.var_forecast(models, ["u", "v"], ["k"], 5), "k", "variable", "ds")
    assert got.groupby("k").size().to_dict()["a"] == 10 and set(got.k) == {"a", "short", "nan", "flat"}
    assert got[got.k == "short"].status.tolist() == ["too_short"] and got[got.k == "nan"].status.tolist() == ["too_short"]
    for fn in (V.var_irf, V.var_fevd):
        assert set(to_pandas(fn(models, ["u", "v"], ["k"], 2)).k) == {"a", "short", "nan", "flat"}
    tests = {(r.k, r.variable): r for r in V.stationarity(df, ["u"], ["k"], alpha=0.01).collect()}
    assert tests["a", "u"].is_stationary and tests["a", "u"].p_value < 0.01 and tests["a", "u"].critical_value < -3.4
    assert tests["flat", "u"].p_value is None and not tests["flat", "u"].is_stationary
    causes = {r.k: r for r in V.granger(df, "v", "u", ["k"], 2).collect()}
    assert causes["short"].p_value is None and causes["short"].is_cause is None and causes["nan"].f_statistic is None
    assert causes["a"].p_value == pytest.approx(DI.f_tail(causes["a"].f_statistic, 2, causes["a"].df_den))


def test_levels_of_tests(spark):
    rng = np.random.default_rng(4)
    noise = rng.normal(size=(300, 2))
    df = spark.createDataFrame(rows(noise) + rows(np.cumsum(noise, axis=0), "walk"), SCHEMA)
    got = {r.k: r for r in V.stationarity(df, ["u"], ["k"], alpha=0.2).collect()}
    assert got["a"].is_stationary and got["a"].critical_value is None
    assert V.granger(df.where("k = 'a'"), "v", "u", ["k"], 1, alpha=1.0).first().is_cause
    with pytest.raises(ValueError, match="gaps"):
        V.var_fit(df, ["u"], ["k"], gaps="drop")
