"""Rolling-origin fits from prefix sums against refits of every cutoff."""

import datetime as dt

import numpy as np
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.functions.exprs import z_value
from demandloom.operators.forecast import additive as AD

SPECS = [
    AD.AdditiveSpec(), AD.AdditiveSpec(changepoint_prior_scale=0.5, holidays_prior_scale=1.0), AD.AdditiveSpec(mode="multiplicative", interval=0.95),
    AD.AdditiveSpec(changepoints=0, weekly_order=1), AD.AdditiveSpec(changepoints=60, changepoint_range=1.0, yearly_order=2, seasonality_prior_scale=0.1),
]


def series(n, seed, gaps=0.1):
    rng = np.random.default_rng(seed)
    days = np.flatnonzero(rng.random(n) > gaps).astype(float) + 10_000
    y = 20 + 0.02 * (days - 10_000) + 5 * np.sin(days * 2 * np.pi / 7) + rng.normal(size=len(days)) * 2
    y[days > 10_300] += 8
    return days, np.abs(y), (days % 97 == 0).astype(float)[:, None], rng.normal(size=(len(days), 1))


@pytest.mark.parametrize("spec", SPECS)
def test_equations_give_the_refit(spec):
    days, y, eh, er = series(900, 1)
    cutoffs = AD._cutoffs(days, 200, 130, 30)
    assert len(cutoffs) >= 5
    sums = AD._Prefixes(days, y, spec, eh, er, cutoffs)
    for cutoff in cutoffs:
        past, ahead = days <= cutoff, (days > cutoff) & (days <= cutoff + 30)
        want = AD._solve(days[past], y[past], spec, eh[past], er[past])
        got = AD._solve_equations(sums.equations(cutoff), spec)
        assert got["span"] == want["span"] and got["scale"] == want["scale"] and (got["knots"] == want["knots"]).all()
        assert abs(got["sigma"] / want["sigma"] - 1) < 1e-7
        a, b = (AD._predict(days[ahead], days[0], s, spec, eh[ahead], er[ahead]) for s in (got, want))
        np.testing.assert_allclose(a, b, rtol=1e-6)


def table(spark):
    start, rows = dt.date(2000, 1, 1), []
    for k, n in (("a", 500), ("b", 420), ("short", 40), ("one", 1)):
        days, y, _, _ = series(n, n, 0.0)
        rows += [(k, start + dt.timedelta(days=int(d - 10_000)), float(v)) for d, v in zip(days, y)]
    rows += [("nan", start + dt.timedelta(days=i), float("inf") if i == 300 else 5.0 + i % 7) for i in range(450)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_backtest_has_a_row_for_every_series(spark):
    df = table(spark)
    got = to_pandas(AD.backtest(df, ["k"], initial=200, period=100, horizon=20), "k", "cutoff", "ds")
    assert set(got.k) == {"a", "b", "short", "one", "nan"}
    assert got[got.k.isin(["short", "one"])].status.tolist() == ["too_short"] * 2
    bad = got[(got.k == "nan") & (got.status == "failed")]
    assert len(bad) == 2 and bad.error.str.contains("finite").all() and (got[got.k == "nan"].status == "ok").sum() == 20
    a = df.where("k = 'a'").orderBy("ds").toPandas()
    days, y, eh, er = AD._series_arrays(a, [], [])
    mine = got[got.k == "a"]
    assert sorted(mine.cutoff.unique()) == [AD._day(c) for c in sorted(AD._cutoffs(days, 200, 100, 20))] and len(mine) == 60
    for cutoff, part in mine.groupby("cutoff"):
        c = float((cutoff - AD.EPOCH).days)
        state = AD._solve(days[days <= c], y[days <= c], AD.AdditiveSpec(), eh[days <= c], er[days <= c])
        ahead = (days > c) & (days <= c + 20)
        want = AD._predict(days[ahead], days[0], state, AD.AdditiveSpec(), eh[ahead], er[ahead])
        np.testing.assert_allclose(part.yhat.astype(float), want, rtol=1e-6)
        half = z_value(0.9) * state["sigma"] * state["scale"]
        np.testing.assert_allclose(part.yhat_upper.astype(float), want + half, rtol=1e-6)


def test_backtest_metrics(spark):
    c, d = dt.date(2000, 1, 1), dt.date(2000, 1, 2)
    rows = [(c, d, 10.0, 8.0, 7.0, 9.0), (c, d, 10.0, 12.0, 9.0, 15.0), (c, d, 4.0, 5.0, 3.0, 6.0), (c, d, 0.0, 0.0, 0.0, 0.0), (c, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "cutoff date, ds date, y double, yhat double, yhat_lower double, yhat_upper double")
    m = AD.backtest_metrics(df).collect()
    assert len(m) == 1 and m[0].horizon == 1 and m[0].rows == 4
    assert m[0].mdape == 0.2 and m[0].coverage == 0.75 and m[0].mape == pytest.approx((0.2 + 0.2 + 0.25) / 3)
    assert m[0].smape == pytest.approx((2 / 9 + 2 / 11 + 1 / 4.5) / 3)


def test_grid_search_ranks_and_statuses(spark):
    grid = {"changepoint_prior_scale": [0.001, 0.5], "mode": ["additive", "multiplicative"]}
    got = to_pandas(AD.grid_search(table(spark), ["k"], grid, initial=200, period=100, horizon=20), "k", "rank")
    assert got.groupby("k").size().to_dict() == {"a": 4, "b": 4, "nan": 4, "one": 1, "short": 1}
    assert got[got.k.isin(["one", "short"])]["rank"].isna().all() and set(got[got.k == "one"].status) == {"too_short"}
    best = got[(got.k == "a") & (got["rank"] == 1)].iloc[0]
    alone = AD.backtest(table(spark).where("k = 'a'"), ["k"], AD.AdditiveSpec(changepoint_prior_scale=best.changepoint_prior_scale, mode=best["mode"]), initial=200, period=100, horizon=20)
    per = alone.groupBy("cutoff").agg(F.sqrt(F.avg((F.col("yhat") - F.col("y")) ** 2)).alias("r"))
    assert per.agg(F.avg("r")).first()[0] == pytest.approx(best.rmse)
