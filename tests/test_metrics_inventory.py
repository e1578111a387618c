import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.functions import distributions as DI
from demandloom.operators import costs as K
from demandloom.operators import ensemble as E
from demandloom.operators import inventory as I
from demandloom.operators import metrics as M


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(0)
    n = 40
    pdf = pd.DataFrame({"k": ["a"] * n, "ds": range(n), "y": rng.integers(0, 6, n).astype(float)})
    pdf["m1"], pdf["m2"], pdf["m3"] = pdf.y + rng.normal(0, 1, n), rng.uniform(0, 5, n), rng.uniform(0, 9, n)
    df = spark.createDataFrame(pdf)
    lost = df.withColumn("m2", F.when(F.col("ds") != 3, F.col("m2")))
    return lost, pdf


def test_metrics_against_definitions(wide):
    df, pdf = wide
    got = {r["model"]: r for r in M.metrics_all(df, ["m1", "m2"], ["k"], season=7).collect()}
    for m in ("m1", "m2"):
        p = pdf if m == "m1" else pdf[pdf.ds != 3]
        y, f = p.y.to_numpy(), p[m].to_numpy()
        e, nz = f - y, y != 0
        want = {
            "mae": np.abs(e).mean(), "rmse": math.sqrt((e**2).mean()), "bias": e.mean(),
            "r2": 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(), "mape": np.abs(e[nz] / y[nz]).mean() * 100,
            "smape": (np.abs(e) / ((np.abs(y) + np.abs(f)) / 2)).mean() * 100, "wmape": np.abs(e).sum() / np.abs(y).sum() * 100,
            "mase": np.abs(e).mean() / np.abs(pdf.y.to_numpy()[7:] - pdf.y.to_numpy()[:-7]).mean(),
        }
        for name, value in want.items():
            assert got[m][name] == pytest.approx(value), (m, name)
    compat = M.metrics_all(df, ["m1"], ["k"], metrics=("wmape",), wmape_compat=True).first()["wmape"]
    y, f = pdf.y, pdf.m1
    assert compat == pytest.approx((y.abs() * (f - y).abs()).sum() / y.abs().sum() * 100)


def test_zero_actuals(spark):
    df = spark.createDataFrame([("a", 1, 0.0, 0.0), ("a", 2, 0.0, 0.0)], "k string, ds int, y double, m double")
    row = M.metrics_all(df, ["m"], ["k"]).first()
    assert row["mae"] == 0.0 and row["mape"] is None and row["smape"] is None and row["wmape"] is None and row["r2"] is None


def test_ranks_and_best(wide):
    df, _ = wide
    table = M.compare_models(df, ["m1", "m2", "m3"], ["k"], season=7)
    ranks = {(r["metric"], r["model"]): r["rank"] for r in M.rank_models(table).collect()}
    assert ranks["r2", "m1"] == 1 and ranks["rmse", "m1"] == 1
    best = M.best_model(table).first()
    assert best["best_model"] == "m1" and best["improvement"] == pytest.approx(1 - best["best_rmse"] / best["worst_rmse"])


def test_recorded_improvement(spark):
    df = spark.createDataFrame([("ensemble", 1.859703), ("var", 5.531765)], "model string, rmse double")
    assert M.best_model(df).first()["improvement"] == pytest.approx(0.6638, abs=5e-5)


def test_ensemble_weights_sum_to_one_and_missing_models(wide):
    df, _ = wide
    models = ["m1", "m2", "m3"]
    weights = E.ensemble_weights(df, models)
    assert weights.agg(F.sum("weight")).first()[0] == pytest.approx(1.0)
    for strict in (E.ensemble_weighted(df, models, weights), E.ensemble_average(df, models), E.ensemble_median(df, models)):
        assert strict.where("ensemble IS NULL").select("ds").collect()[0]["ds"] == 3
    fixed = E.ensemble_weighted(df, models, {"m1": 0.5, "m2": 0.25, "m3": 0.25}, renormalize=True).where("ds = 3").first()
    assert fixed["ensemble"] == pytest.approx((0.5 * fixed["m1"] + 0.25 * fixed["m3"]) / 0.75)
    even = E.ensemble_median(df, ["m1", "m3"]).first()
    assert even["ensemble"] == pytest.approx((even["m1"] + even["m3"]) / 2)


def test_qq_points_positions(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([np.round(rng.normal(0, 2, 300), 1), np.zeros(500)])
    df = spark.createDataFrame(pd.DataFrame({"model": "m", "residual": v}))
    got = to_pandas(M.qq_points(df), "value")
    s = pd.Series(v)
    want = pd.DataFrame({"value": s, "rank": s.rank()}).drop_duplicates().sort_values("value")
    np.testing.assert_allclose(got["position"], (want["rank"] - 0.5) / len(v))
    assert got["copies"].sum() == len(v) and got["theoretical"].is_monotonic_increasing


def test_interval_and_histogram(wide):
    df, pdf = wide
    long = M.to_long(df, ["m1", "m2", "m3"], ["k", "ds", "y"])
    row = M.prediction_interval(long, ["k"]).where("ds = 5").first()
    f = pdf.loc[5, ["m1", "m2", "m3"]].to_numpy(float)
    assert row["yhat_upper"] == pytest.approx(f.mean() + 1.959963985 * f.std())
    assert row["yhat_lower"] == pytest.approx(max(0.0, f.mean() - 1.959963985 * f.std()))
    hist = M.error_histogram(M.residuals(long, ["k"]), -5, 5, 10)
    assert hist.agg(F.sum("count")).first()[0] == 3 * 40 - 1


def test_recorded_policy(spark):
    mean, sd = 6.822769575165951, 1e-15
    df = spark.createDataFrame([(1, mean)] * 30, "k int, yhat double")
    row = I.optimal_inventory(df, ["k"], lead_time=7, holding_cost=0.2, stockout_cost=0.5, order_cost=50).first()
    assert row["economic_order_quantity"] == pytest.approx(58.40706111064805)
    assert row["reorder_point"] == pytest.approx(47.75938702616167)
    assert row["expected_holding_cost"] == pytest.approx(5.840706, abs=1e-6)
    # Exactly flat demand has no stockout probability; the slightest variation has 1 - service level.
    varied = spark.createDataFrame([(1, mean + (1e-9 if i % 2 else -1e-9)) for i in range(30)], "k int, yhat double")
    row = I.optimal_inventory(varied, ["k"], lead_time=7, holding_cost=0.2, stockout_cost=0.5, order_cost=50).first()
    assert row["expected_stockout_cost"] == pytest.approx(0.170569, abs=1e-6)
    assert row["total_expected_cost"] == pytest.approx(11.851981, abs=1e-5)
    assert sd < 1e-14


@pytest.mark.parametrize("rate, level, want", [(2.0, 0.95, 5), (10.0, 0.95, 15), (0.3, 0.5, 0), (400.0, 0.99, 447), (0.0, 0.9, 0)])
def test_poisson_quantile(rate, level, want):
    assert DI.poisson_first([rate], [level])[0] == want
    if rate:
        at, below = DI.poisson_at_most([want, want - 1], [rate, rate])
        assert at >= level > below


def test_poisson_against_plain_sums():
    rng = np.random.default_rng(1)
    rates = np.concatenate([rng.uniform(0.1, 600, 300), [0.1, 1.0, 15.0, 16.0, 17.0]])
    levels = rng.choice([1e-6, 0.01, 0.5, 0.95, 0.999999], len(rates))
    for rate, level, got in zip(rates, levels, DI.poisson_first(rates, levels)):
        k, mass = 0, math.exp(-rate)
        total = mass
        while total < level - 1e-12:
            k += 1
            mass *= rate / k
            total += mass
        assert got == k
        assert abs(DI.poisson_at_most([k], [rate])[0] - total) < 1e-12


def test_poisson_at_large_rates():
    """Consecutive masses stand in the ratio rate / k, whole tables sum to 1, and quantiles bracket their level."""
    for rate in (1e3, 1e5, 1e6):
        k = np.arange(math.floor(rate - 9 * rate**0.5), math.floor(rate + 9 * rate**0.5))
        mass = DI.poisson_mass(k.astype(float), np.full(len(k), rate))
        assert abs(math.fsum(mass) - 1) < 1e-12
        np.testing.assert_allclose(mass[1:] * k[1:], mass[:-1] * rate, rtol=1e-9)
        for level in (0.001, 0.5, 0.95):
            q = DI.poisson_first([rate], [level])[0]
            at, below = DI.poisson_at_most([q, q - 1], [rate, rate])
            assert at >= level > below and abs(math.fsum(mass[: int(q - k[0]) + 1]) - at) < 1e-11


def test_poisson_columns(spark):
    df = spark.createDataFrame([(2.0, 0.95), (None, 0.9), (3.0, None), (float("inf"), 0.5), (4.0, 1.0), (0.0, 0.5)], "r double, p double")
    assert [x[0] for x in df.select(DI.poisson_quantile("r", "p")).collect()] == [5.0, None, None, None, None, 0.0]
    got = [x[0] for x in df.select(DI.poisson_cdf("r", F.lit(0.0))).collect()]
    assert got[1] is None and got[3] is None and got[5] == 1.0 and abs(got[0] - math.exp(-2)) < 1e-15


def test_normal_quantile_is_an_expression(spark):
    p = [1e-300, 1e-20, 1e-9, 0.001, 0.0749, 0.075, 0.0751, 0.3, 0.5, 0.6, 0.925, 0.95, 0.999, 1 - 1e-12]
    out = spark.createDataFrame([(x,) for x in [*p, 0.0, 1.0, -1.0, None]], "p double").select(DI.normal_quantile("p").alias("z"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = [r.z for r in out.collect()]
    assert got[-4:] == [None] * 4
    for x, z in zip(p, got):
        assert abs(z - NormalDist().inv_cdf(x)) < 1e-9


def test_given_weights_and_deviation(spark):
    rows = [("a", 1, 10.0, 8.0, 1.0), ("a", 2, 20.0, 26.0, 3.0), ("a", 3, 5.0, None, 100.0)]
    df = spark.createDataFrame(rows, "k string, ds int, y double, m double, w double")
    got = M.metrics_all(df, ["m"], ["k"], metrics=("wmape",), weight="w").first()
    assert got["wmape"] == pytest.approx((1 * 2 + 3 * 6) / 4 * 100)
    demand = spark.createDataFrame([(1, 10.0, 2.0), (1, 14.0, 4.0)], "k int, yhat double, s double")
    for deviation, sd in ((3.5, 3.5), ("s", 3.0), (None, 2.0)):
        row = I.optimal_inventory(demand, ["k"], deviation=deviation).first()
        assert row["forecast_std"] == sd and row["safety_stock"] == pytest.approx(NormalDist().inv_cdf(0.95) * sd)


def test_policy_multi_defaults(spark):
    df = spark.createDataFrame([(k, float(v)) for k in (1, 2) for v in (3, 5, 9)], "k int, yhat double")
    params = spark.createDataFrame([(1, 4.0, 50.0, 0.2, 10.0, 0.9, None), (2, 4.0, 50.0, 0.2, 10.0, None, 1000.0)],
                                   "k int, lead_time double, ordering_cost double, holding_cost_rate double, unit_cost double, "
                                   "service_level double, current_stock double")
    a, b = I.inventory_policy_multi(df, params, ["k"]).orderBy("k").collect()
    sd = np.std([3, 5, 9], ddof=1)
    assert a["safety_stock"] == pytest.approx(1.2815515655 * sd * 2) and b["safety_stock"] == pytest.approx(1.644853627 * sd * 2)
    assert a["reorder_needed"] and not b["reorder_needed"] and b["order_quantity"] == 0.0
    assert a["economic_order_quantity"] == pytest.approx(math.sqrt(2 * a["annual_demand"] * 50 / 2.0))


def test_costs_with_zero_denominators(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0)], "avg double, demand double, q double")
    row = K.annual_costs(df, "avg", "demand", "q", 10.0, 0.2, 50.0).first()
    assert row["num_orders"] == 0.0 and row["total_annual_cost"] == 0.0
    one = df.select(K.turnover(F.col("demand"), F.col("avg")), K.days_of_supply(F.col("avg"), F.col("demand")),
                    K.service_level(F.col("demand"), F.col("avg"))).first()
    assert tuple(one) == (None, None, 0.0)


def test_echelon_demand_from_falling_levels(spark):
    levels = spark.createDataFrame([("dc", d, v) for d, v in enumerate([10.0, 6.0, 9.0, 7.0])], "echelon string, date int, level double")
    params = spark.createDataFrame([("dc", 10.0, 0.2, 50.0, 30.0)],
                                   "echelon string, unit_cost double, holding_cost_rate double, cost_per_order double, order_quantity double")
    out = {r["echelon"]: r for r in K.echelon_costs(levels, params).collect()}
    assert out["dc"]["holding_cost"] == pytest.approx(16.0) and out["dc"]["ordering_cost"] == pytest.approx(3.0 * 365 / 30 * 50)
    assert out[None]["total_cost"] == pytest.approx(out["dc"]["total_cost"])


def test_stock_projection(spark):
    led = spark.createDataFrame([(1, d, r, q) for d, (r, q) in enumerate([(0, 4), (10, 1), (0, 30)])], "store_id int, date int, receipts int, demand int")
    out = to_pandas(I.stock_projection(led, 10.0, 8.0), "date")
    assert out["level"].tolist() == [6.0, 15.0, -15.0] and out["below_reorder"].tolist() == [1, 0, 1] and set(out["first_breach"]) == {0}
