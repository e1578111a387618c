import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.operators.forecast import additive as AD
from demandloom.operators.forecast import boosted as B
from demandloom.operators.forecast import scoring as SC
from demandloom.operators.forecast import simple as SI
from demandloom.operators.forecast import stacking as ST
from demandloom.operators.forecast import var as V

START = dt.date(2019, 1, 1)


def days(n):
    return [START + dt.timedelta(days=i) for i in range(n)]


def weekly_series(n=900, slope=0.05, base=20.0):
    t = np.arange(n)
    return base + slope * t + 5 * np.sin(2 * np.pi * np.array([d.toordinal() % 7 for d in days(n)]) / 7)


@pytest.fixture(scope="module")
def history(spark):
    y = weekly_series()
    rows = [("a", d, float(v)) for d, v in zip(days(900), y)] + [("b", d, float(v) * 3) for d, v in zip(days(900), y)]
    rows += [("short", START, 1.0)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_additive_recovers_trend_and_week(history):
    out = to_pandas(AD.forecast_additive(history, ["k"], 28), "k", "ds")
    a = out[out.k == "a"]
    assert len(a) == 928 and out[out.k == "short"].status.tolist() == ["too_short"]
    future = a[a.y.isna()]
    want = weekly_series(928)[900:]
    assert np.abs(future.yhat.to_numpy() - want).max() < 1.5
    assert ((future.yhat_lower <= future.yhat) & (future.yhat <= future.yhat_upper)).all()


def test_column_scoring_equals_numpy_design(history):
    spec = AD.AdditiveSpec()
    scored = to_pandas(AD.forecast_additive(history.where("k = 'a'"), ["k"], 0, spec=spec), "ds")
    d = np.array([(x - AD.EPOCH).days for x in scored.ds], float)
    none = np.zeros((len(d), 0))
    state = AD._solve(d, scored.y.to_numpy(), spec, none, none)
    np.testing.assert_allclose(scored.yhat, AD._predict(d, d[0], state, spec, none, none), rtol=1e-9)


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_components_add_up(history, mode):
    spec = AD.AdditiveSpec(mode=mode)
    out = to_pandas(AD.forecast_additive(history, ["k"], 7, spec=spec, components=True), "k", "ds")
    out = out[out.status == "ok"]
    total = out[["trend", "weekly", "yearly", "holidays", "regressors"]].sum(axis=1)
    np.testing.assert_allclose(out.yhat, np.expm1(total) if mode == "multiplicative" else total, rtol=1e-9)
    assert np.abs(out.yhat - out.y).mean() / out.y.mean() < 0.05


def test_holidays_and_regressors_have_effect(spark):
    n = 400
    promo = [float(i % 11 == 0) for i in range(n)]
    y = [10.0 + 4 * p + (20.0 if i in (100, 200, 300) else 0.0) for i, p in enumerate(promo)]
    df = spark.createDataFrame([("a", d, v, p) for d, v, p in zip(days(n), y, promo)], "k string, ds date, y double, promo double")
    hol = spark.createDataFrame([(days(n + 60)[i], "Fair") for i in (100, 200, 300, 410)], "ds date, holiday string")
    ahead = spark.createDataFrame([("a", days(n + 60)[n + i], float(i == 3)) for i in range(20)], "k string, ds date, promo double")
    out = to_pandas(AD.forecast_additive(df, ["k"], 20, regressors=["promo"], future=ahead, holidays=hol, include_history=False), "ds")
    # The fair and one promotion lie ahead; both effects are carried over.
    assert out.yhat[10] > 25 and abs(out.yhat[3] - out.yhat[4] - 4) < 1.5
    with pytest.raises(ValueError):
        AD.forecast_additive(df, ["k"], 5, regressors=["promo"])


def test_model_table_roundtrip_and_requests(spark, history, tmp_path):
    models = AD.fit_additive(history, ["k"]).withColumn("model_id", F.col("k"))
    SC.write_models(models, str(tmp_path / "m"))
    models = SC.read_models(spark, str(tmp_path / "m"))
    assert {r["k"]: r["status"] for r in models.collect()} == {"a": "ok", "b": "ok", "short": "too_short"}
    requests = spark.createDataFrame(
        [(1, "a", 3, None, None), (2, None, 3, None, None), (3, "zzz", 3, None, None), (4, "b", None, "W", None), (5, "a", 2, None, True)],
        "request_id int, model_id string, horizon int, freq string, include_history boolean")
    out = to_pandas(SC.score_requests(requests, models), "request_id", "ds")
    sizes = out.groupby("request_id").size().to_dict()
    assert sizes == {1: 3, 2: 1, 3: 1, 4: 30, 5: 902}
    assert dict(zip(out.request_id, out.status)) == {1: "ok", 2: "missing_id", 3: "not_found", 4: "ok", 5: "ok"}
    four = out[out.request_id == 4]
    assert (four.ds.iloc[1] - four.ds.iloc[0]).days == 7
    assert set(to_pandas(SC.score_requests(requests, models, needs_features=2)).status) == {"missing_features", "missing_id", "not_found"}
    batch = SC.score_batch(history.withColumnRenamed("ds", "date"), models, ["k"], 5)
    assert batch.count() == 10 and SC.join_model_state(history, models, ["k"]).where("k = 'short'").count() == 0


def test_backtest_cutoffs_and_grid(history):
    results = AD.backtest(history, ["k"], AD.AdditiveSpec(yearly_order=2), initial=600, period=90, horizon=30)
    cuts = sorted(r[0] for r in results.where("k = 'a'").select("cutoff").distinct().collect())
    last = days(900)[-1]
    assert cuts == [last - dt.timedelta(days=30 + 90 * i) for i in (2, 1, 0)]
    assert results.where("ds <= cutoff OR ds > date_add(cutoff, 30)").count() == 0
    metrics = AD.backtest_metrics(results)
    assert metrics.count() == 30 and metrics.agg(F.max("rmse")).first()[0] < 3
    grid = AD.grid_search(history, ["k"], {"changepoint_prior_scale": [0.01, 0.5], "mode": ["additive", "multiplicative"]},
                          AD.AdditiveSpec(yearly_order=2), initial=600, period=200)
    pdf = to_pandas(grid, "k", "rank")
    assert pdf[pdf.status != "ok"][["k", "status"]].values.tolist() == [["short", "too_short"]]
    pdf = pdf[pdf.status == "ok"]
    assert len(pdf) == 8 and pdf[pdf["rank"] == 1].shape[0] == 2 and pdf.groupby("k").rmse.apply(lambda s: s.is_monotonic_increasing).all()


def test_boosted_rows_use_the_right_history(spark):
    n, horizon = 60, 5
    df = spark.createDataFrame([("a", d, float(i)) for i, d in enumerate(days(n))], "k string, ds date, y double")
    rows = to_pandas(B.training_rows(df, ["k"], horizon), "ds")
    assert (rows.lag_1 == rows.y - rows.h).all() and (rows.lag_28 == rows.y - rows.h - 27).all()
    assert set(rows.h) == {1, 2, 3, 4, 5} and rows.is_validation.sum() == 12
    hist = to_pandas(B.history_rows(df, ["k"]), "ds")
    assert (hist.lag_1 == hist.y - 1).all() and len(hist) == n - 28
    ahead = to_pandas(B.future_rows(df, ["k"], horizon), "ds")
    assert ahead.h.tolist() == [1, 2, 3, 4, 5] and set(ahead.lag_1) == {59.0} and ahead.ds.iloc[0] == days(n + 1)[-1]


def test_boosted_forecast_and_importance(spark, history):
    out = B.forecast_gbt(history.where("k <> 'short'"), ["k"], 7, max_iter=8)
    pdf = to_pandas(out, "k", "ds")
    assert len(pdf) == 2 * (900 - 28 + 7) and pdf.yhat.notna().all()
    known = pdf[pdf.y.notna()]
    assert np.abs(known.yhat - known.y).mean() < 0.2 * known.y.mean()
    imp = B.feature_importance(history.where("k <> 'short'"), ["k"], 7, max_iter=3)
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_model_selection_finds_the_signal(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    pdf = pd.DataFrame(x, columns=["s", "n1", "n2"]).assign(y=3 * x[:, 0] + 0.1 * rng.normal(size=500))
    df = spark.createDataFrame(pdf)
    assert B.select_features_model(df, "y", 1, trees=10).first()["feature"] == "s"
    mi = to_pandas(SI.select_features_mi(df, "y"))
    assert mi.feature[0] == "s"
    a, b = (np.searchsorted(np.quantile(pdf[c], np.arange(1, 10) / 10), pdf[c], side="left") for c in ("s", "y"))
    joint = pd.crosstab(a, b).to_numpy() / 500
    outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
    assert mi.mutual_info[0] == pytest.approx((joint[joint > 0] * np.log(joint[joint > 0] / outer[joint > 0])).sum())


@pytest.mark.parametrize("kind", ["multiplicative", "additive"])
@pytest.mark.parametrize("period", [7, 4])
def test_decomposition_rebuilds_the_series(spark, kind, period):
    n = 56
    season = np.array([1.5, 0.5, 1.0, 1.0, 0.8, 1.2, 1.0][:period])
    season = season / season.mean() if kind == "multiplicative" else season - season.mean()
    base = 10 + 0.2 * np.arange(n)
    y = base * season[np.arange(n) % period] if kind == "multiplicative" else base + season[np.arange(n) % period]
    df = spark.createDataFrame([("a", d, float(v)) for d, v in zip(days(n), y)], "k string, date date, sales double")
    out = to_pandas(SI.seasonal_decompose(df, ["k"], period=period, kind=kind), "date").dropna()
    parts = out.trend * out.seasonal * out.remainder if kind == "multiplicative" else out.trend + out.seasonal + out.remainder
    np.testing.assert_allclose(parts, out.sales)
    assert len(out) == n - 2 * (period // 2)
    if kind == "additive":
        np.testing.assert_allclose(out.seasonal.iloc[:period].mean(), 0, atol=1e-9)
        np.testing.assert_allclose(out.remainder, 0, atol=1e-6)


def ar_pair(n=600, seed=0):
    rng = np.random.default_rng(seed)
    a = np.array([[0.5, 0.3], [0.0, 0.4]])
    z = np.zeros((n, 2))
    for i in range(1, n):
        z[i] = np.array([1.0, 0.5]) + a @ z[i - 1] + rng.normal(0, 1, 2)
    return a, z


@pytest.fixture(scope="module")
def pair(spark):
    a, z = ar_pair()
    rows = [("k", d, float(u), float(v), float(np.cumsum(z[:, 0])[i])) for i, (d, (u, v)) in enumerate(zip(days(600), z))]
    return a, z, spark.createDataFrame(rows, "k string, date date, u double, v double, walk double")


def test_var_coefficients_forecast_and_responses(pair):
    a, z, df = pair
    models = V.var_fit(df, ["u", "v"], ["k"])
    row = models.first()
    assert row["status"] == "ok" and list(row["diff_order"]) == [0, 0] and 1 <= row["lag_order"] <= 3
    one = V.var_fit(df, ["u", "v"], ["k"], max_lags=1)
    coef = {(r["equation"], r["term"]): r["coefficient"] for r in V.var_coefficients(one, ["u", "v"], ["k"]).collect()}
    assert coef["u", "L1.u"] == pytest.approx(0.5, abs=0.12) and coef["u", "L1.v"] == pytest.approx(0.3, abs=0.12)
    ahead = to_pandas(V.var_forecast(one, ["u", "v"], ["k"], 2), "variable", "ds")
    first = coef["u", "const"] + coef["u", "L1.u"] * z[-1, 0] + coef["u", "L1.v"] * z[-1, 1]
    assert ahead.yhat[0] == pytest.approx(first)
    assert ahead.ds[0] == days(601)[-1]
    irf = to_pandas(V.var_irf(one, ["u", "v"], ["k"], 3), "step")
    assert irf[(irf.step == 0) & (irf.impulse == "v") & (irf.response == "u")].value.iloc[0] == 0
    fevd = V.var_fevd(one, ["u", "v"], ["k"], 5).groupBy("variable", "step").agg(F.sum("share").alias("s"))
    np.testing.assert_allclose([r["s"] for r in fevd.collect()], 1.0)
    scores = to_pandas(V.var_lag_scores(models, ["k"]))
    assert scores[scores.selected].shape[0] == 3


def test_difference_undo():
    for order, y in ((1, np.array([1.0, 4, 9, 16, 25])), (2, np.array([1.0, 4, 9, 16, 25, 36]))):
        path = np.diff(y, n=order)[-2:]
        known = y[:-2]
        np.testing.assert_allclose(V._undo(path, order, known[-1], known[-1] - known[-2]), y[-2:])


def test_unit_root_and_granger(pair):
    _, _, df = pair
    got = {r["variable"]: r["is_stationary"] for r in V.stationarity(df, ["u", "walk"], ["k"]).collect()}
    assert got == {"u": True, "walk": False}
    forward = V.granger(df, "v", "u", ["k"], 2).first()["f_statistic"]
    backward = V.granger(df, "u", "v", ["k"], 2).first()["f_statistic"]
    assert forward > 10 > backward
    short = V.var_fit(df.limit(5), ["u", "v"], ["k"]).first()
    assert short["status"] == "too_short" and short["coef"] is None


def test_random_walk_is_not_stationary():
    rng = np.random.default_rng(1)
    steps = rng.normal(size=800)
    assert not V._is_stationary(np.cumsum(steps)) and V._is_stationary(steps)
    assert not V._is_stationary(np.ones(50))


@pytest.fixture(scope="module")
def stacked(spark):
    rng = np.random.default_rng(0)
    n = 240
    y = rng.uniform(0, 50, n)
    pdf = pd.DataFrame({"ds": days(n), "y": y, "m1": y + rng.normal(0, 1, n), "m2": y / 2 + rng.normal(0, 6, n)})
    return spark.createDataFrame(pdf), pdf


def test_ridge_matches_closed_form(stacked):
    df, pdf = stacked
    x, y = pdf[["m1", "m2"]].to_numpy(), pdf.y.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ yc)
    got = {r["model"]: r["weight"] for r in ST.stacked_weights(df, ["m1", "m2"]).collect()}
    np.testing.assert_allclose([got["m1"], got["m2"]], want, rtol=1e-6)


@pytest.mark.parametrize("name, ratio", [("lasso", 1.0), ("elastic_net", 0.5)])
def test_sparse_learners_reach_their_optimum(stacked, name, ratio):
    df, pdf = stacked
    x, y = pdf[["m1", "m2"]].to_numpy(), pdf.y.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.zeros(2)
    for _ in range(500):  # coordinate descent on the stated objective
        for j in range(2):
            rest = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ rest / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - 0.1 * ratio, 0) / (xc[:, j] @ xc[:, j] / len(y) + 0.1 * (1 - ratio))
    got = {r["model"]: r["weight"] for r in ST.stacked_weights(df, ["m1", "m2"], name).collect()}
    np.testing.assert_allclose([got["m1"], got["m2"]], w, rtol=1e-3, atol=1e-4)


def test_stacked_choice_and_best(stacked):
    df, _ = stacked
    scores = ST.cv_scores(df, ["m1", "m2"], ("ridge", "lasso", "random_forest"), 2)
    assert scores.first()["candidate"] in ("ridge", "lasso")
    lost = df.withColumn("m2", F.when(F.col("ds") != F.lit(days(5)[-1]), F.col("m2")))
    out = ST.ensemble_stacked(lost, ["m1", "m2"])
    assert out.count() == 240 and out.where("ensemble IS NULL").count() == 1
    best = to_pandas(ST.ensemble_best(df, ["m1", "m2"], candidates=("ridge", "lasso")))
    assert best[best.is_best].method.tolist() == ["meta_learner"] and best.rmse.min() == best[best.is_best].rmse.iloc[0]


def test_grid_search_gbt(stacked):
    df, _ = stacked
    out = B.grid_search_gbt(df, ["m1", "m2"], {"maxDepth": [1, 3]}, ["ds"], n_splits=2, maxIter=4)
    got = out.collect()
    assert [r["rank"] for r in got] == [1, 2] and got[0]["rmse"] <= got[1]["rmse"] and got[0]["maxDepth"] == 3


def test_pooled_batch_scoring(stacked):
    df, _ = stacked
    fitted = B.fit_gbt(df.withColumn("is_validation", F.lit(False)), ["m1", "m2"], max_iter=2, early_stopping=False)
    rows = df.select(F.lit("a").alias("k"), F.col("ds").alias("date"), "m1", "m2")
    out = to_pandas(SC.score_batch_pooled(rows, fitted, ["k"], ["m1", "m2"], 4), "ds")
    assert len(out) == 4 and out.yhat.nunique() == 1 and out.ds[0] == days(241)[-1]


def test_requests_without_steps_and_with_months(spark):
    from demandloom.operators.forecast import additive as AD
    from demandloom.operators.forecast import scoring as SC

    history = spark.sql("select 'm' model_id, explode(sequence(date'2020-01-01', date'2020-03-31')) ds").withColumn("y", F.dayofmonth("ds").cast("double"))
    models = AD.fit_additive(history, ["model_id"])
    asked = [("a", 0, "D", False), ("b", 0, "D", True), ("c", -3, "D", False), ("d", 2, "M", False), ("e", 1, "Q", False)]
    requests = spark.createDataFrame([(i, "m", h, f, p) for i, h, f, p in asked], "request_id string, model_id string, horizon int, freq string, include_history boolean")
    got = SC.score_requests(requests, models).collect()
    by = {i: sorted(str(r.ds) for r in got if r.request_id == i) for i, *_ in asked}
    status = {r.request_id: r.status for r in got}
    assert status == {"a": "ok", "b": "ok", "c": "bad_request", "d": "ok", "e": "bad_request"}
    assert by["a"] == ["None"] and len(by["b"]) == 91 and by["d"] == ["2020-04-30", "2020-05-31"]


def test_multiplicative_needs_values_above_minus_one(spark):
    from demandloom.operators.forecast import additive as AD

    history = spark.sql("select 1 k, explode(sequence(date'2020-01-01', date'2020-03-31')) ds").withColumn("y", F.lit(-2.0))
    model = AD.fit_additive(history, ["k"], AD.AdditiveSpec(mode="multiplicative")).first()
    assert model.status == "failed" and "multiplicative" in model.error
