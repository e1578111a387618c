"""Model tables that describe themselves, and requests for every kind of model."""

import datetime as dt

import numpy as np
import pytest
from conftest import to_pandas
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandloom.operators.forecast import additive as AD
from demandloom.operators.forecast import boosted as B
from demandloom.operators.forecast import scoring as SC
from demandloom.operators.forecast import var as V

START = dt.date(2021, 1, 1)


@pytest.fixture(scope="module")
def history(spark):
    rows = [(k, START + dt.timedelta(days=i), 50.0 + j * 10 + i % 7 + 0.05 * i, float(i % 5 == 0)) for j, k in enumerate("ab") for i in range(200)]
    return spark.createDataFrame([*rows, ("short", START, 1.0, 0.0)], "k string, ds date, y double, promo double")


MULTI = AD.AdditiveSpec(mode="multiplicative", weekly_order=2, yearly_order=1, interval=0.95)


def test_settings_come_with_the_models(spark, history, tmp_path):
    """Models of two settings in one table, written and read, score as their own settings say."""
    one = AD.fit_additive(history.where("k = 'a'"), ["k"], MULTI)
    two = AD.fit_additive(history.where("k <> 'a'"), ["k"], AD.AdditiveSpec(yearly_order=0), regressors=["promo"])
    SC.write_models(one.unionByName(two), str(tmp_path / "m"))
    models = SC.read_models(spark, str(tmp_path / "m"))
    got = to_pandas(AD.score_additive(history, models, ["k"]), "k", "ds")
    a = to_pandas(AD.score_additive(history.where("k = 'a'"), one, ["k"], MULTI), "ds")
    b = to_pandas(AD.score_additive(history.where("k = 'b'"), two, ["k"], AD.AdditiveSpec(yearly_order=0), ["promo"]), "ds")
    for k, want in (("a", a), ("b", b)):
        np.testing.assert_allclose(got[got.k == k].yhat.astype(float), want.yhat.astype(float))
        np.testing.assert_allclose(got[got.k == k].yhat_upper.astype(float), want.yhat_upper.astype(float))
    ahead = history.where("k = 'b'").select("k", F.date_add("ds", 200).alias("ds"), F.lit(1.0).alias("promo"))
    batch = SC.score_batch(history.withColumnRenamed("ds", "date"), models, ["k"], 5, future=ahead)
    assert batch.groupBy("k").count().collect() and batch.count() == 10 and batch.columns == ["k", "ds", "yhat", "yhat_lower", "yhat_upper"]


def test_other_settings_stop_the_query(history):
    models = AD.fit_additive(history, ["k"], MULTI)
    with pytest.raises(PySparkException, match="other settings"):
        AD.score_additive(history, models, ["k"], AD.AdditiveSpec()).collect()
    assert AD.score_additive(history, models, ["k"], MULTI).count() == 400


def test_forecasts_have_a_row_for_every_series(spark, history):
    bad = spark.createDataFrame([("bad", START + dt.timedelta(days=i), float("inf") if i == 3 else 1.0, 0.0) for i in range(30)], history.schema)
    out = to_pandas(AD.forecast_additive(history.unionByName(bad), ["k"], 10), "k", "ds")
    assert out.groupby(["k", "status"]).size().to_dict() == {("a", "ok"): 210, ("b", "ok"): 210, ("bad", "failed"): 1, ("short", "too_short"): 1}
    assert "finite" in out[out.k == "bad"].error.item() and out[out.status == "ok"].yhat.notna().all()
    parts = to_pandas(AD.forecast_components(history, ["k"]), "k", "ds")
    assert parts[parts.k == "short"].status.tolist() == ["too_short"]


def test_requests_for_every_kind(spark, history):
    additive = AD.fit_additive(history, ["k"]).withColumnRenamed("k", "model_id")
    pairs = history.withColumn("x", F.col("y") * 0.5 + F.col("promo"))
    var = V.var_fit(pairs, ["y", "x"], ["k"], "ds", max_lags=2).withColumnRenamed("k", "model_id")
    rows = history.withColumn("is_validation", F.lit(False))
    pooled = B.fit_gbt(rows, ["promo"], max_iter=2, early_stopping=False)
    asked = [
        ("r1", "a", 2, "additive", None), ("r2", "a", 3, "var", None), ("r3", "b", None, "var", None), ("r4", "zzz", 2, "var", None), ("r5", "short", 2, "var", None),
        ("r6", "any", None, "pooled", [1.0]), ("r7", "any", None, "pooled", None), ("r8", "any", None, "pooled", [1.0, 2.0]), ("r9", None, 1, "pooled", [1.0]),
        ("s1", "a", 0, "var", None), ("s2", "a", -1, "var", None), ("s3", "a", 1, "tree", None), ("s4", "short", 1, None, None),
    ]
    requests = spark.createDataFrame(asked, "request_id string, model_id string, horizon int, model_type string, features array<double>")
    out = to_pandas(SC.score_requests(requests, additive, var_models=var, var_columns=["y", "x"], pooled=pooled, pooled_features=["promo"]), "request_id", "variable", "ds")
    assert out.groupby(["request_id", "status"]).size().to_dict() == {
        ("r1", "ok"): 2, ("r2", "ok"): 6, ("r3", "ok"): 60, ("r4", "not_found"): 1, ("r5", "not_found"): 1, ("r6", "ok"): 1, ("r7", "missing_features"): 1,
        ("r8", "missing_features"): 1, ("r9", "missing_id"): 1, ("s1", "ok"): 1, ("s2", "bad_request"): 1, ("s3", "bad_request"): 1, ("s4", "not_found"): 1,
    }
    want = to_pandas(V.var_forecast(var.where("model_id = 'a'"), ["y", "x"], ["model_id"], 3), "variable", "ds")
    np.testing.assert_allclose(out[out.request_id == "r2"].yhat.astype(float), want.yhat.astype(float))
    assert out[out.request_id == "r6"].yhat.notna().all() and out[out.request_id == "r6"].ds.isna().all()
    without = SC.score_requests(requests, additive).groupBy("status").count().collect()
    assert {r.status for r in without} == {"ok", "missing_id", "bad_request", "not_found"}


def test_batches_of_autoregressions_follow_the_input(spark, history):
    pairs = history.withColumn("x", F.col("y") * 0.5 + F.col("promo"))
    var = V.var_fit(pairs, ["y", "x"], ["k"], "ds", max_lags=2)
    later = pairs.where("k <> 'short'").select("k", F.date_add("ds", 4).alias("date"))
    out = to_pandas(SC.score_batch_var(later, var, ["y", "x"], ["k"], 3), "k", "variable", "ds")
    assert len(out) == 12 and out.ds.min() == START + dt.timedelta(days=204) and out.ds.max() == START + dt.timedelta(days=206)
    whole = to_pandas(V.var_forecast(var.where("k = 'a'"), ["y", "x"], ["k"], 7), "variable", "ds")
    np.testing.assert_allclose(out[(out.k == "a") & (out.variable == "x")].yhat.astype(float), whole[whole.variable == "x"].yhat.astype(float)[4:])
