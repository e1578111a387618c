"""Pooled boosting on a calendar: lags, kinds, statuses, saved models and folds."""

import datetime as dt

import numpy as np
import pytest
from conftest import to_pandas
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from demandloom.operators.aggregate import ts_cv_folds
from demandloom.operators.forecast import boosted as B
from demandloom.operators.forecast import scoring as SC

START = dt.date(2021, 1, 1)


def line(key, n, skip=(), slope=1.0):
    return [(key, START + dt.timedelta(days=i), slope * i) for i in range(n) if i not in skip]


def test_lags_and_horizon_count_days(spark):
    """On a line with missing days a lag of k days is k below, whatever is missing; filled days are no targets."""
    skip = {0, 31, 32, 33, 50, 77, 78}
    df = spark.createDataFrame(line("a", 120, skip), "k string, ds date, y double")
    rows = to_pandas(B.training_rows(df, ["k"], 6), "ds")
    for lag in B.LAGS:
        assert np.allclose(rows.y - rows[f"lag_{lag}"], rows.h + lag - 1)
    number = [(d - START).days for d in rows.ds]
    assert not set(number) & skip and np.allclose(rows.y, number) and min(number) >= 29 and max(number) == 119
    assert set(rows.h) == {1, 2, 3, 4, 5, 6}
    past = to_pandas(B.history_rows(df, ["k"]), "ds")
    assert np.allclose(past.y - past.lag_28, 28) and not {(d - START).days for d in past.ds} & skip
    ahead = to_pandas(B.future_rows(df, ["k"], 4), "ds")
    assert ahead.ds.tolist() == [START + dt.timedelta(days=120 + i) for i in range(4)] and set(ahead.lag_7) == {113.0}
    zero = to_pandas(B.history_rows(df, ["k"], gaps="zero"), "ds")
    assert zero.loc[zero.ds == START + dt.timedelta(days=34), "lag_1"].item() == 0.0


def test_no_array_columns_in_the_plan(spark):
    df = spark.createDataFrame(line("a", 60), "k string, ds date, y double")
    text = B.training_rows(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in text and "CartesianProduct" not in text


def test_every_series_has_a_row(spark):
    rows = line("a", 90) + line("b", 80, {40}) + line("short", 20) + [("nan", START, float("nan")), ("inf", START, float("inf")), ("inf", START + dt.timedelta(days=1), 3.0)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    got = to_pandas(B.forecast_gbt(df, ["k"], 5, max_iter=3), "k", "ds")
    count = got.groupby(["k", "status"]).size().to_dict()
    assert count == {("a", "ok"): 90 - 28 + 5, ("b", "ok"): 79 - 28 + 5, ("short", "too_short"): 1, ("inf", "too_short"): 1}
    assert got[got.status == "ok"].yhat.notna().all() and got[got.status != "ok"].yhat.isna().all()


def test_kinds_split_as_sets(spark, tmp_path):
    """Levels that alternate along the alphabet need one split on a set of kinds; a saved model scores alike."""
    rng = np.random.default_rng(0)
    rows = [(f"s{i % 8}", START + dt.timedelta(days=i // 8), float((i % 8) % 2 * 100 + rng.normal())) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, ds date, y double").withColumn("kind", F.col("k"))
    train = B.training_rows(df, ["k"], 2, (1,), categorical=["kind"])
    assert train.where("kind IS NULL").count() == 0
    model = B.fit_gbt(train, ["kind"], max_iter=1, max_depth=1, step_size=1.0, categorical=["kind"])
    assert model.stages[-1].trees[0].numNodes == 3
    out = model.transform(train)
    assert out.agg(F.max(F.abs(F.col("yhat") - F.col("y")))).first()[0] < 10
    B.write_pooled(model, str(tmp_path / "m"))
    again = B.read_pooled(str(tmp_path / "m"))
    unseen = train.limit(5).withColumn("kind", F.lit("never seen"))
    assert [r.yhat for r in again.transform(train).orderBy("k", "ds").collect()] == [r.yhat for r in out.orderBy("k", "ds").collect()]
    assert again.transform(unseen).where("yhat IS NULL").count() == 0
    future = to_pandas(SC.score_batch_pooled(df.withColumnRenamed("ds", "date"), again, ["k"], ["kind"], 3), "k", "ds")
    assert len(future) == 24 and future[future.k == "s1"].yhat.min() > 90
    full = to_pandas(B.forecast_gbt(df, ["k"], 3, (1,), categorical=["kind"], max_iter=2), "k", "ds")
    assert set(full.status) == {"ok"} and len(full) == 8 * (100 - 1 + 3)


def test_grid_over_blocks_equals_copied_folds(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 2))
    rows = [(START + dt.timedelta(days=i), float(a), float(b), float(3 * a + rng.normal())) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows, "ds date, m1 double, m2 double, y double")
    got = {r.maxDepth: r.rmse for r in B.grid_search_gbt(df, ["m1", "m2"], {"maxDepth": [1, 2]}, ["ds"], n_splits=3, maxIter=3).collect()}
    folds = B.assemble(ts_cv_folds(df, "ds", n_splits=3), ["m1", "m2"])
    for depth, rmse in got.items():
        each = []
        for f in range(3):
            gbt = GBTRegressor(labelCol="y", predictionCol="yhat", seed=42, maxDepth=depth, maxIter=3)
            part = folds.where(F.col("fold") == f)
            tested = gbt.fit(part.where("role = 'train'")).transform(part.where("role = 'test'"))
            each.append(tested.agg(F.sqrt(F.avg((F.col("yhat") - F.col("y")) ** 2))).first()[0])
        assert rmse == pytest.approx(sum(each) / 3, rel=0.05)
    with pytest.raises(ValueError, match="too few"):
        B.grid_search_gbt(df.limit(2), ["m1", "m2"], {"maxDepth": [1]}, ["ds"])
