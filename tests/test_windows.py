import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import to_pandas

from demandloom.operators import windows as W

SCHEMA = "k string, date date, x double"
FUNCS = ("mean", "std", "min", "max", "median", "sum")


def frame(n, seed=0, holes=0.2, keys=("a", "b")):
    rng = np.random.default_rng(seed)
    out = []
    for k in keys:
        for i in range(n):
            v = None if rng.random() < holes else float(rng.integers(0, 30))
            out.append((k, dt.date(2000, 1, 1) + dt.timedelta(days=i), v))
    rng.shuffle(out)
    return [(k, d, v) for k, d, v in out]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(frame(50), SCHEMA)
    return df, to_pandas(df, "k", "date")


def per_series(pdf, fn):
    return pd.concat([fn(g["x"].astype(float)) for _, g in pdf.groupby("k")]).to_numpy()


def close(got, want):
    np.testing.assert_allclose(got.astype(float), want, rtol=1e-9, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("func", FUNCS)
@pytest.mark.parametrize("full", [True, False])
def test_rolling(table, func, full):
    df, pdf = table
    got = to_pandas(W.rolling(df, "x", (7,), (func,), ["k"], full=full), "k", "date")
    close(got[f"x_rolling_7_{func}"], per_series(pdf, lambda s: getattr(s.rolling(7, min_periods=7 if full else 1), func)()))


@pytest.mark.parametrize("func", FUNCS)
def test_expanding(table, func):
    df, pdf = table
    got = to_pandas(W.expanding(df, "x", (func,), ["k"]), "k", "date")
    close(got[f"x_expanding_{func}"], per_series(pdf, lambda s: getattr(s.expanding(1), func)()))


def test_lags_diffs_and_lagged_mean(table):
    df, pdf = table
    got = to_pandas(W.lagged_roll_mean(W.diffs(W.lags(df, "x", (1, 7), ["k"]), "x", (1, 7), ["k"]), "x", 7, ["k"]), "k", "date")
    close(got["x_lag_7"], per_series(pdf, lambda s: s.shift(7)))
    close(got["x_diff_7"], per_series(pdf, lambda s: s.diff(7)))
    close(got["x_lag_7d_avg"], per_series(pdf, lambda s: s.shift(1).rolling(7).mean()))
    assert W.lags(df, "x", (1,), ["k"], drop_null=True).where("x_lag_1 IS NULL").count() == 0


@pytest.mark.parametrize("span", [2, 7, 30])
def test_ewm_long_series_does_not_overflow(spark, span):
    df = spark.createDataFrame(frame(3000, 1, 0.1, ("a",)), SCHEMA)
    got = to_pandas(W.ewm_mean(df, "x", (span,), ["k"], names=["e"]), "date")
    pdf = to_pandas(df, "date")
    close(got["e"], pdf["x"].astype(float).ewm(span=span).mean().to_numpy())


def test_ewm_leading_nulls(spark):
    data = [("a", dt.date(2020, 1, 1 + i), v) for i, v in enumerate([None, None, 4.0, None, 8.0])]
    got = to_pandas(W.ewm_mean(spark.createDataFrame(data, SCHEMA), "x", (7,), ["k"], names=["e"]), "date")
    close(got["e"], pd.Series([None, None, 4.0, None, 8.0], dtype=float).ewm(span=7).mean().to_numpy())


def test_rank_and_scaling(table):
    df, pdf = table
    got = to_pandas(W.pct_rank_avg(df, "x", ["k"], "p"), "k", "date")
    close(got["p"], per_series(pdf, lambda s: s.rank(pct=True)))
    scaled = to_pandas(W.group_scaled(df, "x", ["k"]), "k", "date")
    close(scaled["zscore"], per_series(pdf, lambda s: (s - s.mean()) / s.std()))
    close(scaled["normalized"], per_series(pdf, lambda s: (s - s.min()) / (s.max() - s.min())))


def test_velocity_bundle(spark):
    df = spark.createDataFrame(frame(80, 5, 0.0), SCHEMA)
    pdf = to_pandas(df, "k", "date")
    got = to_pandas(W.sales_velocity_features(df, "x", ["k"]), "k", "date")
    close(got["sales_velocity_7d"], per_series(pdf, lambda s: s.diff().rolling(7).mean()))
    close(got["sales_accel_7d"], per_series(pdf, lambda s: s.diff().rolling(7).mean().diff()))
    close(got["sales_trend"], per_series(pdf, lambda s: s.ewm(span=7).mean() / s.ewm(span=30).mean()))


def test_constant_and_single_row_series(spark):
    data = [("c", dt.date(2020, 1, 1 + i), 5.0) for i in range(4)] + [("s", dt.date(2020, 1, 1), 1.0)]
    got = to_pandas(W.sales_velocity_features(spark.createDataFrame(data, SCHEMA), "x", ["k"]), "k", "date")
    assert got["sales_zscore"].isna().all() and got["sales_normalized"].isna().all()
