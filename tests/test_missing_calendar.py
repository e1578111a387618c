import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.operators import calendar as C
from demandloom.operators import missing as M

SCHEMA = "k string, date date, x double"


def rows(values, key="a", start=dt.date(2020, 1, 1), step=1):
    return [(key, start + dt.timedelta(days=i * step), v) for i, v in enumerate(values)]


@pytest.fixture(scope="module")
def gaps(spark):
    a = [None, None, 3.0, None, 5.0, None, None, 11.0, None]
    b = [100.0, None, None, 40.0]
    none = [None, None]
    data = rows(a) + rows(b, "b") + rows(none, "c")
    return spark.createDataFrame(data[::-1], SCHEMA)


@pytest.mark.parametrize("method", ["ffill", "bfill", "interpolate"])
@pytest.mark.parametrize("edges", [True, False])
def test_fill_matches_pandas_per_series(gaps, method, edges):
    got = to_pandas(M.fill(gaps, "x", method, ["k"], "date", edges=edges), "k", "date")
    want = []
    for _, g in to_pandas(gaps, "k", "date").groupby("k"):
        x = g["x"].astype(float)
        if method == "ffill":
            x = x.ffill().bfill() if edges else x.ffill()
        elif method == "bfill":
            x = x.bfill().ffill() if edges else x.bfill()
        else:
            x = x.interpolate(method="linear")
            x = x.ffill().bfill() if edges else x
        want.append(x)
    np.testing.assert_allclose(got["x"].astype(float), pd.concat(want).to_numpy(), equal_nan=True)


@pytest.mark.parametrize("method", ["ffill", "bfill"])
@pytest.mark.parametrize("edges", [True, False])
def test_whole_table_fill_matches_pandas(spark, method, edges):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"date": np.repeat(np.arange(12), 7), "k": list(range(7)) * 12})
    pdf["x"] = np.where(rng.random(84) < 0.8, np.nan, np.arange(84.0))
    pdf.loc[pdf.date.isin([0, 4, 5, 11]), "x"] = np.nan
    df = spark.createDataFrame([(int(d), int(k), None if np.isnan(x) else x) for d, k, x in pdf.itertuples(index=False)][::-1],
                               "date int, k int, x double")
    got = to_pandas(M.fill(df, "x", method, (), ["date", "k"], edges), "date", "k")["x"].astype(float)
    want = getattr(pdf["x"], method)()
    if edges:
        want = want.bfill() if method == "ffill" else want.ffill()
    np.testing.assert_allclose(got, want, equal_nan=True)


def test_statistics_and_mode(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, "b"), (8.0, "a"), (None, None)], "x double, s string")
    assert M.fill_statistic(df, "mean", ["x"]).agg(F.sum("x")).first()[0] == 20.0
    assert M.fill_statistic(df, "median", ["x"]).agg(F.sum("x")).first()[0] == 18.0
    # a and b are equally frequent: the smaller one wins.
    assert M.fill_mode(df).where("s = 'a'").count() == 3
    assert {r["column"]: r["missing"] for r in M.missing_report(df).collect()} == {"x": 2, "s": 1}


def test_handle_missing_strategies(gaps):
    assert M.handle_missing(gaps, "drop").count() == 5
    assert M.handle_missing(gaps, "zero").where("x = 0").count() == 10
    with pytest.raises(ValueError):
        M.handle_missing(gaps, "other", ["k"])


def test_clean_sales_chooses_by_share(spark):
    n = 100
    data = [
        ("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), None if i == 50 else float(i), None if i % 10 == 5 else float(i),
         None if i % 3 == 0 else float(i), None if i == 7 else "p")
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "k string, date date, few double, some double, many double, s string")
    out = to_pandas(M.clean_sales(df, ["k"]), "date")
    few = [i for i in range(n) if i != 50]
    assert out["few"][50] == pytest.approx(np.mean(few))
    assert out["some"][25] == 24.0
    assert out["many"][3] == np.median([i for i in range(n) if i % 3])
    assert out["s"][7] == "p"


def test_calendar_fill_is_dense_and_keeps_series_apart(spark):
    df = spark.createDataFrame(rows([1.0, 2.0, 5.0], step=3) + rows([9.0], "b"), SCHEMA)
    out = to_pandas(C.calendar_fill(df, ["k"], method="ffill"), "k", "date")
    assert out["x"].tolist() == [1, 1, 1, 2, 2, 2, 5, 9]
    zero = to_pandas(C.calendar_fill(df, ["k"], method="zero"), "k", "date")
    assert zero["x"].tolist() == [1, 0, 0, 2, 0, 0, 5, 9]
    assert to_pandas(C.missing_dates(df, ["k"])).shape[0] == 4


@pytest.mark.parametrize("freq, alias", [("D", "D"), ("W", "W"), ("M", "ME"), ("Q", "QE"), ("Y", "YE")])
@pytest.mark.parametrize("agg", ["sum", "mean", "median", "min", "max"])
def test_resample_matches_pandas(spark, freq, alias, agg):
    rng = np.random.default_rng(3)
    days = sorted({dt.date(2019, 11, 5) + dt.timedelta(days=int(d)) for d in rng.integers(0, 800, 40)})
    data = [("a", d, float(rng.integers(0, 50))) for d in days]
    got = to_pandas(C.resample(spark.createDataFrame(data, SCHEMA), ["x"], freq, agg, ["k"]), "date")
    series = pd.Series([r[2] for r in data], pd.to_datetime([r[1] for r in data]))
    want = series.resample(alias).agg(agg)
    assert [d.isoformat() for d in got["date"]] == [d.date().isoformat() for d in want.index]
    np.testing.assert_allclose(got["x"].astype(float), want.to_numpy(), equal_nan=True)


def test_clean_external_dedupes_and_interpolates(spark):
    data = [(dt.date(2020, 1, 1), 1.0), (dt.date(2020, 1, 1), 9.0), (dt.date(2020, 1, 4), 4.0)]
    out = to_pandas(C.clean_external(spark.createDataFrame(data, "date date, x double"), "x"), "date")
    assert out["x"].tolist() == [1.0, 2.0, 3.0, 4.0]


def test_preprocess_series_clips_like_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, 60)
    x[[5, 40]] = [50.0, -40.0]
    values = [None if i % 9 == 0 else float(v) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows(values) + rows([2.0, 2.0, 2.0], "flat"), SCHEMA)
    out = to_pandas(C.preprocess_series(df, ["k"]), "k", "date")
    s = pd.Series(values, dtype=float).ffill().bfill()
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    want = s.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    np.testing.assert_allclose(out[out.k == "a"]["x"], want)
    assert out[out.k == "flat"]["x"].tolist() == [2.0, 2.0, 2.0]


def test_empty_frame(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.fill(empty, "x", "interpolate", ["k"]).count() == 0
    assert C.calendar_fill(empty, ["k"]).count() == 0
    assert C.resample(empty, ["x"], "W", "sum", ["k"]).count() == 0
