"""NaN is NULL from the readers on."""

import math

import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.operators import aggregate as A
from demandloom.operators import missing as M
from demandloom.operators import windows as W
from demandloom.sources.io import scan_table


@pytest.fixture
def read(spark, tmp_path):
    rows = [("a", 1, 4.0, 1.0), ("a", 2, float("nan"), 2.0), ("a", 3, 8.0, float("nan")), ("a", 4, None, 4.0), ("b", 1, float("nan"), 1.0)]
    spark.createDataFrame(rows, "k string, date int, x double, z float").write.parquet(str(tmp_path / "t"))
    return scan_table(spark, str(tmp_path / "t"), "parquet")


def values(df, column):
    return [None if v is None or math.isnan(v) else v for v in to_pandas(df, "k", "date")[column]]


def test_readers_give_null(spark, read, tmp_path):
    assert read.where("isnan(x) or isnan(z)").count() == 0 and read.where("x IS NULL").count() == 3
    assert scan_table(spark, str(tmp_path / "t"), "parquet", nan_as_null=False).where("isnan(x)").count() == 2


def test_every_fill_sees_it(read):
    assert values(M.fill(read, "x", "ffill", ["k"]), "x") == [4, 4, 8, 8, None]
    assert values(M.fill(read, "x", "bfill", ["k"]), "x") == [4, 8, 8, 8, None]
    assert values(M.fill(read, "x", "interpolate", ["k"]), "x") == [4, 6, 8, 8, None]
    assert values(M.fill_statistic(read, "mean", ["x"]), "x") == [4, 6, 8, 6, 6]
    assert values(M.fill_statistic(read, "median", ["x"]), "x") == [4, 6, 8, 6, 6]
    assert values(M.fill_zero(read), "x") == [4, 0, 8, 0, 0]
    assert {r["column"]: r["missing"] for r in M.missing_report(read).collect()} == {"k": 0, "date": 0, "x": 3, "z": 1}


def test_aggregates_and_windows_see_it(read):
    assert to_pandas(A.daily_totals(read, ["x"]), "date").x.dropna().tolist() == [4, 8]
    out = to_pandas(W.rolling(read, "x", (3,), ("mean", "max", "median"), ["k"]), "k", "date")
    assert out.x_rolling_3_mean.tolist()[:4] == [4, 4, 6, 8] and out.x_rolling_3_max.tolist()[:4] == [4, 4, 8, 8]
    assert out.x_rolling_3_median.tolist()[:4] == [4, 4, 6, 8]
    assert read.agg(F.avg("x")).first()[0] == 6
