import numpy as np
import pandas as pd
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.operators import outliers as O
from demandloom.operators import scaling as S
from demandloom.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows and one value most of its rows; another group is tiny; NULL keys and values occur."""
    rng = np.random.default_rng(7)
    hot = np.where(rng.random(6000) < 0.6, 5.0, rng.lognormal(1, 2, 6000))
    data = [("hot", float(v)) for v in hot] + [("few", 1.0), ("few", 4.0), ("one", 9.0), (None, 2.0), (None, 8.0), ("hot", None)]
    data += [("mid", float(v)) for v in rng.normal(0, 1, 500)]
    return spark.createDataFrame(data, "k string, x double").repartition(6), data


def test_exact_quantiles_by_group(skewed):
    df, data = skewed
    got = {r["k"]: list(r[1:]) for r in exact_quantiles(df, "x", PROBS, ["k"]).collect()}
    for k in ("hot", "few", "one", "mid", None):
        values = [v for g, v in data if g == k and v is not None]
        np.testing.assert_allclose(got[k], np.quantile(values, PROBS), rtol=1e-12)


def test_exact_quantiles_whole_table(skewed):
    df, data = skewed
    values = [v for _, v in data if v is not None]
    np.testing.assert_allclose(list(exact_quantiles(df, "x", PROBS).first()), np.quantile(values, PROBS), rtol=1e-12)
    # Any number of ranges gives the same answer.
    np.testing.assert_allclose(list(exact_quantiles(df, "x", PROBS, ranges=3).first()), np.quantile(values, PROBS), rtol=1e-12)


def test_handle_outliers_grouped(skewed):
    df, data = skewed
    pdf = pd.DataFrame(data, columns=["k", "x"])
    trimmed = O.handle_outliers(df, "trim", "x", (0.05, 0.05), groupby="k")
    want = int(pdf.k.isna().sum())
    for _, g in pdf.groupby("k"):
        lo, hi = np.quantile(g.x.dropna(), [0.05, 0.95])
        want += g.x.between(lo, hi).sum()
    assert trimmed.count() == want
    z = O.handle_outliers(df.where("x IS NOT NULL"), "zscore", "x", threshold=2.0, groupby="k")
    want = int(pdf.k.isna().sum())
    for _, g in pdf.dropna().groupby("k"):
        sd = g.x.std(ddof=0)
        want += len(g) if sd == 0 else int((((g.x - g.x.mean()) / sd).abs() <= 2.0).sum())
    assert z.count() == want


def test_winsorize_caps_and_keeps_rows(skewed):
    df, _ = skewed
    out = O.handle_outliers(df, "winsorize", "x")
    lo, hi = exact_quantiles(df, "x", [0.01, 0.99]).first()
    stats = out.agg(F.min("x"), F.max("x"), F.count(F.lit(1)), F.count("x")).first()
    assert stats[0] == pytest.approx(lo) and stats[1] == pytest.approx(hi)
    assert stats[2] == df.count() and stats[3] == df.where("x IS NOT NULL").count()


def test_sequential_removal(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 400), "b": rng.normal(0, 1, 400)})
    pdf.loc[0, "a"], pdf.loc[0, "b"], pdf.loc[1, "b"] = 60.0, 900.0, 12.0
    got = O.remove_outliers(spark.createDataFrame(pdf), ["a", "b", "nope"], "zscore", 3.0).count()
    for c in ("a", "b"):
        pdf = pdf[((pdf[c] - pdf[c].mean()) / pdf[c].std()).abs() <= 3.0]
    assert got == len(pdf)


def test_detect_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    assert O.detect_outliers(df, "x", "iqr").where("x IS NULL").first()["is_outlier"] is True
    assert O.detect_outliers(df, "x", "zscore").where("x IS NULL").first()["is_outlier"] is False


@pytest.mark.parametrize("method", S.METHODS)
def test_inverse_undoes_transform(spark, method):
    df = spark.createDataFrame([(float(v),) for v in (-3, 0, 1, 2, 2, 40)], "x double")
    params = S.transform_params(df, "x", method)
    back = S.inverse_transform(S.transform(df, "x", params, method), "x", params, method)
    np.testing.assert_allclose(to_pandas(back, "x")["x"], [-3, 0, 1, 2, 2, 40], atol=1e-6)


def test_boxcox_lambda_against_fine_grid(spark):
    x = np.random.default_rng(2).gamma(2.0, 3.0, 500) + 0.1
    got = S.boxcox_lambda(spark.createDataFrame(pd.DataFrame({"x": x})), "x")

    def llf(lam):
        y = np.log(x) if abs(lam) < 1e-9 else (x**lam - 1) / lam
        return (lam - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    grid = np.arange(-2, 2.0005, 0.001)
    assert abs(got - grid[np.argmax([llf(v) for v in grid])]) <= 0.0021


def test_scale_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.x for r in S.scale_features(df, ["x"]).collect()] == [0.0, 0.0]
    assert [r.x for r in S.scale_features(df, ["x"], "minmax").collect()] == [0.0, 0.0]


@pytest.mark.parametrize("method", ["winsorize", "trim", "zscore", "iqr"])
@pytest.mark.parametrize("keys", [None, "k"])
def test_many_columns_equal_one_by_one_and_plan_fast(spark, method, keys):
    import time

    rng = np.random.default_rng(3)
    names = [f"c{i}" for i in range(8)]
    rows = [(["a", "b"][i % 2], *map(float, rng.lognormal(0, 1, 8))) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, " + ", ".join(f"{c} double" for c in names))
    start = time.time()
    got = O.handle_outliers(df, method, names, groupby=keys)
    got._jdf.queryExecution().executedPlan()
    assert time.time() - start < 60
    want = pd.DataFrame(rows, columns=["k", *names])
    for c in names:
        g = want.groupby("k")[c] if keys else want.assign(_=0).groupby("_")[c]
        if method in ("winsorize", "trim"):
            lo, hi = g.transform(lambda x: x.quantile(0.01)), g.transform(lambda x: x.quantile(0.99))
            if method == "winsorize":
                want[c] = want[c].clip(lo, hi)
            else:
                want = want[want[c].between(lo, hi)]
        elif method == "zscore":
            want = want[((want[c] - g.transform("mean")).abs() / g.transform(lambda x: x.std(ddof=0))) <= 3]
        else:
            a, b = g.transform(lambda x: x.quantile(0.25)), g.transform(lambda x: x.quantile(0.75))
            want = want[want[c].between(a - 1.5 * (b - a), b + 1.5 * (b - a))]
    pd.testing.assert_frame_equal(to_pandas(got, *names), want.sort_values(names).reset_index(drop=True), rtol=1e-9)


@pytest.mark.parametrize("power", [0.2, -0.25, 0.0, 3.0])
def test_boxcox_lambda_has_no_bounds(spark, power):
    """Powers of normal values: lambda is about 1 / power, also beyond 2, and the likelihood's top on a fine grid."""
    from demandloom.operators import scaling as S

    rng = np.random.default_rng(5)
    base = rng.normal(10, 1, 4000)
    x = np.exp(base - 10) if power == 0 else base**power
    got = S.boxcox_lambda(spark.createDataFrame([(float(v),) for v in x], "x double"), "x")
    log = np.log(x)

    def likelihood(lam):
        y = log if abs(lam) < 1e-9 else (x**lam - 1) / lam
        return (lam - 1) * log.mean() - np.log(y.var()) / 2

    grid = np.arange(got - 0.5, got + 0.5, 0.001)
    best = grid[np.argmax([likelihood(v) for v in grid])]
    assert abs(got - best) < 0.003
    assert abs(got - (0 if power == 0 else 1 / power)) < 1.5


def test_boxcox_lambda_of_constants(spark):
    from demandloom.operators import scaling as S

    assert S.boxcox_lambda(spark.createDataFrame([(2.0,)] * 5, "x double"), "x") == 1.0
    assert S.boxcox_lambda(spark.createDataFrame([], "x double"), "x") == 1.0
