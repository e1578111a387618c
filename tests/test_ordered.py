"""Ordered operators over a whole table against their windowed twins over one series."""

import datetime as dt
import statistics

import numpy as np
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.operators import aggregate as A
from demandloom.operators import missing as M
from demandloom.operators import ordered
from demandloom.operators import windows as W
from demandloom.operators.encode import one_hot_index
from demandloom.operators.medians import Frame, Growing, Sliding, with_medians

SCHEMA = "name string, part int, x double, y string, d date"


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 7)
    monkeypatch.setattr(ordered, "GROUPS", 3)


def table(spark, n=150, holes=0.4, seed=3):
    """Unique (name, part); long holes, also at both ends."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = None if rng.random() < holes or not 10 < i < n - 12 or 60 < i < 90 else float(rng.integers(0, 50))
        rows.append((f"n{i // 9:03d}" if i >= 5 else None, i, x, None if x is None else str(x), dt.date(2024, 1, 1) if i % 2 else None))
    rng.shuffle(rows)
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA).repartition(6)


ORDER = ["name", "part"]


def same(got, want):
    a, b = (to_pandas(df.select(*sorted(df.columns)), "part") for df in (got, want))
    assert list(a.columns) == list(b.columns) and len(a) == len(b)
    for c in a.columns:
        if a[c].dtype.kind == "f" or b[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=c)
        else:
            assert a[c].tolist() == b[c].tolist(), c


OPERATORS = {
    "lags": lambda d, k: W.lags(d, ["x", "y"], (1, 7, 30), k, ORDER),
    "rolling": lambda d, k: W.rolling(d, "x", (3, 20), ("mean", "std", "min", "max", "sum", "median"), k, ORDER),
    "rolling_full": lambda d, k: W.rolling(d, "x", (2, 9), ("mean", "median"), k, ORDER, full=True),
    "diffs": lambda d, k: W.diffs(d, "x", (1, 11), k, ORDER),
    "velocity": lambda d, k: W.velocity(d, "x", k, ORDER, (2, 5)),
    "lagged_roll_mean": lambda d, k: W.lagged_roll_mean(d, "x", 3, k, ORDER),
    "ffill": lambda d, k: M.fill(d, ["x", "y", "d"], "ffill", k, ORDER),
    "ffill_open": lambda d, k: M.fill(d, ["x", "y"], "ffill", k, ORDER, edges=False),
    "bfill": lambda d, k: M.fill(d, ["x", "y"], "bfill", k, ORDER),
    "bfill_open": lambda d, k: M.fill(d, ["x", "y"], "bfill", k, ORDER, edges=False),
    "interpolate": lambda d, k: M.fill(d, "x", "interpolate", k, ORDER),
    "interpolate_open": lambda d, k: M.fill(d, "x", "interpolate", k, ORDER, edges=False),
    "cv_folds": lambda d, k: A.ts_cv_folds(d, ORDER, k, 3).withColumn("part", F.col("part") * 10 + F.col("fold")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_whole_table_equals_one_series(spark, name):
    df, fn = table(spark), OPERATORS[name]
    got = fn(df, [])
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    same(got, fn(df.withColumn("one", F.lit(1)), ["one"]).drop("one"))


@pytest.mark.parametrize("spans", [(7, 30), (1, 3)])
def test_ewm_over_long_holes(spark, spans):
    """Weights by distance, also across holes longer than any memory of the weights."""
    df = table(spark)
    got = W.ewm_mean(df, "x", spans, [], ORDER)
    rows = df.orderBy(F.col("name").asc_nulls_first(), "part").collect()
    for span in spans:
        decay = 1 - 2 / (span + 1)
        want, total, weight = {}, 0.0, 0.0
        for r in rows:
            total, weight = total * decay, weight * decay
            if r.x is not None:
                total, weight = total + r.x, weight + 1
            if weight == 0 and want:
                want[r.part] = last
            else:
                want[r.part] = last = total / weight if weight else None
        have = {r.part: r[f"x_ewm_{span}"] for r in got.collect()}
        assert have.keys() == want.keys()
        for k, v in want.items():
            assert (have[k] is None) == (v is None) and (v is None or abs(have[k] - v) < 1e-9), (span, k)


def test_empty_and_tiny_tables(spark):
    for n in (0, 1, 3):
        df = table(spark).limit(n)
        for fn in OPERATORS.values():
            fn(df, []).collect()
        assert W.ewm_mean(df, "x", (7,), [], ORDER).count() == n


def test_positions_of_strings(spark):
    """Any order columns; a value with a third of all rows is dealt by the other columns."""
    df = table(spark, 300).withColumn("name", F.when(F.col("part") % 3 == 0, "hot").otherwise(F.col("name")))
    got = ordered.with_positions(df, ["name", "y"])
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    rows = sorted(got.collect(), key=lambda r: r._pos)
    keys = [((r.name is not None, r.name or ""), (r.y is not None, r.y or "")) for r in rows]
    assert [r._pos for r in rows] == list(range(300)) and keys == sorted(keys)


def test_index_and_split_by_strings(spark):
    df = spark.createDataFrame([(f"v{i * 37 % 1500:05d}",) for i in range(3000)] + [(None,)], "v string")
    out = one_hot_index(df, "v")
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert all((r.v_index is None) if r.v is None else r.v_index == int(r.v[1:]) for r in out.collect())
    split = A.time_split(spark.createDataFrame([(f"{i:03d}",) for i in range(200)], "v string").repartition(5), ["v"])
    assert [r.split for r in split.orderBy("v").collect()] == ["train"] * 140 + ["val"] * 30 + ["test"] * 30


def test_medians_of_frames():
    rng = np.random.default_rng(0)
    values = [None if rng.random() < 0.3 else float(rng.integers(0, 9)) for _ in range(400)]
    for rows, least in ((1, 1), (2, 1), (7, 1), (7, 7), (30, 3), (None, 1), (None, 5)):
        frame = Growing(least) if rows is None else Sliding(rows, least)
        for i, v in enumerate(values):
            known = [x for x in values[max(0, i + 1 - rows) if rows else 0 : i + 1] if x is not None]
            assert frame.push(v) == (statistics.median(known) if len(known) >= least else None)


def test_medians_cross_batches_and_series(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        df = spark.range(200).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("date"), ((F.col("id") * 7919) % 101).cast("double").alias("x"))
        df = df.withColumn("x", F.when(F.col("date") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("x")))
        got = with_medians(df, {"m": Frame("x", 4), "e": Frame("x")}, ["k"], "date").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for k in "012":
        rows = sorted((r for r in got if r.k == k), key=lambda r: r.date)
        for i, r in enumerate(rows):
            some = [x.x for x in rows[: i + 1] if x.x == x.x]
            last = [x.x for x in rows[max(0, i - 3) : i + 1] if x.x == x.x]
            assert r.e == (statistics.median(some) if some else None) and r.m == (statistics.median(last) if last else None)


def test_a_long_series_of_running_medians():
    rng, frame = np.random.default_rng(1), Growing(1)
    x = rng.normal(size=100_000)
    out = [frame.push(v) for v in x.tolist()]
    for i in (0, 1, 999, 50_000, 99_999):
        assert abs(out[i] - np.median(x[: i + 1])) < 1e-12
