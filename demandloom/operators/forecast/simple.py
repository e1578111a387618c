"""Closed-form forecasts, decomposition and feature scoring in plain Spark SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import numeric_columns, ratio, series_window
from demandloom.operators.aggregate import tail_horizon
from demandloom.operators.quantiles import exact_quantiles


def forecast_naive_mean(
    df: DataFrame, keys: Sequence[str] = (), horizon: int = 30, last: int = 7, date: str = "date", target: str = "sales"
) -> DataFrame:
    """(keys, ds, yhat): the mean of the last rows on every day of the horizon."""
    tail = tail_horizon(df, last, keys, date).groupBy(*keys).agg(F.avg(target).alias("yhat"), F.max(date).alias("_last"))
    ahead = F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias("ds")
    return tail.select(*keys, ahead, "yhat")


def seasonal_decompose(
    df: DataFrame,
    keys: Sequence[str] = (),
    column: str = "sales",
    order: str = "date",
    period: int = 7,
    kind: str = "multiplicative",
) -> DataFrame:
    """Classical decomposition: centred moving-average trend, periodic figure, remainder.

    The figure averages the detrended values per phase and is scaled to mean 1
    (or shifted to mean 0).  Ends without a full frame have no trend.
    """
    if kind not in ("multiplicative", "additive"):
        raise ValueError(f"unknown decomposition: {kind}")
    keys = list(keys)
    w = series_window(keys, order)
    x = F.col(column).cast("double")
    half = period // 2
    frame = w.rowsBetween(-half, half)
    if period % 2:
        trend = F.when(F.count(x).over(frame) == period, F.avg(x).over(frame))
    else:
        # Even periods weigh the two outermost rows by one half.
        inner = w.rowsBetween(-half, half - 1)
        outer = w.rowsBetween(-half + 1, half)
        both = (F.sum(x).over(inner) + F.sum(x).over(outer)) / (2.0 * period)
        trend = F.when(F.count(x).over(frame) == period + 1, both)
    out = df.withColumns({"trend": trend, "_phase": (F.row_number().over(w) - 1) % period})
    detrended = ratio(x, F.col("trend")) if kind == "multiplicative" else x - F.col("trend")
    figure = out.groupBy(*keys, "_phase").agg(F.avg(detrended).alias("_f"))
    level = F.avg("_f").over(Window.partitionBy(*keys))
    scaled = ratio(F.col("_f"), level) if kind == "multiplicative" else F.col("_f") - level
    figure = figure.withColumn("seasonal", scaled).drop("_f")
    joined = out.join(figure, [*keys, "_phase"], "left")
    season = F.col("seasonal")
    rest = ratio(x, F.col("trend") * season) if kind == "multiplicative" else x - F.col("trend") - season
    return joined.withColumn("remainder", rest).select(*df.columns, "trend", "seasonal", "remainder")


def select_features_mi(
    df: DataFrame, target: str, n: int = 20, features: Sequence[str] | None = None, bins: int = 10
) -> DataFrame:
    """(feature, mutual_info): top n features by mutual information over exact quantile bins.

    Pair counts of all features come from one aggregate whose result has at
    most bins * bins rows per feature.
    """
    features = list(features) if features else numeric_columns(df, {target})
    probs = [i / bins for i in range(1, bins)]
    columns = [*features, target]
    edges = {}
    for c in columns:
        found = exact_quantiles(df, c, probs)
        edges[f"_e_{c}"] = found.select(F.array(*found.columns).alias("e")).scalar()
    with_edges = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).withColumns(edges)

    def code(c: str) -> Column:
        below = F.filter(f"_e_{c}", lambda e: e < F.col(c))
        return F.when(F.col(c).isNotNull(), F.size(below)).alias(c)

    coded = with_edges.select(*[code(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("a")) for c in features])).alias("p")
    long = coded.select(F.col(target).alias("b"), pairs).select("p.feature", "p.a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    joint = long.groupBy("feature", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    na = F.sum("n").over(Window.partitionBy("feature", "a"))
    nb = F.sum("n").over(Window.partitionBy("feature", "b"))
    term = joint.withColumn("t", ratio("n", total) * F.log(ratio(F.col("n") * total, na * nb)))
    scores = term.groupBy("feature").agg(F.sum("t").alias("mutual_info"))
    return scores.orderBy(F.col("mutual_info").desc(), "feature").limit(n)
