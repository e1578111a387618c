"""Combining forecasts of several models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import ratio
from demandloom.operators.metrics import to_long


def ensemble_average(wide: DataFrame, models: Sequence[str], output: str = "ensemble") -> DataFrame:
    """Equal-weight mean; NULL where a model is missing."""
    total = sum((F.col(m) for m in models[1:]), F.col(models[0]))
    return wide.withColumn(output, total / F.lit(float(len(models))))


def model_scores(wide: DataFrame, models: Sequence[str], actual: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """(.., model, rmse, mae) over rows where actual and forecast are known."""
    long = to_long(wide, models, [*by, actual])
    err = F.col("yhat") - F.col(actual)
    known = long.where(err.isNotNull())
    return known.groupBy(*by, "model").agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"))


def ensemble_weights(
    fit_on: DataFrame, models: Sequence[str], actual: str = "y", by: Sequence[str] = ()
) -> DataFrame:
    """(.., model, weight) with weight in proportion to 1 / RMSE; models without any error share all of it.

    Fit on a validation part, not on the rows to be scored.
    """
    perfect = F.max((F.col("rmse") == 0).cast("int")).over(Window.partitionBy(*by)) == 1
    inverse = F.when(perfect, (F.col("rmse") == 0).cast("double")).otherwise(ratio(F.lit(1.0), F.col("rmse")))
    scores = model_scores(fit_on, models, actual, by).withColumn("_inv", inverse)
    total = F.sum("_inv").over(Window.partitionBy(*by))
    return scores.withColumn("weight", ratio("_inv", total)).select(*by, "model", "weight")


def ensemble_weighted(
    wide: DataFrame,
    models: Sequence[str],
    weights: Mapping[str, float] | DataFrame,
    by: Sequence[str] = (),
    output: str = "ensemble",
    renormalize: bool = False,
) -> DataFrame:
    """Weighted sum of model columns; NULL if one is missing unless ``renormalize``.

    ``weights`` is a mapping or the table of ``ensemble_weights``, one row per
    ``by`` and model.
    """
    if isinstance(weights, DataFrame):
        row = weights.groupBy(*by).agg(
            F.struct(*[F.max(F.when(F.col("model") == m, F.col("weight"))).alias(m) for m in models]).alias("_w")
        )
        out = wide.join(row, list(by), "left") if by else wide.withColumn("_w", row.scalar())
        weight = {m: F.col("_w").getField(m) for m in models}
    else:
        out = wide
        weight = {m: F.lit(float(weights[m])) for m in models}
    if renormalize:
        num = sum((F.coalesce(weight[m] * F.col(m), F.lit(0.0)) for m in models), F.lit(0.0))
        den = sum((F.when(F.col(m).isNotNull(), weight[m]).otherwise(0.0) for m in models), F.lit(0.0))
        value = ratio(num, den)
    else:
        value = weight[models[0]] * F.col(models[0])
        for m in models[1:]:
            value = value + weight[m] * F.col(m)
    return out.withColumn(output, value).drop("_w")


def ensemble_median(wide: DataFrame, models: Sequence[str], output: str = "ensemble") -> DataFrame:
    """Row median across models, from a sorted array of the row: no shuffle.  NULL if a model is missing."""
    n = len(models)
    ordered = F.array_sort(F.array(*[F.col(m).cast("double") for m in models]))
    mid = n // 2
    value = ordered[mid] if n % 2 else (ordered[mid - 1] + ordered[mid]) / F.lit(2.0)
    complete = F.col(models[0]).isNotNull()
    for m in models[1:]:
        complete = complete & F.col(m).isNotNull()
    return wide.withColumn(output, F.when(complete, value))


def ensemble_median_long(long: DataFrame, keys: Sequence[str], date: str = "ds") -> DataFrame:
    """Median over the models present per (keys, date); a group is as long as the model list."""
    return long.groupBy(*keys, date).agg(F.median("yhat").alias("ensemble"))


def ensemble_evaluate(wide: DataFrame, column: str = "ensemble", actual: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, r2 and mape of the combined forecast."""
    y, p = F.col(actual), F.col(column)
    err = p - y
    return wide.where(err.isNotNull()).groupBy(*by).agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (1 - ratio(F.sum(err * err), F.count(F.lit(1)) * F.var_pop(y))).alias("r2"),
        (F.avg(F.when(y != 0, F.abs(ratio(err, y)))) * 100).alias("mape"),
    )
