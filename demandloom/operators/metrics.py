"""Forecast accuracy: one aggregate for all keys, models and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.distributions import normal_quantile
from demandloom.functions.exprs import as_list, ratio, scalar_struct, series_window, z_value
from demandloom.operators.quantiles import ranges_of

# Metric names in report order, and those where larger is better.
METRICS = ("mae", "rmse", "r2", "bias", "mape", "smape", "wmape", "mase")
LARGER_IS_BETTER = ("r2",)


def to_long(wide: DataFrame, models: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Model columns to (model, yhat) rows."""
    doubles = wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in models])
    return doubles.unpivot(list(ids), list(models), "model", "yhat")


def _metric_columns(y: Column, p: Column, wmape_compat: bool, weight: Column | None = None) -> dict[str, Column]:
    err = p - y
    scale = (F.abs(y) + F.abs(p)) / 2
    sse = F.sum(err * err)
    absolute = F.abs(err)
    weighted, weights = (absolute * F.abs(y) if wmape_compat else absolute), F.abs(y)
    if weight is not None:
        weighted, weights = weight * absolute, weight
    return {
        "mae": F.avg(absolute),
        "rmse": F.sqrt(F.avg(err * err)),
        "r2": 1 - ratio(sse, F.count(F.lit(1)) * F.var_pop(y)),
        "bias": F.avg(err),
        "mape": F.avg(F.when(y != 0, F.abs(ratio(err, y)))) * 100,
        "smape": F.avg(F.when(scale != 0, ratio(absolute, scale))) * 100,
        "wmape": ratio(F.sum(weighted), F.sum(weights)) * 100,
    }


def mase_scale(train: DataFrame, season: int, keys: Sequence[str], order: str = "ds", actual: str = "y") -> DataFrame:
    """Mean absolute seasonal-naive error of the training rows, per key."""
    step = F.abs(F.col(actual) - F.lag(actual, season).over(series_window(keys, order)))
    return train.withColumn("_step", step).groupBy(*keys).agg(F.avg("_step").alias("_scale"))


def metrics_long(
    long: DataFrame,
    by: Sequence[str],
    scale: DataFrame | None = None,
    scale_keys: Sequence[str] = (),
    metrics: Sequence[str] = METRICS,
    wmape_compat: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Metrics per ``by`` of rows (.., y, yhat); rows missing either value are left out.

    ``scale`` holds the MASE denominators per ``scale_keys``; without one MASE is NULL.
    ``weight`` names the column of WMAPE's weights, which else are the actuals.
    """
    known = long.where(F.col("y").isNotNull() & F.col("yhat").isNotNull())
    w = None if weight is None else F.col(weight).cast("double")
    made = _metric_columns(F.col("y").cast("double"), F.col("yhat").cast("double"), wmape_compat, w)
    needed = [m for m in metrics if m != "mase"]
    extra = [F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("_mae")]
    out = known.groupBy(*by).agg(*[made[m].alias(m) for m in needed], *extra)
    if "mase" in metrics:
        if scale is None:
            out = out.withColumn("mase", F.lit(None).cast("double"))
        elif scale_keys:
            out = out.join(scale, list(scale_keys), "left").withColumn("mase", ratio("_mae", "_scale")).drop("_scale")
        else:
            out = out.withColumn("mase", ratio(F.col("_mae"), scalar_struct(scale).getField("_scale")))
    return out.select(*by, *metrics)


def metrics_all(
    wide: DataFrame,
    models: Sequence[str],
    keys: Sequence[str],
    date: str = "ds",
    actual: str = "y",
    train: DataFrame | None = None,
    season: int = 1,
    metrics: Sequence[str] = METRICS,
    wmape_compat: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """All metrics per (keys, model).

    ``train`` (keys, date, y) sets the MASE scale; without it the evaluated
    actuals do.  ``wmape_compat`` weights errors by actuals instead of dividing;
    ``weight`` names a column of weights for WMAPE.
    """
    keys = as_list(keys)
    base = wide.withColumnRenamed(actual, "y") if actual != "y" else wide
    long = to_long(base, models, [*keys, date, "y", *([weight] if weight else [])])
    source = train if train is not None else base.select(*keys, date, "y").where(F.col("y").isNotNull())
    scale = mase_scale(source, season, keys, date) if "mase" in metrics else None
    return metrics_long(long, [*keys, "model"], scale, keys, metrics, wmape_compat, weight)


def compare_models(
    wide: DataFrame,
    models: Sequence[str],
    keys: Sequence[str] = (),
    date: str = "ds",
    actual: str = "y",
    train: DataFrame | None = None,
    season: int = 1,
    wmape_compat: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Model x metric table over all rows; MASE steps are taken inside each series of ``keys``; ``weight`` as in ``metrics_all``."""
    base = wide.withColumnRenamed(actual, "y") if actual != "y" else wide
    long = to_long(base, models, [*keys, date, "y", *([weight] if weight else [])])
    source = train if train is not None else base.select(*keys, date, "y").where(F.col("y").isNotNull())
    step = F.abs(F.col("y") - F.lag("y", season).over(series_window(keys, date)))
    scale = source.withColumn("_step", step).agg(F.avg("_step").alias("_scale"))
    return metrics_long(long, ["model"], scale, (), METRICS, wmape_compat, weight)


def avg_metrics_by_model(metrics: DataFrame, names: Sequence[str] = ("rmse", "mae", "mape")) -> DataFrame:
    return metrics.groupBy("model").agg(*[F.avg(m).alias(m) for m in names])


def rank_models(table: DataFrame, metrics: Sequence[str] = METRICS, by: Sequence[str] = ()) -> DataFrame:
    """(.., metric, model, value, rank): R2 from the top, all others from the bottom."""
    long = table.select(*by, "model", *metrics).unpivot([*by, "model"], list(metrics), "metric", "value")
    signed = F.when(F.col("metric").isin(*LARGER_IS_BETTER), -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy(*by, "metric").orderBy(signed.asc_nulls_last(), "model")
    return long.withColumn("rank", F.row_number().over(w))


def best_model(table: DataFrame, by: Sequence[str] = (), metric: str = "rmse") -> DataFrame:
    """The model with the smallest error, and 1 - smallest / largest as the improvement."""
    out = table.groupBy(*by).agg(
        F.min_by("model", F.struct(metric, "model")).alias("best_model"),
        F.min(metric).alias(f"best_{metric}"),
        F.max(metric).alias(f"worst_{metric}"),
    )
    return out.withColumn("improvement", 1 - ratio(f"best_{metric}", f"worst_{metric}"))


def prediction_interval(
    long: DataFrame, keys: Sequence[str], date: str = "ds", level: float = 0.95, floor_zero: bool = True
) -> DataFrame:
    """Mean of the base models' forecasts with +- z population deviations; the lower end is at least 0."""
    z = z_value((1 + level) / 2)
    out = long.groupBy(*keys, date).agg(F.avg("yhat").alias("yhat"), F.stddev_pop("yhat").alias("_s"))
    lower = F.col("yhat") - F.lit(z) * F.col("_s")
    return out.withColumns(
        {
            "yhat_lower": F.greatest(lower, F.lit(0.0)) if floor_zero else lower,
            "yhat_upper": F.col("yhat") + F.lit(z) * F.col("_s"),
        }
    ).drop("_s")


def residuals(long: DataFrame, keys: Sequence[str], date: str = "ds") -> DataFrame:
    return long.select(*keys, date, "model", (F.col("y") - F.col("yhat")).alias("residual"))


def error_histogram(
    errors: DataFrame, low: float, high: float, bins: int = 20, by: Sequence[str] = ("model",), column: str = "residual"
) -> DataFrame:
    """(.., bin, count, bin_sum, mean_error): equal bins over [low, high); 0 and bins + 1 are the tails.

    ``mean_error`` is over all residuals of the group, from the bins' sums.
    """
    known = errors.where(F.col(column).isNotNull())
    width = F.width_bucket(F.col(column), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    binned = known.groupBy(*by, width.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.sum(column).alias("bin_sum")
    )
    w = Window.partitionBy(*by)
    return binned.withColumn("mean_error", ratio(F.sum("bin_sum").over(w), F.sum("count").over(w)))


def qq_points(errors: DataFrame, by: Sequence[str] = ("model",), column: str = "residual", ranges: int | None = None) -> DataFrame:
    """(.., value, copies, position, theoretical): ordered residuals against normal quantiles.

    Equal residuals are one row at their mean rank.  Order is found inside
    value ranges from a bounded sketch, with the counts of earlier ranges added,
    so no task orders a whole group.  The position is (rank - 0.5) / n.
    """
    ranges = ranges or ranges_of(errors)
    by = list(by)
    known = errors.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("value"))
    counted = known.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("copies"))
    sketch = counted.groupBy(*by).agg(
        F.percentile_approx("value", [i / ranges for i in range(1, ranges)], 4 * ranges).alias("_cuts"),
        F.sum("copies").alias("_n"),
    )
    ranged = counted.join(sketch, by).withColumn(
        "_range", F.size(F.filter("_cuts", lambda c: c < F.col("value")))
    ).drop("_cuts")
    upto = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy(*by, "_range").agg(F.sum("copies").alias("_c")).withColumn(
        "_before", F.coalesce(F.sum("_c").over(upto), F.lit(0))
    ).drop("_c")
    inside = Window.partitionBy(*by, "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranged.join(before, [*by, "_range"]).withColumn("_end", F.col("_before") + F.sum("copies").over(inside))
    middle = F.col("_end") - (F.col("copies") - 1) / F.lit(2.0)
    placed = ranked.withColumn("position", ratio(middle - 0.5, F.col("_n")))
    return placed.select(*by, "value", "copies", "position", normal_quantile("position").alias("theoretical"))
