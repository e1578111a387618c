"""Scaling and target transforms with their inverses.

Parameters are global statistics, held in a one-row DataFrame; using them is a
scalar subquery, so transform and inverse stay lazy and need no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import numeric_columns, scalar_struct
from demandloom.sources.io import settle

# Transform method names.
METHODS = ("none", "log", "sqrt", "box-cox", "standardize", "normalize")

PARAMS = {"method": "string", "constant": "double", "lambda": "double", "mean": "double", "std": "double",
          "min": "double", "max": "double"}


def _params_row(df: DataFrame, method: str, **values: Column) -> DataFrame:
    typed = [values.get(n, F.lit(None)).cast(t).alias(n) for n, t in PARAMS.items() if n != "method"]
    return df.agg(F.lit(method).alias("method"), *typed)


def _shift(x: Column, positive: bool) -> Column:
    low = F.min(x)
    fine = (low > 0) if positive else (low >= 0)
    return F.when(fine, F.lit(0.0)).otherwise(F.abs(low) + 1)


def transform_params(df: DataFrame, column: str, method: str) -> DataFrame:
    """One row of parameters for ``transform`` and ``inverse_transform``."""
    x = F.col(column).cast("double")
    if method == "none":
        return _params_row(df, method)
    if method in ("log", "sqrt"):
        return _params_row(df, method, constant=_shift(x, positive=method == "log"))
    if method == "standardize":
        spread = F.stddev_pop(x)
        return _params_row(df, method, mean=F.avg(x), std=F.when(spread == 0, 1.0).otherwise(spread))
    if method == "normalize":
        return _params_row(df, method, min=F.min(x), max=F.max(x))
    if method == "box-cox":
        # the passes read the values alone, written once, and not what makes them
        values = settle(df.select(x.alias("x")), "boxcox")
        shift = _shift(F.col("x"), positive=True)
        constant = scalar_struct(values.agg(shift.alias("c"))).getField("c")
        lam = boxcox_lambda(values.select((F.col("x") + constant).alias("x")), "x")
        return _params_row(values, method, constant=shift, **{"lambda": F.lit(lam)})
    raise ValueError(f"unknown transform: {method}")


def transform(df: DataFrame, column: str, params: DataFrame, method: str) -> DataFrame:
    x = F.col(column).cast("double")
    if method == "none":
        return df
    p = scalar_struct(params)
    if method == "log":
        y = F.log1p(x + p.getField("constant"))
    elif method == "sqrt":
        y = F.sqrt(x + p.getField("constant"))
    elif method == "standardize":
        y = (x - p.getField("mean")) / p.getField("std")
    elif method == "normalize":
        y = (x - p.getField("min")) / _span(p)
    elif method == "box-cox":
        y = _boxcox(x + p.getField("constant"), p.getField("lambda"))
    else:
        raise ValueError(f"unknown transform: {method}")
    return df.withColumn(column, y)


def inverse_transform(df: DataFrame, column: str, params: DataFrame, method: str) -> DataFrame:
    y = F.col(column).cast("double")
    if method == "none":
        return df
    p = scalar_struct(params)
    if method == "log":
        x = F.expm1(y) - p.getField("constant")
    elif method == "sqrt":
        x = y * y - p.getField("constant")
    elif method == "standardize":
        x = y * p.getField("std") + p.getField("mean")
    elif method == "normalize":
        x = y * _span(p) + p.getField("min")
    elif method == "box-cox":
        lam = p.getField("lambda")
        root = F.pow(lam * y + 1, F.try_divide(F.lit(1.0), lam))
        x = F.when(F.abs(lam) < 1e-8, F.exp(y)).otherwise(root) - p.getField("constant")
    else:
        raise ValueError(f"unknown transform: {method}")
    return df.withColumn(column, x)


def _span(p: Column) -> Column:
    width = p.getField("max") - p.getField("min")
    return F.when(width == 0, 1.0).otherwise(width)


def _boxcox(x: Column, lam: Column) -> Column:
    return F.when(F.abs(lam) < 1e-8, F.log(x)).otherwise(F.try_divide(F.pow(x, lam) - 1, lam))


def boxcox_lambda(df: DataFrame, column: str, low: float = -2.0, high: float = 2.0, points: int = 21, most: float = 1000.0) -> float:
    """Lambda of the largest profile log-likelihood, to 0.001; 1 where the values don't vary.

    Each pass is one aggregate over all rows with one variance per candidate;
    only the winner comes back to the driver.  While it stands at an end of the
    range, the range moves on and doubles, as far as ``most`` either way; three
    passes then refine it.  Values are taken over their geometric mean, which
    drops a constant from the likelihood and keeps powers small.
    """
    logs = df.select(F.log(F.col(column).cast("double")).alias("u")).where(F.col("u").isNotNull())
    middle = logs.agg(F.avg("u")).first()[0]
    if middle is None:
        return 1.0
    u = F.col("u") - F.lit(middle)

    def winner(low: float, step: float) -> float | None:
        scores = []
        for lam in [low + i * step for i in range(points)]:
            lam = 0.0 if abs(lam) < 1e-9 else lam
            spread = F.var_pop(u if lam == 0.0 else F.exp(u * F.lit(lam)) / F.lit(lam))
            score = F.when((spread > 0) & (spread < float("inf")), -F.log(spread))
            scores.append(F.struct(score.alias("score"), F.lit(lam).alias("lam")))
        top = logs.agg(F.array_max(F.array(*scores)).alias("top")).first()["top"]
        return None if top["score"] is None else top["lam"]

    best = 0.0
    while True:
        step = (high - low) / (points - 1)
        best = winner(low, step)
        if best is None:
            return 1.0
        inside = low + step / 2 < best < high - step / 2
        if inside or (best < 0 and low <= -most) or (best > 0 and high >= most):
            break
        low, high = (low * 2, low / 2) if best < 0 else (high / 2, high * 2)
    while step > 0.001:
        low, step = best - step, 2 * step / (points - 1)
        best = winner(low, step)
    return round(best, 6)


def scale_features(df: DataFrame, columns: Sequence[str] | None = None, method: str = "standard") -> DataFrame:
    """Standardise (population deviation) or min-max scale several columns from one aggregate."""
    columns = list(columns) if columns else numeric_columns(df)
    if method == "standard":
        stats = df.agg(*[F.struct(F.avg(c).alias("a"), F.stddev_pop(c).alias("b")).alias(c) for c in columns])
    elif method == "minmax":
        stats = df.agg(
            *[F.struct(F.min(c).cast("double").alias("a"), (F.max(c) - F.min(c)).cast("double").alias("b")).alias(c)
              for c in columns]
        )
    else:
        raise ValueError(f"unknown method: {method}")
    s = scalar_struct(stats)
    scaled = {}
    for c in columns:
        base, width = s.getField(c).getField("a"), s.getField(c).getField("b")
        scaled[c] = (F.col(c).cast("double") - base) / F.when(width == 0, 1.0).otherwise(width)
    return df.withColumns(scaled)


def filter_date_range(
    df: DataFrame,
    date: str = "date",
    start: str | None = None,
    end: str | None = None,
    keep: Sequence[str] | None = None,
    target: str | None = None,
) -> DataFrame:
    """Inclusive date bounds (pushed to the scan) and the wanted columns plus date and target."""
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    if keep is not None:
        extra = [c for c in (date, target) if c and c not in keep]
        df = df.select(*keep, *extra)
    return df


def filter_and_transform(
    df: DataFrame,
    target: str,
    date: str = "date",
    start: str | None = None,
    end: str | None = None,
    keep: Sequence[str] | None = None,
    method: str = "none",
) -> tuple[DataFrame, DataFrame]:
    """Filtered, transformed table and its one-row parameter table."""
    kept = filter_date_range(df, date, start, end, keep, target)
    params = transform_params(kept, target, method)
    return transform(kept, target, params, method), params
