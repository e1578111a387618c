"""Aggregations, reports, top-k, splits and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import all_of, as_list, numeric_columns, series_window
from demandloom.operators.ordered import with_positions

_NAMED = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "first": lambda c: F.min_by(c, "_order"),
}


def daily_series(
    df: DataFrame, columns: Sequence[str] | str, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """One row per (keys, date) with summed values: what every ordered operator expects.

    Map-side combining shrinks a hot series to one row per day before the shuffle.
    """
    return df.groupBy(*keys, date).agg(*[F.sum(c).alias(c) for c in as_list(columns)])


def aggregate(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    agg: Mapping[str, str] | None = None,
    date: str = "date",
    order: Sequence[str] | str | None = None,
) -> DataFrame:
    """Group by date and keys; numeric columns are summed and others take their first value.

    ``first`` follows ``order`` (smallest value without one) and skips NULLs.
    Rows with a NULL key are left out.
    """
    if keys is None:
        return df
    keys = list(keys) if date in keys else [date, *keys]
    numeric = set(numeric_columns(df))
    plan = dict(agg) if agg else {c: ("sum" if c in numeric else "first") for c in df.columns if c not in keys}
    out = df.where(all_of(F.col(k).isNotNull() for k in keys))
    aggs = []
    for c, how in plan.items():
        if how == "first":
            by = F.struct(*as_list(order)) if order else F.col(c)
            aggs.append(F.min_by(c, F.when(F.col(c).isNotNull(), by)).alias(c))
        else:
            aggs.append(_NAMED[how](c).alias(c))
    return out.groupBy(*keys).agg(*aggs)


def hierarchy(
    df: DataFrame, levels: Sequence[str], target: str = "sales", date: str = "date", with_detail: bool = True
) -> DataFrame:
    """Totals per date for every prefix of ``levels`` from one grouping-sets pass, long form.

    ``level`` names the prefix ("all", "a", "a_b", ...); with_detail adds the
    input rows as "..._full".
    """
    levels = list(levels)
    sets = [[date, *levels[:i]] for i in range(len(levels) + 1)]
    # Grouping sets copy their input once per level, so they run on the finest totals.
    finest = df.where(F.col(date).isNotNull()).groupBy(date, *levels).agg(F.sum(target).alias(target))
    grouped = finest.groupingSets(sets, date, *levels).agg(
        F.coalesce(F.sum(target), F.lit(0)).alias(target), F.grouping_id().alias("_gid")
    )
    name: Column | None = None
    valid: Column | None = None
    for i in range(len(levels) + 1):
        gid = sum(1 << (len(levels) - 1 - j) for j in range(i, len(levels)))
        label = "_".join(levels[:i]) or "all"
        at = F.col("_gid") == gid
        name = F.when(at, label) if name is None else name.when(at, label)
        # A NULL key is no group of its own at the levels that use it.
        keyed = all_of([at, *[F.col(c).isNotNull() for c in levels[:i]]])
        valid = keyed if valid is None else valid | keyed
    out = grouped.where(valid).select(name.alias("level"), date, *levels, target)
    if with_detail:
        detail = df.select(F.lit("_".join(levels) + "_full").alias("level"), date, *levels, target)
        out = out.unionByName(detail)
    return out


def hierarchy_level(df: DataFrame, level: str) -> DataFrame:
    return df.where(F.col("level") == level)


def series_counts(df: DataFrame, keys: Sequence[str] = ("store_id", "product_id")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), *keys)


def distinct_series(df: DataFrame, keys: Sequence[str] = ("store_id", "product_id")) -> DataFrame:
    return df.select(*keys).distinct()


def daily_totals(df: DataFrame, columns: Sequence[str] = ("sales",), date: str = "date") -> DataFrame:
    return df.groupBy(date).agg(*[F.sum(c).alias(c) for c in columns])


def weekday_profile(df: DataFrame, column: str = "sales", date: str = "date") -> DataFrame:
    """Mean daily total per weekday, Monday first."""
    return _profile(df, column, date, F.weekday(date), F.date_format(date, "EEEE"), "weekday")


def month_profile(df: DataFrame, column: str = "sales", date: str = "date") -> DataFrame:
    """Mean daily total per month of the year, January first."""
    return _profile(df, column, date, F.month(date), F.date_format(date, "MMMM"), "month")


def _profile(df, column, date, number, name, label):
    days = daily_totals(df, [column], date)
    parts = days.groupBy(number.alias(f"{label}_no"), name.alias(label))
    return parts.agg(F.avg(column).alias(f"mean_{column}")).orderBy(f"{label}_no")


def dimension_totals(
    facts: DataFrame, dim: DataFrame, key: str, attribute: str, column: str = "sales"
) -> DataFrame:
    """Total per dimension attribute, largest first; facts shrink to one row per key before the join."""
    per_key = facts.groupBy(key).agg(F.sum(column).alias(column))
    joined = per_key.join(dim.select(key, attribute), key)
    out = joined.groupBy(attribute).agg(F.sum(column).alias(column))
    return out.orderBy(F.col(column).desc(), attribute)


def top_by_total(
    facts: DataFrame, dim: DataFrame, key: str, n: int = 5, column: str = "sales", attributes: Sequence[str] = ()
) -> DataFrame:
    """The n keys with the largest totals, with dimension columns; ties by key."""
    per_key = facts.groupBy(key).agg(F.sum(column).alias(column))
    best = per_key.orderBy(F.col(column).desc(), key).limit(n)
    picked = dim.select(key, *attributes) if attributes else dim
    return best.join(picked, key).orderBy(F.col(column).desc(), key)


def trend_line(df: DataFrame, y: str = "sales", x: str | None = None, order: str = "date") -> DataFrame:
    """Least-squares slope and intercept of y on x, or on the row number in time order."""
    if x is None:
        df = df.withColumn("_x", F.row_number().over(series_window([], order)) - 1)
        x = "_x"
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def corr_with_target(df: DataFrame, target: str, features: Sequence[str] | None = None) -> DataFrame:
    """(feature, correlation): absolute correlation with the target, all from one aggregate."""
    features = list(features) if features else numeric_columns(df, {target})
    row = df.agg(*[F.abs(F.corr(F.col(c).cast("double"), F.col(target).cast("double"))).alias(c) for c in features])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("correlation")) for c in features])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def top_features(scores: DataFrame, n: int = 20, score: str = "correlation") -> DataFrame:
    return scores.orderBy(F.col(score).desc_nulls_last(), "feature").limit(n)


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str = "date") -> DataFrame:
    """The last row of every series, by map-side combined ``max_by``."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*as_list(order))).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def tail_horizon(df: DataFrame, n: int, keys: Sequence[str] = (), order: str | Sequence[str] = "date") -> DataFrame:
    """Last n rows per series; the rank limit is applied before the shuffle too."""
    rank = F.row_number().over(series_window(keys, order, descending=True))
    return df.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def row_positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_pos`` (0-based rank over the whole table, NULL first) and ``_total``; orders of any type, without a single-task sort."""
    return with_positions(df, order, "_total")


def time_split(
    df: DataFrame,
    order: Sequence[str],
    train: float = 0.7,
    val: float = 0.15,
    keys: Sequence[str] | None = None,
    output: str = "split",
) -> DataFrame:
    """Label rows train/val/test in time order by row count.

    With keys each series is cut on its own; without, the whole table is, with
    ``order`` (date first) breaking ties.
    """
    if keys:
        w = series_window(keys, order)
        placed = df.withColumns(
            {"_pos": F.row_number().over(w) - 1, "_total": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
        )
    else:
        placed = row_positions(df, order)
    train_end = F.floor(F.col("_total") * F.lit(train))
    val_end = train_end + F.floor(F.col("_total") * F.lit(val))
    label = F.when(F.col("_pos") < train_end, "train").when(F.col("_pos") < val_end, "val").otherwise("test")
    return placed.withColumn(output, label).drop("_pos", "_total")


def ts_cv_folds(
    df: DataFrame, order: str | Sequence[str], keys: Sequence[str] = (), n_splits: int = 5
) -> DataFrame:
    """Expanding folds: (keys, fold, row columns, role).

    Each of the last ``n_splits`` blocks of n // (n_splits + 1) rows is tested
    on all rows before it.
    """
    if as_list(keys):
        w = series_window(keys, order)
        placed = df.withColumns(
            {"_pos": F.row_number().over(w) - 1, "_total": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
        )
    else:
        placed = row_positions(df, as_list(order))
    size = F.floor(F.col("_total") / F.lit(n_splits + 1))
    fold = F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold")
    rows = placed.select("*", size.alias("_size"), fold)
    start = F.col("_total") - (F.lit(n_splits) - F.col("fold")) * F.col("_size")
    role = F.when(F.col("_pos") < start, "train").when(F.col("_pos") < start + F.col("_size"), "test")
    return rows.withColumn("role", role).where(F.col("role").isNotNull() & (F.col("_size") > 0)).drop(
        "_pos", "_total", "_size"
    )


def union_forecasts(forecasts: Mapping[str, DataFrame]) -> DataFrame:
    """Stack forecasts with a ``model`` column; columns a model lacks become NULL."""
    out = None
    for name, df in forecasts.items():
        tagged = df.withColumn("model", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no forecasts")
    return out


def concat_rows(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dedupe_actuals(df: DataFrame, keys: Sequence[str], date: str = "ds", actual: str = "y") -> DataFrame:
    """One actual per (keys, date): the non-NULL one where forecasts disagree on having it."""
    return df.groupBy(*keys, date).agg(F.max(actual).alias(actual))


def join_actuals(forecast: DataFrame, history: DataFrame, keys: Sequence[str], date: str = "ds", actual: str = "y") -> DataFrame:
    return forecast.join(dedupe_actuals(history, keys, date, actual), [*keys, date], "left")


def pivot_models(
    forecasts: DataFrame, models: Sequence[str], keys: Sequence[str], date: str = "ds", value: str = "yhat"
) -> DataFrame:
    """One column per named model; naming the models avoids a distinct job."""
    one = F.max(value)
    return forecasts.groupBy(*keys, date).pivot("model", list(models)).agg(one)
