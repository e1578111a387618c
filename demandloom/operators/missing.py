"""Fills for missing values.  Ordered fills work inside one series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import (
    as_list,
    numeric_columns,
    scalar_struct,
    series_window,
    string_columns,
)
from demandloom.operators.ordered import carried, with_positions
from demandloom.operators.quantiles import exact_quantiles

_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def _frames(keys, order):
    asc = series_window(keys, order)
    # The reversed sort gives "next value" as a running frame, linear in the series length.
    desc = series_window(keys, order, descending=True)
    return asc, desc


def ffill_expr(x: Column, keys, order, then_bfill: bool = True) -> Column:
    asc, _ = _frames(keys, order)
    filled = F.last(x, ignorenulls=True).over(asc.rowsBetween(*_TO_HERE))
    return F.coalesce(filled, F.first(x, ignorenulls=True).over(asc.rowsBetween(*_WHOLE))) if then_bfill else filled


def bfill_expr(x: Column, keys, order, then_ffill: bool = True) -> Column:
    asc, desc = _frames(keys, order)
    filled = F.last(x, ignorenulls=True).over(desc.rowsBetween(*_TO_HERE))
    return F.coalesce(filled, F.last(x, ignorenulls=True).over(asc.rowsBetween(*_WHOLE))) if then_ffill else filled


def fill(
    df: DataFrame,
    columns: Sequence[str] | str,
    method: str,
    keys: Sequence[str] = (),
    order: str | Sequence[str] = "date",
    edges: bool = True,
) -> DataFrame:
    """Ordered fill per series: ``ffill``, ``bfill`` or ``interpolate``, or ``zero``.

    ``edges`` also fills what the first direction leaves open at the series ends.
    Without keys the whole table is one series in ``order``, worked on in blocks.
    """
    columns = as_list(columns)
    if method == "zero":
        return df.na.fill(0, subset=columns)
    if not as_list(keys) and method in ("ffill", "bfill", "interpolate"):
        return _fill_whole_table(df, columns, method, as_list(order), edges)
    return fill_series(df, columns, method, keys, order, edges)


def fill_series(
    df: DataFrame, columns: Sequence[str] | str, method: str, keys: Sequence[str] = (), order: str | Sequence[str] = "date", edges: bool = True
) -> DataFrame:
    """``fill`` by windows over whole series; without keys only for tables with one row per date."""
    columns = as_list(columns)
    if method == "zero":
        return df.na.fill(0, subset=columns)
    if method == "interpolate":
        return _interpolate(df, columns, keys, order, edges)
    if method not in ("ffill", "bfill"):
        raise ValueError(f"unknown fill method: {method}")
    expr = ffill_expr if method == "ffill" else bfill_expr
    return df.withColumns({c: expr(F.col(c), keys, order, edges) for c in columns})


def _fill_whole_table(df: DataFrame, columns: Sequence[str], method: str, order: Sequence[str], edges: bool) -> DataFrame:
    """The nearest known values on either side, with their positions, are carried over blocks of the whole table."""

    def known(c: str) -> Column:
        x = F.col(c).cast("double") if method == "interpolate" else F.col(c)
        return F.when(x.isNotNull(), F.struct(x.alias("v"), F.col("_pos").alias("k")))

    placed = with_positions(df, order)
    both = edges or method == "interpolate"
    before = {f"_p_{c}": known(c) for c in columns if both or method == "ffill"}
    after = {f"_n_{c}": known(c) for c in columns if both or method == "bfill"}
    near = carried(placed, before, after)
    out = {}
    for c in columns:
        p, n = (F.col(f"{side}{c}.v") if f"{side}{c}" in near.columns else F.lit(None) for side in ("_p_", "_n_"))
        if method == "interpolate":
            out[c] = _between(F.col(c).cast("double"), F.col(f"_p_{c}"), F.col(f"_n_{c}"), F.col("_pos"), edges)
        else:
            first, second = (p, n) if method == "ffill" else (n, p)
            out[c] = F.coalesce(first, second) if edges else first
    return near.withColumns(out).select(*df.columns)


def _between(x: Column, p: Column, n: Column, at: Column, edges: bool) -> Column:
    """A value between the known ones before and after it, each (v, k); the tail repeats the last one, the head needs ``edges``."""
    step = (at - p.getField("k")) / (n.getField("k") - p.getField("k"))
    value = F.when(x.isNotNull(), x).when(n.isNull(), p.getField("v"))
    # A head row has no previous value: with edges it takes the next known one.
    value = value.when(p.isNull(), n.getField("v") if edges else F.lit(None))
    return value.otherwise(p.getField("v") + (n.getField("v") - p.getField("v")) * step)


def _interpolate(df: DataFrame, columns, keys, order, edges: bool) -> DataFrame:
    """Linear by row position; the tail repeats the last value, the head needs ``edges``."""
    asc, desc = _frames(keys, order)
    # Positions are a window result that feeds further windows, hence two steps.
    df = df.withColumn("_k", F.row_number().over(asc))
    temp = {}
    for c in columns:
        x = F.col(c).cast("double")
        known = F.when(x.isNotNull(), F.struct(x.alias("v"), F.col("_k").alias("k")))
        temp[f"_p_{c}"] = F.last(known, ignorenulls=True).over(asc.rowsBetween(*_TO_HERE))
        temp[f"_n_{c}"] = F.last(known, ignorenulls=True).over(desc.rowsBetween(*_TO_HERE))
    df = df.withColumns(temp)
    out = {c: _between(F.col(c).cast("double"), F.col(f"_p_{c}"), F.col(f"_n_{c}"), F.col("_k"), edges) for c in columns}
    return df.withColumns(out).drop("_k", *temp)


def fill_statistic(df: DataFrame, statistic: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns by their global ``mean`` or exact ``median``."""
    columns = list(columns) if columns else numeric_columns(df)
    if statistic == "mean":
        stats = scalar_struct(df.agg(*[F.avg(c).alias(c) for c in columns]))
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), stats.getField(c)) for c in columns})
    if statistic == "median":
        out = {}
        for c in columns:
            median = scalar_struct(exact_quantiles(df, c, [0.5], names=["m"])).getField("m")
            out[c] = F.coalesce(F.col(c).cast("double"), median)
        return df.withColumns(out)
    raise ValueError(f"unknown statistic: {statistic}")


def fill_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): the most frequent value, ties to the smallest; one pass for all columns."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    counts = df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
    counts = counts.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def fill_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """String columns by their most frequent value, ties to the smallest."""
    columns = list(columns) if columns else string_columns(df)
    if not columns:
        return df
    modes = column_modes(df, columns).agg(
        *[F.max(F.when(F.col("column") == c, F.col("mode"))).alias(c) for c in columns]
    )
    stats = scalar_struct(modes)
    return df.withColumns({c: F.coalesce(F.col(c), stats.getField(c)) for c in columns})


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def handle_missing(
    df: DataFrame,
    strategy: str = "ffill",
    keys: Sequence[str] = (),
    order: str | Sequence[str] = "date",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Entry point over all strategies: ffill, bfill, interpolate, mean, median, zero, drop."""
    if strategy in ("mean", "median"):
        return fill_statistic(df, strategy, columns)
    if strategy == "zero":
        return df.na.fill(0, subset=list(columns)) if columns else fill_zero(df)
    if strategy == "drop":
        return drop_null_rows(df, columns)
    skip = {*as_list(keys), *as_list(order)}
    if columns is None:
        columns = numeric_columns(df, skip) if strategy == "interpolate" else [c for c in df.columns if c not in skip]
    return fill(df, columns, strategy, keys, order)


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing, total) for every column, in one aggregate."""
    columns = list(columns) if columns else df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns],
    )
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns])
    return row.select(F.explode(entries).alias("e"), F.col("_total").alias("total")).select(
        "e.column", "e.missing", "total"
    )


def clean_sales(
    df: DataFrame,
    keys: Sequence[str] = (),
    date: str = "date",
    mean_below: float = 5.0,
    fill_below: float = 20.0,
) -> DataFrame:
    """Fill each column by how much of it is missing.

    Numeric columns missing in less than ``mean_below`` percent of rows take
    the mean, below ``fill_below`` the series' previous (then next) value, else
    the median; strings take their mode.  Keys and date are left alone.  One
    small aggregate is read on the driver to choose the plan of each column.
    """
    skip = {date, *keys}
    numeric = numeric_columns(df, skip)
    strings = string_columns(df, skip)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in numeric + strings],
    ).first()
    share = {c: (100.0 * counts[c] / counts["_rows"] if counts["_rows"] else 0.0) for c in numeric + strings}
    by_mean = [c for c in numeric if 0 < share[c] < mean_below]
    by_neighbour = [c for c in numeric if mean_below <= share[c] < fill_below]
    by_median = [c for c in numeric if share[c] >= fill_below]
    if by_neighbour:
        df = fill(df, by_neighbour, "ffill", keys, date)
    if by_mean:
        df = fill_statistic(df, "mean", by_mean)
    if by_median:
        df = fill_statistic(df, "median", by_median)
    by_mode = [c for c in strings if share[c] > 0]
    return fill_mode(df, by_mode) if by_mode else df
